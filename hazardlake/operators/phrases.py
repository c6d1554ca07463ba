"""Phrase search over positional postings.

Texts are tokenised once into (token, document, position). A phrase is a token sequence; its rarest
token finds the possible starts, and each other token is looked up at its own shifted position by an equi-join. No
text is moved or read again, and a frequent token of a phrase is only ever met at positions that the rarest one left open.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.functions import text as T
from hazardlake.operators.common import checkpoint, spread, top_n_per_key


def phrase_tokens(phrases: DataFrame, key: str, phrase_col: str) -> DataFrame:
    """(key, _n, _off, token): the lower-case tokens of each phrase with their offsets."""
    toks = phrases.select(key, T.tokens(F.col(phrase_col)).alias("_toks")).where(F.size("_toks") > 0)
    return toks.select(key, F.size("_toks").alias("_n"), F.posexplode("_toks").alias("_off", "token"))


def phrase_search(docs: DataFrame, phrases: DataFrame, doc_key: str, text_col: str, key: str,
                  phrase_col: str) -> DataFrame:
    """(key, doc_key, n_hits, first_pos) for every document that holds the phrase's tokens in a row, any case.

    A phrase without tokens, a null text or a null phrase finds nothing.
    """
    asked = checkpoint(phrase_tokens(phrases, key, phrase_col))
    places = spread(docs.select(doc_key, text_col)).select(
        doc_key, F.posexplode(T.tokens(F.col(text_col))).alias("_pos", "token"))
    postings = checkpoint(places.join(asked.select("token").distinct(), "token", "left_semi").select("token", doc_key, "_pos"))
    freq = postings.groupBy("token").agg(F.count("*").alias("_f"))
    known = asked.join(freq, "token", "left").withColumn("_f", F.coalesce("_f", F.lit(0)))
    driver = top_n_per_key(known, [key], [F.asc("_f"), F.asc("_off")], 1).where("_f > 0").select(key, "_n", "_off", "token")
    starts = (driver.join(postings, "token").where("_pos >= _off")
              .select(key, doc_key, "_n", F.col("_off").alias("_drive"), (F.col("_pos") - F.col("_off")).alias("_start")))
    wanted = (starts.join(asked.select(key, "_off", "token"), key).where("_off <> _drive")
              .select(key, doc_key, "_n", "_start", "token", (F.col("_start") + F.col("_off")).alias("_pos")))
    met = wanted.join(postings, ["token", doc_key, "_pos"], "left_semi")
    whole = (met.groupBy(key, doc_key, "_start", "_n").agg(F.count("*").alias("_have")).where("_have = _n - 1")
             .select(key, doc_key, "_start"))
    single = starts.where("_n = 1").select(key, doc_key, "_start")
    return whole.unionByName(single).groupBy(key, doc_key).agg(
        F.count("*").alias("n_hits"), F.min("_start").alias("first_pos"))
