"""Sentence classification: score vectors, argmax, votes, a trained model.

The source pipeline ran a fine-tuned transformer one sentence at a time. Here
the model is a multinomial Naive Bayes over tokens: fitting is one counting
aggregation, scoring one equi-join on the token and one sum per sentence.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake.functions import text as T
from hazardlake.functions.lookups import CLASS_NAMES
from hazardlake.operators.common import checkpoint


def argmax(scores: Column) -> Column:
    """0-based index of the first maximum (``np.argmax`` tie rule)."""
    return F.array_position(scores, F.array_max(scores)) - 1


def class_name(index: Column, names: list[str] = CLASS_NAMES) -> Column:
    return F.try_element_at(F.array(*[F.lit(n) for n in names]), index.cast("int") + 1)


def label_scores(df: DataFrame, scores_col: str, names: list[str] = CLASS_NAMES) -> DataFrame:
    """Add ``pred_idx`` and ``label`` from a per-class score array."""
    return (df.withColumn("pred_idx", argmax(F.col(scores_col)))
            .withColumn("label", class_name(F.col("pred_idx"), names)))


def majority_vote(votes: DataFrame, key: str, label_col: str = "label",
                  names: list[str] = CLASS_NAMES) -> DataFrame:
    """(key, label, votes): the most-voted class per key.

    ``votes`` has one row per (key, model). Ties go to the class declared
    first in ``names``. Two aggregations, both partial on the map side.
    """
    names_arr = F.array(*[F.lit(n) for n in names])
    pos = F.array_position(names_arr, F.col(label_col))           # 1-based, 0 = unknown
    rank = F.when(pos == 0, F.lit(len(names) + 1)).otherwise(pos)    # unknown labels rank last
    counts = votes.groupBy(key, label_col).agg(F.count("*").alias("votes"))
    # One exact decimal whose max is the most votes, ties to the earliest
    # declared class -- a plain max, a hash aggregate, for any count and number of classes.
    base = F.lit(len(names) + 2).cast("decimal(10,0)")
    enc = F.col("votes").cast("decimal(19,0)") * base + (len(names) + 1 - rank).cast("decimal(10,0)")
    best = counts.groupBy(key).agg(F.max(enc).alias("_e"))
    idx = (len(names) + 1 - F.col("_e") % base).cast("int")
    return best.select(key, F.try_element_at(names_arr, F.nullif(idx, F.lit(0))).alias(label_col),
                       F.floor(F.col("_e") / base).cast("long").alias("votes"))


@dataclass
class NaiveBayes:
    """Token counts per class (token, c0..ck) and the classes' totals."""

    counts: DataFrame
    documents: list[int]
    tokens: list[int]
    vocabulary: int


def fit_naive_bayes(labelled: DataFrame, text_col: str, class_col: str, n_classes: int = len(CLASS_NAMES)) -> NaiveBayes:
    """Fit on all rows (text, class 0..n-1); rows without a class are left out."""
    rows = labelled.where(F.col(class_col).between(0, n_classes - 1))
    toks = rows.select(F.col(class_col).alias("_c"), F.explode(T.tokens(F.col(text_col))).alias("token"))
    per = [F.count_if(F.col("_c") == i).alias(f"c{i}") for i in range(n_classes)]
    counts = checkpoint(toks.groupBy("token").agg(*per))
    totals = counts.agg(F.count("*").alias("v"), *[F.sum(f"c{i}").alias(f"c{i}") for i in range(n_classes)]).first()
    docs = rows.agg(*[F.count_if(F.col(class_col) == i).alias(f"c{i}") for i in range(n_classes)]).first()
    return NaiveBayes(counts, [docs[f"c{i}"] for i in range(n_classes)],
                      [totals[f"c{i}"] or 0 for i in range(n_classes)], totals["v"])


def classify_sentences(model: NaiveBayes, sentences: DataFrame, keys: list[str], text_col: str = "sentence",
                       names: list[str] = CLASS_NAMES, digits: int = 6) -> DataFrame:
    """``sentences`` with ``pred_idx`` and ``label``: the class of the largest posterior.

    score(c) = ln prior(c) + sum over tokens of ln((count(token, c) + 1) / (tokens(c) + vocabulary)),
    rounded so that float noise cannot decide; ties go to the first class; a
    class without training rows is never chosen. ``keys`` identify a sentence.
    """
    n = len(model.documents)
    base = checkpoint(sentences)
    each = (base.select(*keys, F.explode(T.tokens(F.col(text_col))).alias("token"))
            .join(model.counts, "token", "left")
            .groupBy(*keys).agg(F.count("*").alias("_n"), *[
                F.sum(F.ln(F.coalesce(f"c{i}", F.lit(0)) + 1.0)).alias(f"_s{i}") for i in range(n)]))
    total, scores = sum(model.documents), []
    for i in range(n):
        if model.documents[i]:
            s = (F.ln(F.lit(model.documents[i] / total)) + F.coalesce(f"_s{i}", F.lit(0.0))
                 - F.coalesce("_n", F.lit(0)) * F.ln(F.lit(float(model.tokens[i] + model.vocabulary))))
            scores.append(F.round(s, digits))
        else:
            scores.append(F.lit(float("-inf")))
    best = argmax(F.array(*scores)).cast("int")
    return (base.join(each, keys, "left").withColumn("pred_idx", best)
            .withColumn("label", class_name(F.col("pred_idx"), names))
            .drop("_n", *[f"_s{i}" for i in range(n)]))
