"""Sentence borders learned from the texts: abbreviations and sentence starters.

A full stop ends a sentence unless its word is an abbreviation, and a plain
regex cannot know abbreviations. Here they are found without labels by the
log-likelihood ratios of Kiss and Strunk, "Unsupervised Multilingual Sentence
Boundary Detection" (2006): a word type that (nearly) always carries a full stop,
short and with inner full stops, is an abbreviation; a type met after
a border far more often than elsewhere starts sentences.

Training is one pass that counts words in context as written, summed map-side first; types are taken of the distinct ones,
all statistics derive from those counts. Splitting cuts a text at every
possible border inside its row; only candidates (key, position, the words
at both sides) meet the learned types, and held borders come back as one
array of positions per text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake.operators.common import checkpoint, spread

# All patterns mean the same in Java and RE2.
WORD_RE = r"[^\x20\x09-\x0D]+"
PIECE_RE = r"""(?s).+?(?:[.!?]+["')\]]*(?:[\x20\x09-\x0D]+|\z)|\z)"""
LAST_RE = r"(?s)\A(?:.*[\x20\x09-\x0D])?([^\x20\x09-\x0D]+)"
CORE_RE = r"(?s)[\p{L}\p{N}](?:.*[\p{L}\p{N}])?"
TRIMMED_RE = r"(?s)[^\x20\x09-\x0D](?:.*[^\x20\x09-\x0D])?"
INITIAL_RE = r"^\p{L}\z"
DOT_RE = r"""\.["')\]]*\z"""
STOP_RE = r"""[.!?]["')\]]*\z"""
#: Last characters of a match of STOP_RE.
MARKS = tuple(""".!?"')]""")
UPPER_RE = r"^[^\p{L}\p{N}]*\p{Lu}"
LOWER_RE = r"^[^\p{L}\p{N}]*\p{Ll}"

#: Least score of an abbreviation and least log-likelihood ratio of a sentence starter (the paper's values).
ABBREVIATION_SCORE = 0.3
STARTER_RATIO = 30.0
#: Chance of a full stop after an abbreviation.
STOP_CHANCE = 0.99
#: Scores are rounded to so many digits before they are compared, so that the order of sums decides nothing.
DIGITS = 9


def word_type(word: Column) -> Column:
    """Lower-cased word without marks at its edges; every run of digits is one 0."""
    return F.regexp_replace(F.lower(F.regexp_extract(word, CORE_RE, 0)), "[0-9]+", "0")


def word_contexts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """(type, dot, upper, lower, prev, n): counts of words in context, over all texts.

    ``dot``: the word ends in a full stop; ``upper``/``lower``: its first letter. ``prev`` is the type of the word
    before if that one ends in a full stop, "" at the start of a text or after another end mark, else null.
    """
    words = spread(texts.select(text_col)).select(F.regexp_extract_all(text_col, F.lit(WORD_RE), F.lit(0)).alias("_w"))
    pairs = F.arrays_zip(F.col("_w").alias("word"), F.concat(F.array(F.lit("")), "_w").alias("before"))
    # An outer generator: the planner would test the size of an inner one's array in a filter, and compute it twice.
    each = words.select(F.inline_outer(pairs)).where("word is not null")
    closing = F.when(F.col("before") == "", F.lit("")).when(
        F.substring("before", -1, 1).isin(*MARKS), F.when(F.col("before").rlike(STOP_RE), F.col("before")))
    # Words as written are counted first: patterns are matched once per distinct word and closing word before it.
    raw = each.groupBy("word", closing.alias("before")).agg(F.count("*").alias("_n"))
    w, b = F.col("word"), F.col("before")
    rows = raw.select(word_type(w).alias("type"), w.rlike(DOT_RE).alias("dot"), w.rlike(UPPER_RE).alias("upper"),
                      w.rlike(LOWER_RE).alias("lower"),
                      F.when(b.rlike(DOT_RE), word_type(b)).when(b.isNotNull(), F.lit("")).alias("prev"), "_n")
    # Asked of the counts, as a filter on the type would be pushed down to every single word.
    n = F.sum(F.when(F.col("type") != "", F.col("_n"))).alias("n")
    return rows.groupBy("type", "dot", "upper", "lower", "prev").agg(n).where("n is not null")


@dataclass
class BorderModel:
    """``abbreviations`` (type, initial) and ``openers`` (type, starter, usual): types that open a sentence."""

    abbreviations: DataFrame
    openers: DataFrame


def _part(k: Column, p: Column) -> Column:
    """k ln p, and 0 where k is 0."""
    return F.when(k > 0, k * F.ln(F.when(k > 0, p))).otherwise(0.0)


def _fit(k: Column, n: Column, p: Column) -> Column:
    """Log-likelihood of k successes in n trials of chance p."""
    return _part(k, p) + _part(n - k, 1 - p)


def train_borders(texts: DataFrame, text_col: str = "text") -> BorderModel:
    """Learn abbreviations and sentence starters from all ``texts`` (null and empty ones add nothing)."""
    seen = checkpoint(word_contexts(texts, text_col))
    n = F.col("n")
    total = seen.agg(F.sum("n").alias("words"), F.sum(F.when(F.col("dot"), n).otherwise(0)).alias("dots")).first()
    words, dots = float(total["words"] or 0), float(total["dots"] or 0)
    types = checkpoint(seen.groupBy("type").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("dot"), n).otherwise(0)).alias("dots"),
        F.sum(F.when(F.col("lower"), n).otherwise(0)).alias("low"),
        F.sum(F.when(F.col("upper") & F.col("prev").isNull(), n).otherwise(0)).alias("inner_upper")))

    d, plain = F.col("dots").cast("double"), (F.col("n") - F.col("dots")).cast("double")
    letters = F.length(F.replace(F.col("type"), F.lit("."), F.lit("")))
    ratio = 2 * (_fit(d, d + plain, F.lit(STOP_CHANCE)) - _fit(d, d + plain, F.lit(dots) / F.lit(max(words, 1.0))))
    # Length and words without a full stop weigh a type down, inner full stops up.
    score = (ratio * (F.length("type") - letters + 1)
             * F.exp(-letters.cast("double") - plain * F.ln(letters.cast("double"))))
    abbreviations = checkpoint(types.where("dots > 0").where(F.round(score, DIGITS) >= ABBREVIATION_SCORE)
                               .select("type", F.col("type").rlike(INITIAL_RE).alias("initial")))

    opened = (seen.where("prev is not null").groupBy("prev", "type").agg(F.sum("n").alias("k"))
              .join(abbreviations.select(F.col("type").alias("prev")), "prev", "left_anti")
              .groupBy("type").agg(F.sum("k").alias("k")))
    opened = checkpoint(opened)
    borders = float(opened.agg(F.sum("k")).first()[0] or 0)
    k, c = F.col("k").cast("double"), F.col("n").cast("double")
    b, rest = F.lit(borders), F.lit(words - borders)
    at, off = k / b, F.when(rest > 0, (c - k) / rest).otherwise(0.0)
    gain = 2 * (_fit(k, b, at) + _fit(c - k, rest, off) - _fit(k, b, c / words) - _fit(c - k, rest, c / words)) if words else F.lit(0.0)
    starter = (F.round(gain, DIGITS) >= STARTER_RATIO) & (at > off)
    openers = (types.join(opened, "type", "left").select(
        "type", F.coalesce(starter, F.lit(False)).alias("starter"),
        ((F.col("low") > 0) & (F.col("inner_upper") == 0)).alias("usual")).where("starter or usual"))
    return BorderModel(abbreviations, checkpoint(openers))


def split_trained(model: BorderModel, texts: DataFrame, keys: list[str], text_col: str = "text",
                  pos_col: str = "sent_pos") -> DataFrame:
    """(keys..., sent_pos, sentence): sentences of each text, in order, stripped, empties dropped.

    Marks followed by white space are possible borders. One behind an abbreviation holds the sentence together
    unless the next word is capitalised and a known starter, or (not after an initial) a word
    otherwise met in lower case and never capitalised inside a sentence. ``keys`` identify a text and are not null.
    """
    src = spread(texts.select(*keys, text_col)).select(
        *keys, F.regexp_extract_all(text_col, F.lit(PIECE_RE), F.lit(0)).alias("_p"))
    sides = F.zip_with("_p", F.slice("_p", F.lit(2), F.size("_p")), lambda a, b: F.struct(
        F.regexp_extract(a, LAST_RE, 1).alias("last"),
        F.regexp_extract(b, WORD_RE, 0).alias("next")))
    cands = (src.select(*keys, F.posexplode_outer(sides).alias("_i", "_s"))
             .where(F.col("_s.last").rlike(DOT_RE) & (F.col("_s.next") != ""))
             .select(*keys, "_i", word_type(F.col("_s.last")).alias("type"), word_type(F.col("_s.next")).alias("_next"),
                     F.col("_s.next").rlike(UPPER_RE).alias("_upper")))
    openers = model.openers.select(F.col("type").alias("_next"), "starter", "usual")
    opens = F.coalesce(F.col("_upper") & (F.col("starter") | (F.col("usual") & ~F.col("initial"))), F.lit(False))
    held = (cands.join(model.abbreviations, "type").join(openers, "_next", "left").where(~opens)
            .groupBy(*keys).agg(F.collect_list(F.col("_i") + 1).alias("_held")))
    size = F.size("_p")
    starts = F.when(size > 0, F.array_except(F.sequence(F.lit(0), size - 1), F.coalesce("_held", F.array().cast("array<int>"))))
    whole = src.join(held, keys, "left").select(*keys, "_p", starts.alias("_a"))
    ends = F.concat(F.slice("_a", F.lit(2), F.size("_a")), F.array(size))
    joined = F.zip_with("_a", ends, lambda a, b: F.regexp_extract(
        F.array_join(F.slice("_p", a + 1, b - a), ""), TRIMMED_RE, 0))
    return (whole.select(*keys, F.posexplode_outer(F.filter(joined, lambda s: s != "")).alias(pos_col, "sentence"))
            .where(F.col("sentence").isNotNull()))
