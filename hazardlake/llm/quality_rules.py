"""Quality rules whose cutoffs carry an exact false-rejection guarantee.

Signals of each text are compared with cutoffs chosen per stratum (language).
Labelled documents of good quality are the holdout: for a rule and a cutoff,
the number of good holdout documents it would reject is binomial, and the cutoff
is allowed only if P(Binomial(n, alpha_rule) <= observed) <= delta_test, that is
if the exact (Clopper-Pearson) upper bound of the false-rejection rate is at
most alpha_rule. Cutoff grids are fixed beforehand and tested from lenient to
strict, so one test level serves a whole grid (fixed-sequence testing); the
rules and strata share ``delta`` by Bonferroni, and the rules of a stratum share
``alpha``. With probability 1 - delta no stratum loses more than ``alpha`` of
its good documents to the rules. A stratum with too few good labels gets no
cutoff for a rule, and that rule then rejects nothing there.

Everything is built-in expressions; a text is worked on inside its row in
n log n steps, and only narrow signal rows are shuffled.

Defined results: null text counts as empty (all counts 0, base fails); a null
language is a stratum of its own; labels that are null or contradict
each other do not count as good; without labels only the base rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardlake.llm.staging import bounded, stage

ALPHA, DELTA = 0.03, 0.05
MIN_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5
_GAP = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"

#: rule -> (signal, cutoffs from lenient to strict); a document is rejected above the cutoff.
RULES = {
    "symbols_per_word": ("try_divide(n_symbols, n_words)", [3.0, 2.0, 1.5, 1.0, 0.75, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05]),
    "dup_line_share": ("try_divide(n_dup_lines, n_lines)", [0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2]),
    "repeat_share": ("try_divide(n_repeat_words, n_words)", [0.18, 0.16, 0.14, 0.12, 0.1, 0.08, 0.06, 0.04]),
    "sameness": ("1 - try_divide(n_distinct_words, n_words)", [0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.65, 0.6]),
    "mean_word_long": ("try_divide(word_chars, n_words)", [20.0, 15.0, 12.0, 10.0, 9.0, 8.5, 8.0, 7.5, 7.0, 6.5]),
    "mean_word_short": ("try_divide(n_words, word_chars)", [0.5, 0.4, 0.33, 0.3, 0.28, 0.26, 0.25, 0.24, 0.23, 0.22]),
}


def signals(docs: DataFrame) -> DataFrame:
    """(doc_id, stratum, text_hash, counts..., base_failed) for each row of documents (doc_id, text, lang)."""
    d = docs.select(F.col("doc_id"), F.col("lang").alias("stratum"),
                    F.coalesce(F.col("text"), F.lit("")).alias("text"))
    d = d.withColumn("words", F.array_remove(F.split("text", _GAP), ""))
    d = d.withColumn("n_words", F.size("words").cast("long"))
    d = d.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(_WORD)))
    w = F.lit(WINDOW)
    d = d.withColumn("grams", F.when(F.col("n_words") >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size("words") - w + 1), lambda i: F.xxhash64(F.slice("words", i, w)))))
    d = d.withColumn("some_repeat", F.size("grams") > F.size(F.array_distinct("grams")))
    d = d.withColumn("ranked", F.when(F.col("some_repeat"), F.sort_array(F.transform(
        "grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = F.zip_with("ranked", F.slice("ranked", F.lit(2), F.size("ranked")),
                      lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False)))
    d = d.withColumn("same", F.when(F.col("some_repeat"), same))
    before = F.slice(F.concat(F.array(F.lit(False)), F.col("same")), F.lit(1), F.size("same"))
    either = F.zip_with("same", before, lambda a, b: a | b)
    at = F.array_sort(F.array_compact(F.zip_with("ranked", either, lambda x, hit: F.when(hit, x["i"]))))
    covered = F.aggregate(at, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
                          lambda acc, p: F.struct(p.alias("last"),
                                                  (acc["n"] + F.least(w, p - acc["last"])).alias("n")),
                          lambda acc: acc["n"])
    d = d.select(
        "doc_id", "stratum", F.xxhash64("text").alias("text_hash"), "n_words",
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("some_repeat"), covered).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct_words"))
    return d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))


def largest_allowed(n: Column, alpha: float, delta: Column) -> Column:
    """Largest k with P(Binomial(n, alpha) <= k) <= delta; -1 if there is none.

    The terms are carried as logarithms, so large n does not underflow.
    """
    p = F.lit(alpha)
    odds = F.log(p / (1 - p))

    def step(acc, i):
        cdf = acc["cdf"] + F.exp(acc["log_term"])
        best = F.when(cdf <= delta, i).otherwise(acc["best"])
        return F.struct((acc["log_term"] + F.log((n - i) / (i + 1)) + odds).alias("log_term"),
                        cdf.alias("cdf"), best.alias("best"))

    start = F.struct((n * F.log(1 - p)).alias("log_term"), F.lit(0.0).alias("cdf"),
                     F.lit(-1).cast("long").alias("best"))
    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.least(F.floor(n * p), n - 1)), start, step,
                       lambda acc: acc["best"])


def _first_hit(signal: Column, cuts: list[float]) -> Column:
    """1-based index of the most lenient cutoff below ``signal``; one past the end if none."""
    return F.lit(len(cuts) + 1) - F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: signal > c))


def calibrate(sig: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, rule -> cutoff columns): the strictest cutoffs that the good labelled rows allow."""
    good = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
            .agg(F.min("quality").alias("q")).where("q = 1").select("doc_id"))
    held = sig.where("not base_failed").join(good, "doc_id", "left_semi")
    index = [F.struct(F.lit(name).alias("rule"), _first_hit(F.expr(value), cuts).alias("first"))
             for name, (value, cuts) in RULES.items()]
    # "first": 1-based index of the most lenient cutoff that rejects the document.
    counts = (held.select("stratum", F.inline(F.array(*index))).groupBy("stratum", "rule", "first")
              .agg(F.count("*").alias("docs")))
    whole = Window.partitionBy("stratum", "rule")
    so_far = whole.orderBy("first").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = stage(counts.select("*", F.sum("docs").over(whole).alias("n"),
                                 F.sum("docs").over(so_far).alias("rejected")), "rule_counts")
    strata = counts.select("stratum").distinct().count()
    level = F.lit(delta / max(1, strata * len(RULES)))
    limits = (counts.select("stratum", "rule", "n").distinct()
              .withColumn("allowed", largest_allowed(F.col("n"), alpha / len(RULES), level)))
    seen = counts.alias("c").join(limits.alias("l"), F.expr(
        "c.rule = l.rule and c.stratum <=> l.stratum and c.rejected > l.allowed"), "right")
    grids = F.create_map(*[x for name, (_, cuts) in RULES.items()
                           for x in (F.lit(name), F.array(*map(F.lit, cuts)))])
    picked = (seen.groupBy("l.stratum", "l.rule", "l.allowed").agg(F.min("c.first").alias("bad"))
              .withColumn("grid", grids[F.col("rule")]))
    last_good = F.least(F.coalesce(F.col("bad"), F.size("grid") + 1), F.size("grid") + 1) - 1
    cutoff = F.when(F.col("allowed") >= 0, F.try_element_at("grid", F.nullif(last_good, F.lit(0))))
    return (picked.select("stratum", "rule", cutoff.alias("cutoff"))
            .groupBy("stratum").pivot("rule", list(RULES)).agg(F.first("cutoff")))


def verdicts(sig: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Signals plus ``failed_rules`` (comma-joined) and ``kept``."""
    strata = stage(cutoffs.withColumnRenamed("stratum", "of"), "cutoffs")
    d = sig.join(bounded(strata, 200), sig.stratum.eqNullSafe(strata.of), "left").drop("of")
    failed = F.array_join(F.array_compact(F.array(*[
        F.when(~F.col("base_failed") & (F.expr(value) > F.col(name)), F.lit(name))
        for name, (value, _) in RULES.items()])), ",")
    d = d.withColumn("failed_rules", failed).drop(*RULES)
    return d.withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))


def quality_rules(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per document: its signals, ``base_failed``, ``failed_rules`` and ``kept``."""
    sig = stage(signals(docs), "signals")
    return verdicts(sig, calibrate(sig, labels, alpha, delta))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass the rules, with their own columns."""
    bad = stage(quality_rules(docs, labels).where("not kept").select(
        F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")), "rejected")
    same = docs["doc_id"].eqNullSafe(bad["bad_id"]) & (
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == bad["bad_hash"])
    return docs.join(bounded(bad, 32), same, "left_anti")
