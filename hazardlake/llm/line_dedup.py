"""Line dedup: repeated runs of lines found with a distributed suffix array.

A document is the sequence of its lines that hold a word; every line is an id.
Prefix doubling ranks the suffixes of all sequences by their first 1, 2, 4, ...
lines: a group of equal rank is refined by the rank of the suffixes that start
that many lines later (one equi-join); a new rank is the group's rank plus the
rows of smaller pairs in it. Pairs are counted before they are ordered, and a
suffix whose prefix occurs once can begin no longer repeat and leaves the array,
so the tables shrink from round to round and a common line brings only its
repeated continuations into one sort.

Each group of equal ranks is an interval of the suffix array whose common
prefix has at least that length. A suffix takes as its copy the earliest member, in order of
(doc_id, text hash, line), of the deepest interval that it is not the earliest of.
Neighbouring suffixes whose copies are neighbours too form one maximal
repeated run: it is as long as their number plus the lines that the last of them surely shares.
Runs of at least ``MIN_LINES`` lines (a power of two) are deleted;
the earliest copy stays. The result is that a line goes exactly if a window of
``MIN_LINES`` lines that holds it starts earlier too.

Lines without a word stay and do not interrupt a run. Null texts are empty and
stay so; a null doc_id counts as the largest number; rows equal in doc_id and
text are one document and are returned as often as they come.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardlake.llm.prefix import running_total
from hazardlake.llm.staging import drop, stage

MIN_LINES = 2
_WORD = r"[^\x20\x09-\x0D]"
_BLANK = " \t\n\x0b\x0c\r"
_NO_ID = np.iinfo(np.int64).max
_AT = ["doc", "hash", "pos"]


def line_rows(rows: DataFrame) -> DataFrame:
    """(doc, hash, pos, h1, h2): one row per line with a word; two hashes and the length identify a line."""
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(_WORD))
    exploded = rows.select("doc", "hash", F.posexplode(lines).alias("pos", "line"))
    return exploded.select(*_AT, F.xxhash64("line").alias("h1"),
                           F.xxhash64(F.lit(1), "line", F.length("line")).alias("h2"))


def _named(rows: DataFrame, groups: DataFrame, pair: list[str], rank: Column) -> DataFrame:
    """``rows`` of the repeated groups with their new rank and the earliest member of their group."""
    named = groups.select(*[F.col(c).alias(f"_{c}") for c in pair], rank.alias("new_rank"), "copy")
    same = [F.col(c) == F.col(f"_{c}") for c in pair]
    return stage(rows.join(named, same).select(*_AT, F.col("new_rank").alias("rank"), "copy"), "level")


def _groups(rows: DataFrame, pair: list[str]) -> DataFrame:
    return (rows.groupBy(*pair).agg(F.count("*").alias("n"), F.min(F.struct(*_AT)).alias("copy")).where("n > 1"))


def _with_next(level: DataFrame, lines: int) -> DataFrame:
    """``level`` rows with ``next``: the rank of the suffix ``lines`` lines later, if that is repeated too."""
    later = level.select("doc", "hash", (F.col("pos") - lines).alias("pos"), F.col("rank").alias("next"))
    return level.select(*_AT, "rank").join(later, _AT)


def suffix_levels(lines: DataFrame) -> list[DataFrame]:
    """Level k: (doc, hash, pos, rank, copy) of all suffixes whose first 2^k lines occur again."""
    pair = ["h1", "h2"]
    order = running_total(_groups(lines, pair), [F.col(c) for c in pair], "before", value="n")
    levels = [_named(lines, order, pair, F.col("before"))]
    drop(order)
    while not levels[-1].isEmpty():
        rows = stage(_with_next(levels[-1], 1 << (len(levels) - 1)), "pairs")
        within = Window.partitionBy("rank").orderBy("next").rowsBetween(Window.unboundedPreceding, -1)
        smaller = F.coalesce(F.sum("n").over(within), F.lit(0))
        groups = _groups(rows, ["rank", "next"]).withColumn("smaller", smaller)
        levels.append(_named(rows, groups, ["rank", "next"], F.col("rank") + F.col("smaller")))
        drop(rows)
    return levels[:-1] or levels


def repeated_runs(levels: list[DataFrame], min_lines: int) -> DataFrame:
    """(doc, hash, pos, len): maximal runs of at least ``min_lines`` lines that have an earlier copy."""
    found = levels[0].where("false").select(*_AT, F.lit(0).alias("k"), "copy")
    for k in range(min_lines.bit_length() - 1, len(levels)):
        later = levels[k].where(F.struct(*_AT) > F.col("copy"))
        found = found.unionByName(later.select(*_AT, F.lit(k).alias("k"), "copy"))
    deepest = found.groupBy(*_AT).agg(F.max(F.struct("k", "copy")).alias("best"))
    copy = F.col("best.copy")
    before = Window.partitionBy("doc", "hash").orderBy("pos")
    goes_on = (F.lag("pos").over(before) == F.col("pos") - 1) & (
        F.lag(copy).over(before) == F.struct(copy["doc"], copy["hash"], copy["pos"] - 1))
    fresh = deepest.withColumn("fresh", F.when(goes_on, F.lit(0)).otherwise(F.lit(1)))
    runs = fresh.withColumn("run", F.sum("fresh").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    return (runs.groupBy("doc", "hash", "run")
            .agg(F.min("pos").alias("pos"), F.max(F.col("pos") + F.expr("shiftleft(1, best.k)")).alias("stop"))
            .select(*_AT, (F.col("stop") - F.col("pos")).alias("len")))


def _cut_mapper(batches):
    for batch in batches:
        ids, out, counts, gone = batch.column(0), [], [], []
        for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            lines = text.split("\n")
            solid = [i for i, x in enumerate(lines) if x.strip(_BLANK)]
            cut = {solid[p] for r in runs or () for p in range(r["pos"], r["pos"] + r["len"])}
            out.append("\n".join(x for i, x in enumerate(lines) if i not in cut) if cut else text)
            counts.append(len(solid))
            gone.append(len(cut))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(counts, pa.int64()), pa.array(gone, pa.int64()),
             pa.array([x or 0 for x in batch.column(3).to_pylist()], pa.int64()), pa.array(out, pa.string())],
            names=["doc_id", "n_lines", "n_removed", "longest_run", "kept_text"])


def remove_repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """(doc_id, n_lines, n_removed, longest_run, kept_text) for every row of documents (doc_id, text, ...)."""
    if min_lines < 1 or min_lines & (min_lines - 1):
        raise ValueError("min_lines must be a power of two")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(int(_NO_ID))).alias("doc"),
                       F.xxhash64(text).alias("hash"), text.alias("text"))
    # One line table per document: rows that repeat a document add nothing.
    lines = stage(line_rows(rows).distinct(), "line_ids")
    levels = suffix_levels(lines)
    runs = repeated_runs(levels, min_lines)
    plan = stage(runs.groupBy("doc", "hash").agg(
        F.collect_list(F.struct("pos", "len")).alias("runs"), F.max("len").alias("longest")), "cuts")
    drop(lines, *levels)
    # Always a shuffle join: the texts take one way at every size.
    out = (rows.join(plan.hint("merge"), ["doc", "hash"], "left").select("doc", "text", "runs", "longest")
           .mapInArrow(_cut_mapper, "doc_id long, n_lines long, n_removed long, longest_run long, kept_text string"))
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(int(_NO_ID))))
