"""Extractive summaries: sentence-graph centrality (TextRank) and sections.

Graph: sentences of one group are nodes; with T_i the distinct tokens of sentence i,
``w(i,j) = |T_i & T_j| / (ln|T_i| + ln|T_j|)``; pairs with a denominator that is not positive have no edge.
The weight does not factorise over tokens, but it does per pair of set sizes. So sums are kept per
cell, a token of a group together with a set size s: ``U(t,s) = sum of r_i / W_i over i with t in T_i and |T_i| = s``.
Inside a token the cells exchange ``Y(t,s') = sum_s U(t,s) / (ln s + ln s')``, and one PageRank step

    r'(j) = (1-d) + d * sum_{i != j} w(i,j) / W(i) * r(i)

is ``(1-d) + d * (sum_{t in T_j} Y(t,|T_j|) - the sentence's own part)``. No sentence pair is ever
materialised: a step is linear in the (sentence, token) incidences, plus the square of the number of
sizes per token, whatever the size of a group. The incidences never move after their layout: they lie in
pieces of sentences of one group and set size, so that nearly all of a cell's incidences are in one piece, and
a step shuffles one sum per (piece, cell) each way. Steps end when scores change by no more than a tolerance on average.

Groups share no edge. One with few incidences therefore needs no shuffle in a step at all: such groups are dealt over tasks whole,
take all steps there by the same sums, and keep their score after each; the mean change that ends the steps is over all groups of either kind.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.functions import text as T
from hazardlake.functions.lookups import SECTION_LABELS
from hazardlake.operators.common import (bucketed_copy, delete_path, drop_table, joined_in_place,
                                         rank_within_groups, staged_copy)

#: Mean change of a score at which the steps end, and steps at most.
TOLERANCE, STEPS = 1e-3, 20

#: Pieces of incidences that a partition gets at least, incidences of a bucket at most, and (group, size) classes that are broadcast.
PIECES, BUCKET_ROWS, SMALL = 8, 4_000_000, 100_000

#: Incidences of a group that a task takes whole, and of a task with such groups; (cell, cell) pairs of a token that are kept from step to step.
WHOLE, TASK_ROWS, KEPT_PAIRS = 200_000, 500_000, 2_000_000


def _group(keys: list[str]):
    """One non-null text per group; null keys are groups like any other."""
    return F.to_json(F.struct(*keys))


def _inverse_logs(a, b):
    """1 / (ln a + ln b), or 0 where that is not positive."""
    return F.when(a * b > 1, F.lit(1.0) / F.ln((a * b).cast("double"))).otherwise(F.lit(0.0))


class _Cells:
    """Cells of a few whole groups: incidences (group, token, set size) that are equal are one cell."""

    def __init__(self, group: np.ndarray, token: np.ndarray, size: np.ndarray):
        sizes, rank = np.unique(size, return_inverse=True)
        _, token = np.unique(group * (int(token.max()) + 1) + token, return_inverse=True)
        cells, self.of = np.unique(token * len(sizes) + rank, return_inverse=True)
        self.size = sizes[cells % len(sizes)]
        _, first, count = np.unique(cells // len(sizes), return_index=True, return_counts=True)
        self.start, self.count = np.repeat(first, count), np.repeat(count, count)
        ends = np.cumsum(self.count)
        cuts = np.flatnonzero(np.diff(ends // KEPT_PAIRS)) + 1
        self.blocks = list(zip([0, *cuts], [*cuts, len(cells)], strict=True))
        self.kept = [self._pairs(*self.blocks[0])] if len(self.blocks) == 1 else None

    def _pairs(self, a: int, b: int):
        """For cells a to b: place of the cell, each cell of its token, and 1 / (ln s + ln s')."""
        count = self.count[a:b]
        left = np.repeat(np.arange(b - a), count)
        right = np.repeat(self.start[a:b] - (np.cumsum(count) - count), count) + np.arange(len(left))
        return left, right, _inverse_logs_of(self.size[a:b][left] * self.size[right])

    def exchange(self, u: np.ndarray) -> np.ndarray:
        """Y(t, s') = sum of U(t, s) / (ln s + ln s') over the cells of each token."""
        y = np.empty(len(self.size))
        for i, (a, b) in enumerate(self.blocks):
            left, right, w = self.kept[i] if self.kept else self._pairs(a, b)
            y[a:b] = np.bincount(left, u[right] * w, b - a)
        return y


def _inverse_logs_of(product: np.ndarray) -> np.ndarray:
    return np.where(product > 1, 1.0 / np.log(np.maximum(product, 2).astype(float)), 0.0)


def _steps_of(group: np.ndarray, token: np.ndarray, size: np.ndarray, damping: float, iterations: int) -> np.ndarray:
    """Scores (sentence, step) of whole groups, at first and after each step; group, size: per sentence, token: flat."""
    n, at = len(size), np.repeat(np.arange(len(size)), size)
    cells = _Cells(group[at], token, size[at])

    def summed(x: np.ndarray) -> np.ndarray:
        return np.bincount(at, cells.exchange(np.bincount(cells.of, x[at], len(cells.size)))[cells.of], n)

    own = size * _inverse_logs_of(size * size)
    w = summed(np.ones(n)) - own
    r = np.ones((iterations + 1, n))
    for k in range(iterations):
        x = np.where(w > 1e-12, r[k] / np.where(w > 1e-12, w, 1.0), 0.0)
        r[k + 1] = (1.0 - damping) + damping * np.maximum(0.0, summed(x) - own * x)
    return r.T


def _whole_mapper(damping: float, iterations: int):
    """(_id, _g, _toks) sorted by _g -> (_id, _rs): as many groups at a time as make WHOLE incidences."""
    def scored(rows: pa.Table) -> pa.RecordBatch:
        toks = rows.column("_toks").combine_chunks()
        token = toks.flatten().dictionary_encode().indices.to_numpy().astype(np.int64)
        group = rows.column("_g").combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
        size = toks.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        rs = _steps_of(group, token, size, damping, iterations)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rs) + 1) * (iterations + 1), pa.int32()), pa.array(rs.ravel()))
        return pa.RecordBatch.from_arrays([rows.column("_id").combine_chunks(), lists], names=["_id", "_rs"])

    def run(batches):
        held, many = [], 0
        for batch in batches:
            g = batch.column("_g").dictionary_encode().indices.to_numpy()
            size = batch.column("_toks").value_lengths().to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(g)) + 1), len(g)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b == a:
                    continue
                new = not held or a or held[-1].column("_g")[-1] != batch.column("_g")[0]
                if new and many >= WHOLE:
                    yield scored(pa.Table.from_batches(held))
                    held, many = [], 0
                held.append(batch.slice(a, b - a))
                many += int(size[a:b].sum())
        if held:
            yield scored(pa.Table.from_batches(held))
    return run


def _whole_groups(words: DataFrame, total: int, damping: float, iterations: int):
    """(_id, _rs) with the scores at first and after each step; their summed changes per step; the number of sentences."""
    tasks = max(words.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_ROWS))
    rows, _ = staged_copy(words.select("_id", "_g", "_toks").repartition(tasks, "_g").sortWithinPartitions("_g")
                          .mapInArrow(_whole_mapper(damping, iterations), "_id long, _rs array<double>"), "whole_scores")
    sums = rows.agg(F.count("*"), *[F.sum(F.abs(F.col("_rs")[k + 1] - F.col("_rs")[k])) for k in range(iterations)]).first()
    return rows, [x or 0.0 for x in sums[1:]], sums[0]


def _scores(nodes: DataFrame, text_col: str, damping: float, iterations: int,
            salt_buckets: int | None, tolerance: float = TOLERANCE) -> DataFrame:
    """(_id, score) for nodes (_id, _g, text).

    Groups of at most ``WHOLE`` incidences are dealt over tasks and take their steps there (none if ``salt_buckets`` is
    given); the others lie in pieces, see ``_in_pieces``. Both follow the same sums and end at the same step.
    """
    spark = nodes.sparkSession
    # In a one-element array the tokens are computed once, not again for each use.
    toks = F.explode(F.array(F.array_distinct(T.tokens(F.col(text_col))))).alias("_toks")
    words, words_at = staged_copy(nodes.select("_id", "_g", toks).where(F.size("_toks") > 0)
                                  .select("_id", "_g", F.size("_toks").cast("long").alias("_s"), "_toks"), "words")
    groups = words.groupBy("_g").agg(F.sum("_s").alias("_n"))
    small = F.col("_n") <= (0 if salt_buckets else WHOLE)
    held = groups.agg(F.sum(F.when(small, F.col("_n"))), F.sum(F.when(~small, F.col("_n"))), F.count_if(~small)).first()
    n_small, n_large = held[0] or 0, held[1] or 0
    few, many = words, words
    if n_small and n_large:
        large = groups.where(~small).select("_g")
        large = F.broadcast(large) if held[2] <= SMALL else large
        few, many = words.join(large, "_g", "left_anti"), words.join(large, "_g", "left_semi")
    parts, changes, n = [], [0.0] * iterations, 0
    if n_small:
        whole, changes, n = _whole_groups(few, n_small, damping, iterations)

    def ended(k: int, change: float, others: int) -> bool:
        return n + others == 0 or (changes[k] + change) / (n + others) <= tolerance

    steps = 0
    if n_large:
        node, steps = _in_pieces(many, n_large, damping, iterations, salt_buckets, ended, words_at)
        parts.append(node)
    else:
        while steps < iterations:
            steps += 1
            if ended(steps - 1, 0.0, 0):
                break
        delete_path(spark, words_at)
    if n_small:
        parts.append(whole.select("_id", F.col("_rs")[steps].alias("_r")))
    if not parts:
        return nodes.select("_id", F.lit(1.0 - damping).alias("score"))
    return (nodes.select("_id").join(reduce(DataFrame.unionByName, parts), "_id", "left")
            .select("_id", F.coalesce("_r", F.lit(1.0 - damping)).alias("score")))


def _in_pieces(words: DataFrame, total: int, damping: float, iterations: int, salt_buckets: int | None, ended, words_at: str):
    """(_id, _r) after the last step, and how many steps it took; deletes the files at ``words_at`` when they are laid out.

    The (sentence, token) incidences are laid out once, bucketed by piece, and never move again. A
    piece holds sentences of one group and set size; a class of these with more than ~1/(8P) of all
    incidences is cut into as many pieces as that needs (``salt_buckets`` at most), so no task gets a large class or a
    hot token alone. Each step sums per (piece, cell), gives the sums to the cell's token, where its
    sizes meet, and brings each result back to the pieces that hold the cell. The
    per-sentence state is written after each step, which also gives the change; ``ended(step, its sum, sentences)`` tells when to stop.
    """
    spark = words.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets, most = max(parts, total // BUCKET_ROWS), max(1, total // (parts * PIECES))
    cuts = F.ceil(F.col("_n") * F.col("_s") / F.lit(most))
    classes, classes_at = staged_copy(words.groupBy("_g", "_s").agg(F.count("*").alias("_n")).select(
        "_g", "_s", (F.least(cuts, F.lit(salt_buckets)) if salt_buckets else cuts).alias("_ns")), "classes")
    classes = F.broadcast(classes) if classes.count() <= SMALL else classes
    inc = words.join(classes, ["_g", "_s"]).select(
        "_id", "_g", "_s", F.xxhash64("_g", "_s", F.pmod(F.xxhash64("_id"), F.col("_ns"))).alias("_p"),
        F.explode("_toks").alias("_t"))
    tokens = words.select("_g", "_s", F.explode("_toks").alias("_t")).distinct().groupBy("_g", "_t").agg(
        F.collect_list("_s").alias("_sizes")).withColumn("_tid", F.monotonically_increasing_id())
    cells, cells_at = staged_copy(tokens.select("_g", "_t", "_tid", F.explode("_sizes").alias("_s")), "cells")
    by_piece, t1 = bucketed_copy(inc.join(cells.hint("shuffle_hash"), ["_g", "_t", "_s"]).select("_p", "_id", "_tid", "_s"),
                                 ["_p"], buckets, "inc_by_piece")
    t2, node_at, steps = None, None, 0
    try:
        for path in (words_at, classes_at, cells_at):
            delete_path(spark, path)
        places, t2 = bucketed_copy(by_piece.select("_p", "_tid", "_s").distinct(), ["_tid"], buckets, "cell_pieces")

        def summed(x: DataFrame) -> DataFrame:
            """(_p, _id, _su): for each sentence the sum of w(i, j) x_i over all i, itself included; x: (_p, _id, _x)."""
            piece = (by_piece.join(x.hint("shuffle_hash"), ["_p", "_id"])
                     .groupBy("_p", "_tid", "_s").agg(F.sum("_x").alias("_u")))
            cell = piece.select("_tid", "_s", "_u").repartition(buckets, "_tid").groupBy("_tid", "_s").agg(F.sum("_u").alias("_u"))
            other = cell.select("_tid", F.col("_s").alias("_s2"), F.col("_u").alias("_u2"))
            given = (cell.select("_tid", "_s").join(other, "_tid").groupBy("_tid", "_s")
                     .agg(F.sum(F.col("_u2") * _inverse_logs(F.col("_s"), F.col("_s2"))).alias("_y")))
            back = places.join(given.hint("shuffle_hash"), ["_tid", "_s"]).select("_p", "_tid", "_s", "_y")
            return (by_piece.join(back.hint("shuffle_hash"), ["_p", "_tid", "_s"])
                    .groupBy("_p", "_id").agg(F.sum("_y").alias("_su")))

        own = F.col("_s") * _inverse_logs(F.col("_s"), F.col("_s"))
        sizes = by_piece.groupBy("_p", "_id").agg(F.first("_s").alias("_s"))
        x = F.when(F.col("_w") > 1e-12, F.col("_r") / F.col("_w")).otherwise(F.lit(0.0))
        with joined_in_place(spark):
            node, node_at = staged_copy(
                sizes.join(summed(sizes.select("_p", "_id", F.lit(1.0).alias("_x"))).hint("shuffle_hash"), ["_p", "_id"])
                .select("_p", "_id", own.alias("_own"), (F.col("_su") - own).alias("_w"), F.lit(1.0).alias("_r")), "scores")
            while steps < iterations:
                now = node.withColumn("_x", x)
                su = summed(now.select("_p", "_id", "_x")).hint("shuffle_hash")
                step, step_at = staged_copy(now.join(su, ["_p", "_id"], "left").select(
                    "_p", "_id", "_own", "_w", F.col("_r").alias("_before"),
                    (F.lit(1.0 - damping) + F.lit(damping) * F.greatest(
                        F.lit(0.0), F.coalesce("_su", F.lit(0.0)) - F.col("_own") * F.col("_x"))).alias("_r")), "scores")
                change, sentences = step.agg(F.sum(F.abs(F.col("_r") - F.col("_before"))), F.count("*")).first()
                delete_path(spark, node_at)
                node, node_at, steps = step.drop("_before"), step_at, steps + 1
                if ended(steps - 1, change or 0.0, sentences):
                    break
    finally:
        drop_table(spark, t1)
        if t2:
            drop_table(spark, t2)
    return node.select("_id", "_r"), steps


def _nodes(df: DataFrame, keys: list[str]) -> DataFrame:
    return staged_copy(df.withColumn("_g", _group(keys)).withColumn("_id", F.monotonically_increasing_id()), "nodes")[0]


def textrank_scores(sentences: DataFrame, keys: list[str], pos: list[str], text_col: str,
                    damping: float = 0.85, iterations: int = STEPS,
                    salt_buckets: int | None = None) -> DataFrame:
    """(keys..., pos..., score) for every sentence; isolated ones get 1-d."""
    nodes = _nodes(sentences.select(*keys, *pos, text_col), keys)
    return (nodes.join(_scores(nodes, text_col, damping, iterations, salt_buckets), "_id")
            .select(*keys, *pos, "score"))


def summarize(sentences: DataFrame, keys: list[str], pos: list[str], text_col: str,
              ratio: float = 0.2, damping: float = 0.85, iterations: int = STEPS,
              salt_buckets: int | None = None, digits: int = 9) -> DataFrame:
    """(keys..., pos..., sentence, score): the selected sentences, distinct
    by text (first position kept); sort by ``pos`` for the original order.

    ``ceil(ratio * n)`` of a group's n distinct sentences are kept, best score
    first, ties by position; a group of one sentence is kept whole. The
    position is any tuple of columns, never packed into one number.
    """
    first = (sentences.groupBy(*keys, text_col).agg(F.min(F.struct(*pos)).alias("_p"))
             .select(*keys, *[F.col("_p")[p].alias(p) for p in pos], text_col))
    nodes = _nodes(first, keys)
    scored = (nodes.select("_id", "_g", *pos)
              .join(_scores(nodes, text_col, damping, iterations, salt_buckets), "_id")
              .withColumn("_sc", F.round("score", digits)))
    sizes = nodes.groupBy("_g").agg(F.count("*").alias("_n"))
    ranked = rank_within_groups(scored, ["_g"], [F.desc("_sc"), *[F.asc(p) for p in pos]], "_rk").join(sizes, "_g")
    chosen = ranked.where(F.col("_rk") <= F.ceil(F.col("_n") * F.lit(ratio))).select("_id", "score")
    return nodes.join(chosen, "_id").select(*keys, *pos, text_col, "score")


def label_sections(predictions: DataFrame, keys: list[str], pos: list[str],
                   text_col: str = "sentence", label_col: str = "label", ratio: float = 0.2) -> DataFrame:
    """(keys..., section, n_sentences, section_text) for the report sections.

    Labels are trimmed (one stored class name carried a trailing space) and
    mapped to section titles; ``other`` has no section. The text of a section
    is the summary of its sentences: the top ``ratio`` by TextRank within
    (keys, section), distinct, in position order, space-joined. Only the
    summary is gathered per section.
    """
    mapping = F.create_map(*[x for s, lab in SECTION_LABELS for x in (F.lit(lab), F.lit(s))])
    labelled = predictions.withColumn("section", F.try_element_at(mapping, F.trim(F.col(label_col))))
    labelled = labelled.where(F.col("section").isNotNull()).select(*keys, "section", *pos, text_col)
    return (summarize(labelled, [*keys, "section"], pos, text_col, ratio)
            .groupBy(*keys, "section")
            .agg(F.count("*").alias("n_sentences"),
                 F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*pos, text_col))),
                                          lambda e: e[text_col]), " ").alias("section_text")))
