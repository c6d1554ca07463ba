"""Embedding whitening: pivoted Cholesky of the centred scatter, one-sided Jacobi on its triangular factor.

1. Every entry c becomes the integer ``floor(scale * c)``; the fit list holds each distinct
   integer vector once.
2. Sums per dimension are exact. The centred scatter is added up per task (one small matrix
   each) and summed by Spark; the driver only sees dimensions x dimensions numbers.
3. On the driver the covariance V is factored by Cholesky with diagonal pivots, ``V = G G^T``, G
   triangular up to the order of its rows. Plane rotations from the right then make the columns of G orthogonal
   (one-sided Jacobi, all disjoint column pairs of a round at once), without forming V again:
   squared column norms are its eigenvalues and normalised columns its components.
4. The whitened fit list is measured once more (its covariance against the identity), and
   all rows are projected.

Rows whose vector is null or holds null or non-finite entries are dropped, as are vectors whose length is not
the fit list's most frequent one (the longer one of a tie). Repeated rows and null ids all stay. Where V has a
lower rank than the component asked for (equal vectors, one vector), the component has a null ``whitened``
and ``explained`` 0; with rank 0 ``explained`` and ``identity_error`` are null. ``deviation`` is null where it exceeds 64 bits.
An empty table gives no rows. Entries beyond 64 bits saturate (Spark's floor).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardlake.llm.staging import drop, stage

#: Relative size below which two columns count as orthogonal, and sweeps at most.
ORTHOGONAL, SWEEPS = 4 * np.finfo(float).eps, 60
_LONG_MAX = np.iinfo(np.int64).max


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """(G, pivots) with ``v = G G^T``; the rows of G in pivot order are lower triangular, its columns the rank."""
    d = len(v)
    g, left, pivots = np.zeros((d, d)), np.diag(v).copy(), []
    least = d * np.finfo(float).eps * left.max(initial=0.0)
    for k in range(d):
        p = int(np.argmax(left))
        if left[p] <= least:
            break
        root = np.sqrt(left[p])
        column = (v[:, p] - g[:, :k] @ g[p, :k]) / root
        column[pivots], column[p] = 0.0, root
        g[:, k] = column
        left -= column * column
        pivots.append(p)
        left[pivots] = 0.0
    return g[:, :len(pivots)], pivots


def _rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of ``n`` columns as rounds of disjoint pairs (one column rests in a round if n is odd)."""
    ring = list(range(n + n % 2))
    out = []
    for _ in range(len(ring) - 1):
        half = len(ring) // 2
        pairs = [(a, b) for a, b in zip(ring[:half], ring[:half - 1:-1]) if max(a, b) < n]
        out.append((np.array([a for a, _ in pairs], int), np.array([b for _, b in pairs], int)))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


def one_sided_jacobi(g: np.ndarray) -> np.ndarray:
    """``g`` times a rotation that makes its columns orthogonal."""
    g, rounds = g.copy(), _rounds(g.shape[1])
    for _ in range(SWEEPS):
        turned = False
        for left, right in rounds:
            x, y = g[:, left], g[:, right]
            a, b, c = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            turn = np.abs(c) > ORTHOGONAL * np.sqrt(a * b)
            if not turn.any():
                continue
            turned = True
            zeta = (b - a) / (2 * np.where(turn, c, 1.0))
            t = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            cos = 1 / np.hypot(1.0, t)
            g[:, left], g[:, right] = cos * (x - t * y), cos * (t * x + y)
        if not turned:
            break
    return g


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit components as columns) of a positive semidefinite matrix, up to its rank."""
    g = one_sided_jacobi(pivoted_cholesky(v)[0])
    norms = np.sqrt((g * g).sum(0))
    order = np.argsort(-norms, kind="stable")
    return norms[order] ** 2, g[:, order] / norms[order]


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def _sum_mapper(d: int):
    """Exact sums per dimension, as high and low halves that cannot overflow in a task."""
    def run(batches):
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), d)
            n, high, low = n + len(x), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
                                          pa.array(high), pa.array(low)], names=["i", "n", "high", "low"])
    return run


def _scatter_mapper(d: int, mean: np.ndarray, basis: np.ndarray | None = None):
    """Upper triangle of the scatter of centred (and projected) vectors, one matrix per task."""
    def run(batches):
        k = d if basis is None else basis.shape[1]
        total = np.zeros((k, k))
        for batch in batches:
            y = _matrix(batch.column(0), d) - mean
            y = y if basis is None else y @ basis
            total += y.T @ y
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                          pa.array(total[i, j])], names=["i", "j", "v"])
    return run


def _scatter(fit: DataFrame, d: int, mean: np.ndarray, basis: np.ndarray | None = None) -> np.ndarray:
    k = d if basis is None else basis.shape[1]
    out = np.zeros((k, k))
    parts = fit.mapInArrow(_scatter_mapper(d, mean, basis), "i int, j int, v double")
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.i, r.j] = out[r.j, r.i] = r.v
    return out


def deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Exact ``sum((n * x - total)^2)`` per row; None beyond 64 bits."""
    most = n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(map(abs, total), default=0)
    if len(total) * most * most <= _LONG_MAX:
        y = n * x - np.array(total, np.int64)
        return (y * y).sum(1).tolist()
    exact = (sum((n * a - s) ** 2 for a, s in zip(row, total)) for row in x.tolist())
    return [v if v <= _LONG_MAX else None for v in exact]


def _project_mapper(d: int, n: int, total: list[int], basis: np.ndarray, explained: list, error: float | None):
    mean = np.array([s / n for s in total])

    def run(batches):
        k, ranked = len(explained), basis.shape[1]
        for batch in batches:
            x = _matrix(batch.column(1), d)
            white = np.full((len(x), k), np.nan)
            white[:, :ranked] = (x - mean) @ basis
            missing = np.isnan(white).ravel()
            row = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(row), n)), pa.array(deviations(x, n, total), pa.int64()).take(row),
                 pa.array(white.ravel(), mask=missing), pa.array(explained * len(x), pa.float64()),
                 pa.array([error] * len(row), pa.float64())],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(vectors: DataFrame, components: int = 4, scale: int = 256) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for (vec_id, embedding, ...).

    One row per kept row and component 1 to min(components, dimensions).
    """
    spark, entry = vectors.sparkSession, F.col("embedding")
    finite = F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = (vectors.where(F.coalesce(finite, F.lit(False)))
            .select("vec_id", F.transform(entry, lambda c: F.floor(c.cast("double") * scale)).alias("x")))
    schema = T.StructType([vectors.schema["vec_id"], *T._parse_datatype_string(
        "component int, n long, deviation long, whitened double, explained double, identity_error double").fields])
    fit = stage(rows.select("x").distinct(), "fit")
    lengths = fit.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths or not lengths[0].d:
        drop(fit)
        return spark.createDataFrame([], schema)
    d = lengths[0].d
    fitted = fit.where(F.size("x") == d)
    sums = (fitted.mapInArrow(_sum_mapper(d), "i int, n long, high long, low long").groupBy("i")
            .agg(F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")])
            .orderBy("i").collect())
    n = sums[0].n
    total = [(int(r.high) << 32) + int(r.low) for r in sums]
    mean = np.array([s / n for s in total])
    v = _scatter(fitted, d, mean) / n
    values, parts = eigen(v)
    k, trace = min(components, d), float(np.trace(v))
    values, basis = values[:k], parts[:, :k] / np.sqrt(values[:k])
    error = None
    if len(values):
        error = float(np.abs(_scatter(fitted, d, mean, basis) / n - np.eye(len(values))).max())
    explained = [e / trace for e in values.tolist()] + [0.0 if trace else None] * (k - len(values))
    drop(fit)
    return (rows.where(F.size("x") == d).select("vec_id", "x")
            .mapInArrow(_project_mapper(d, n, total, basis, explained, error), schema))
