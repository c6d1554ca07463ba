"""Whitening against a dense eigensolver and plain integer arithmetic."""

import math

import numpy as np
import pytest
from conftest import SF_SMALL

from hazardlake.llm import whitening as W
from hazardlake.llm.queries import op11_whitening

SCHEMA = "vec_id long, embedding array<float>, x int, n string, component string, whitened string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "a", "b", "c") for i, v in rows], SCHEMA)


def ordered(pairs):
    return sorted(((i is None, i or 0), x) for i, x in pairs)


def integers(rows):
    return [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def plain(rows, k=4):
    """(n, deviations, eigenvalues, covariance, mean) from numpy's solver on the distinct vectors."""
    good = integers(rows)
    fit = np.array(sorted({tuple(x) for _, x in good}))
    n, s = len(fit), fit.sum(0)
    y = fit - s / n
    cov = y.T @ y / n
    dev = ordered((i, sum((n * a - int(b)) ** 2 for a, b in zip(x, s))) for i, x in good)
    return n, dev, np.linalg.eigh(cov)[0][::-1][:k], cov, s / n


def check(rows, out, k=4):
    n, dev, values, cov, mean = plain(rows, k)
    assert {r.n for r in out} == {n}
    assert ordered((r.vec_id, r.deviation) for r in out if r.component == 1) == dev
    assert len(out) == len(dev) * k
    by = {j: ordered((r.vec_id, r.whitened) for r in out if r.component == j) for j in range(1, k + 1)}
    e, u = np.linalg.eigh(cov)
    for j in range(k):
        got = {r.explained for r in out if r.component == j + 1}
        assert len(got) == 1 and math.isclose(got.pop(), values[j] / np.trace(cov), rel_tol=1e-10)
        want = ordered((i, float((np.array(x) - mean) @ u[:, -1 - j] / math.sqrt(e[-1 - j]))) for i, x in integers(rows))
        a, b = np.array([w for _, w in by[j + 1]]), np.array([w for _, w in want])
        sign = np.sign(a @ b)
        assert np.abs(a - sign * b).max() < 1e-7
    assert all(r.identity_error < 1e-9 for r in out)


def test_random_vectors_with_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(60)]
    rows += [(100, rows[0][1]), (100, rows[0][1]), (None, rows[1][1]), (101, None), (102, [None] * 6),
             (103, [float("nan")] + [0.0] * 5), (104, [float("inf")] + [0.0] * 5), (105, [-0.0] * 6)]
    ragged = [(106, [1.0, 2.0]), (107, [])]
    check(rows, W.whiten(frame(spark, rows + ragged).repartition(4)).collect())


def test_query_equals_dense_solver(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    check(rows, op11_whitening(spark, SF_SMALL).collect())


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])]])
def test_no_vectors(spark, rows):
    out = W.whiten(frame(spark, rows))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.collect() == []


def test_rank_below_components(spark):
    out = W.whiten(frame(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(8)])).collect()
    assert len(out) == 24 and {r.component for r in out} == {1, 2, 3}
    first = [r for r in out if r.component == 1]
    assert all(math.isclose(r.explained, 1.0) and r.whitened is not None for r in first)
    assert all(r.whitened is None and r.explained == 0 for r in out if r.component > 1)
    one = W.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, None)] * 4


def test_deviation_is_exact_beyond_double_precision_and_null_beyond_64_bits(spark):
    x = np.array([[10 ** 8, 1], [10 ** 8 - 3, 2]])
    assert W.deviations(x, 7, [5, 6]) == [(7 * 10 ** 8 - 5) ** 2 + 1, (7 * (10 ** 8 - 3) - 5) ** 2 + 64]
    assert W.deviations(np.array([[2 ** 40], [0]]), 3, [1]) == [None, 1]
    assert W.deviations(np.array([[2 ** 31, 5]]), 1, [0, 0]) == [2 ** 62 + 25]


@pytest.mark.parametrize("d,rank", [(1, 1), (2, 2), (7, 7), (9, 4), (64, 64)])
def test_factor_and_rotation(d, rank):
    rng = np.random.default_rng(d)
    b = rng.normal(size=(d, rank)) * np.logspace(0, -5, rank)
    v = b @ b.T
    g, pivots = W.pivoted_cholesky(v)
    assert np.allclose(g @ g.T, v, atol=1e-13 * max(1, np.abs(v).max())) and len(pivots) == g.shape[1] <= d
    assert np.allclose(np.triu(g[pivots], 1), 0)
    turned = W.one_sided_jacobi(g)
    gram = turned.T @ turned
    assert np.abs(gram - np.diag(np.diag(gram))).max() < 1e-13 * np.diag(gram).max()
    values, parts = W.eigen(v)
    want = np.linalg.eigvalsh(v)[::-1]
    assert np.allclose(values[:rank], want[:rank], rtol=1e-10, atol=1e-13 * want[0])
    assert np.allclose(parts.T @ parts, np.eye(parts.shape[1]), atol=1e-9)


def test_repeated_eigenvalues():
    values, parts = W.eigen(np.eye(5) * 3)
    assert np.allclose(values, 3) and np.allclose(np.abs(parts).sum(0), 1)
