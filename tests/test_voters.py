import random

import numpy as np
import pytest

from hazardlake.functions.lookups import CLASS_NAMES
from hazardlake.operators import voters as V

STEMS = ["roof", "road", "storm", "heal"]


def _texts(n, seed):
    """Texts whose words lean towards their class, with words of all classes and common ones mixed in."""
    r, out = random.Random(seed), []
    for i in range(n):
        c = i % 4
        own = [STEMS[c] + str(r.randrange(12)) for _ in range(6)]
        other = [r.choice(STEMS) + str(r.randrange(12)) for _ in range(3)]
        words = own + other + r.choices(["the", "and", "of"], k=8)
        r.shuffle(words)
        out.append((i, " ".join(words), c))
    return out


@pytest.fixture(scope="module")
def fitted(spark):
    train = spark.createDataFrame(_texts(240, 1) + [(900, "left out", 9), (901, "left out", None)], "id int, text string, c int").coalesce(1)
    return V.fit_voters(train, "text", "c", features=512)


def _macro_f1(pairs):
    scores = []
    for c in CLASS_NAMES:
        hit = sum(a == b == c for a, b in pairs)
        scores.append(2 * hit / max(1, sum(a == c for a, _ in pairs) + sum(b == c for _, b in pairs)))
    return sum(scores) / len(scores)


def test_each_model_and_the_vote_on_held_out_texts(spark, fitted):
    test = _texts(120, 2)
    truth = {i: CLASS_NAMES[c] for i, _, c in test}
    got = V.vote(fitted, spark.createDataFrame(test, "id int, text string, c int").drop("c"), "id").collect()
    assert {r.id for r in got} == set(truth)
    for col in [*V.MODELS, "label"]:
        assert _macro_f1([(truth[r.id], r[col]) for r in got]) >= 0.85, col
    for r in got:
        each = [r[m] for m in V.MODELS]
        most = max(each.count(x) for x in each)
        assert r.votes == most and r.label == min((x for x in each if each.count(x) == most), key=CLASS_NAMES.index)


def test_logistic_gradient_vanishes_at_the_optimum(spark, fitted):
    data = _texts(240, 1)
    df = V._words(spark.createDataFrame(data, "id int, text string, c int"), "text")
    xs = fitted.features.transform(df).select("_x", "c").collect()
    x, y = np.array([r._x.toArray() for r in xs]), np.eye(4)[[r.c for r in xs]]
    w, b = fitted.logistic.coefficientMatrix.toArray(), fitted.logistic.interceptVector.toArray()
    z = x @ w.T + b
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    assert np.abs((p - y).T @ x / len(x) + V.L2 * w).max() < 2e-4
    assert np.abs((p - y).mean(0)).max() < 2e-4
    assert np.abs(y.T @ x / len(x)).max() > 0.02


def test_null_and_empty_texts_get_votes(spark, fitted):
    got = V.vote(fitted, spark.createDataFrame([(1, None), (2, ""), (3, "?!")], "id int, text string"), "id").collect()
    assert len(got) == 3 and all(r.votes >= 1 and r.label in CLASS_NAMES for r in got)


def test_no_labelled_rows(spark):
    none = V.fit_voters(spark.createDataFrame([], "text string, c int"), "text", "c")
    assert V.vote(none, spark.createDataFrame([(1, "a")], "id int, text string"), "id").count() == 0
