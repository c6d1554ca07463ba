"""The corpus pipeline and the registered queries."""

import importlib

import llm_brute as B
import numpy as np
import pytest
from conftest import SF_SMALL

import corpus_pipeline as C
from hazardlake.llm.components import connected_components
from hazardlake.llm.fm_index import FMIndex, earlier_windows
from hazardlake.llm.prefix import running_total
from hazardlake.llm.staging import stage
from pyspark.sql import functions as F


def test_pipeline_equals_plain_versions(spark):
    docs = C.load(spark, SF_SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    after = {}
    for name, f in C.STAGES:
        docs = stage(f(spark, docs, SF_SMALL), name)
        after[name] = docs
    rows = [(i, t) for i, t in rows if not B.signals(t)["base_failed"]]
    assert sorted(r.doc_id for r in after["quality_rules"].collect()) == [i for i, _ in rows]
    comp = B.components(rows, 5)
    rows = [(i, t) for i, t in rows if comp[i] == i]
    assert sorted(r.doc_id for r in after["near_duplicates"].collect()) == [i for i, _ in rows]
    items = [(r.item_id, r.text) for r in C.load(spark, SF_SMALL, "benchmark").collect()]
    rows = [(i, t) for i, t in rows if not B.contained(t, items)]
    assert sorted(r.doc_id for r in after["decontaminate"].collect()) == [i for i, _ in rows]
    mixed = [r.doc_id for r in after["mix"].collect()]
    assert set(mixed) <= {i for i, _ in rows} and max(mixed.count(i) for i in set(mixed)) <= 3
    shards = after["shard"].collect()
    assert sorted(r.doc_id for r in shards) == sorted(mixed)
    for name in ("quality_rules", "near_duplicates", "decontaminate", "mix"):
        assert after[name].columns == C.load(spark, SF_SMALL, "documents").columns
    run = C.run(spark, SF_SMALL)
    assert sorted(r.doc_id for r in run.collect()) == sorted(mixed)


def test_pipeline_of_nothing(spark):
    docs = C.load(spark, SF_SMALL, "documents").where("false")
    for name, f in C.STAGES:
        docs = stage(f(spark, docs, SF_SMALL), name)
    assert docs.count() == 0


@pytest.mark.parametrize("key", sorted(importlib.import_module("hazardlake.llm.queries").QUERIES))
def test_queries_return_one_row_per_input_row(spark, key):
    """Whitening: one per vector and component; conversation repair: one per conversation."""
    E = importlib.import_module("__spark_entry__")
    table = {"op8": "pages", "op11": "embeddings", "op13": "conversations"}.get(key.split("_")[0], "documents")
    rows = C.load(spark, SF_SMALL, table)
    want = rows.select("conv_id").distinct().count() if table == "conversations" else rows.count()
    assert E.queries()[key](spark, SF_SMALL).count() == want * (4 if table == "embeddings" else 1)


def test_components(spark):
    rng = np.random.default_rng(0)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(5, 5), (None, 3), (1000, None)]
    edges += [(2000, 2000 + i) for i in range(1, 50)] + [(3000 + i, 3001 + i) for i in range(40)]
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            p, q = find(a), find(b)
            up[max(p, q)] = min(p, q)
    out = connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {r.node: r.component for r in out} == {x: find(x) for x in up} and len(out) == len(up)
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_running_total_over_groups_and_nulls(spark):
    rows = [(g, i, (i * 7) % 5) for i in range(300) for g in ("a", None, "hot", "hot")]
    df = spark.createDataFrame([(g, 4 * i + k, v) for k, (g, i, v) in enumerate(rows)], "g string, at long, v long")
    out = running_total(df.repartition(7), [F.col("at")], "before", value="v", groups=["g"]).collect()
    seen = {}
    for r in sorted(out, key=lambda r: r["at"]):
        assert r.before == seen.get(r.g, 0)
        seen[r.g] = r.before + r.v
    assert len(out) == len(rows)


def test_fm_index_against_all_windows():
    rng = np.random.default_rng(0)
    for _ in range(40):
        width, n = int(rng.integers(2, 8)), int(rng.integers(1, 30))
        src = rng.integers(1, 4, 60).astype(np.uint64)
        seqs = []
        for _ in range(n):
            a, size = int(rng.integers(0, 30)), int(rng.integers(1, 30))
            q = src[a:a + size].copy()
            if rng.random() < 0.5:
                q[rng.integers(0, len(q))] = rng.integers(1, 4)
            seqs.append(q)
        docs = rng.integers(0, 10, n).astype(np.int64)
        size, words = np.array([len(q) for q in seqs]), np.concatenate(seqs)
        got = earlier_windows(FMIndex(words, size, docs, 64), words, size, docs, width)
        best = {}
        for q, d in zip(seqs, docs):
            for k in range(len(q) - width + 1):
                t = tuple(q[k:k + width])
                best[t] = min(best.get(t, 99), d)
        want = [k + width <= len(q) and best[tuple(q[k:k + width])] < d
                for q, d in zip(seqs, docs) for k in range(len(q))]
        assert (np.array(want, bool) == got).all()
