"""SimHash fingerprints and classes against all pairs."""

import random

import llm_brute as B
import numpy as np
import pytest
import xxhash
from conftest import SF_SMALL
from pyspark.sql import functions as F

from hazardlake.llm import simhash as S
from hazardlake.llm.queries import op12_simhash


def plain_print(text, n=3):
    w = B.words((text or "").translate(B.LOWER))
    grams = [w[i:i + n] for i in range(len(w) - n + 1)] or ([w] if w else [])
    h = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_classes(prints, distance):
    """Smallest index reachable, by all pairs."""
    up = list(range(len(prints)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= distance:
                p, q = find(i), find(j)
                up[max(p, q)] = min(p, q)
    return [find(i) for i in range(len(prints))]


def expected(rows, distance=2):
    prints = [plain_print(t) for _, t in rows]
    group = plain_classes(prints, distance)
    low = {}
    for (i, _), g in zip(rows, group):
        if i is not None:
            low[g] = min(low.get(g, i), i)
    return sorted(((i is None, i or 0, f"{p:016x}", low.get(g)) for (i, _), p, g in zip(rows, prints, group)), key=repr)


def got(out):
    return sorted(((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in out.collect()), key=repr)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    words = [rng.choice("alpha beta gamma delta eps zeta".split()) + str(rng.randint(0, 400)) for _ in range(900)]
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one  two\n"), (8, "one two three"),
            (8, "one two three"), (9, "É one É two"), (None, "one two three"), (None, "alone here now then"),
            (10, " ".join(words)), (11, " ".join(words).upper()), (12, "w " * 4000), (13, "x" * 200_000)]
    for k in range(40):
        changed = words[:]
        for _ in range(k % 5):
            changed[rng.randrange(900)] = f"new{k}"
        rows.append((100 + k, "\n".join(changed)))
    rows += [(300 + k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 6)))) for k in range(150)]
    return rows


@pytest.mark.parametrize("bucket", [512, 1])
def test_classes_equal_all_pairs(spark, texts, bucket):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in texts], "doc_id long, text string, print string, component string")
    assert got(S.simhash_duplicates(docs.repartition(3), bucket=bucket)) == expected(texts)


def test_query_equals_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert got(op12_simhash(spark, SF_SMALL)) == expected(rows)


def test_empty_table(spark):
    assert S.simhash_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_spark_hash_is_the_same_function(spark):
    texts = ["", "a", "one two three", "é ü ß", "x" * 31, "y" * 32, "z" * 100]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t").alias("h"))
    assert all(r.h % 2 ** 64 == xxhash.xxh64_intdigest(r.t.encode(), 42) for r in df.collect())


def test_long_text_is_counted_in_blocks(monkeypatch):
    text = " ".join(f"w{i * i % 977}" for i in range(5000)).encode()
    raw, offs = np.frombuffer(text + b"a b c d e", np.uint8), np.array([0, len(text), len(text) + 9])
    whole = S.fingerprints_of(raw, offs, 3)
    monkeypatch.setattr(S, "BLOCK", 7)
    assert (S.fingerprints_of(raw, offs, 3) == whole).all()
    assert whole.tolist() == [plain_print(text.decode()), plain_print("a b c d e")]


@pytest.mark.parametrize("distance,parts,bucket", [(0, 1, 512), (1, 2, 2), (2, 3, 512), (2, 3, 2), (2, 2, 512), (2, 4, 512),
                                                   (3, 2, 2)])
def test_any_distance_on_clustered_prints(spark, distance, parts, bucket):
    """Chains and balls of fingerprints in a few correlated bits, so thresholds get uneven and buckets full."""
    rng = random.Random(distance * 10 + parts)
    seeds = [rng.getrandbits(64) & 0xFFFF0000FFFF for _ in range(6)]
    prints = {0, 1, 2 ** 64 - 1, *seeds}
    while len(prints) < 260:
        p = rng.choice(sorted(prints))
        for _ in range(rng.randint(1, 4)):
            p ^= 1 << rng.randrange(64)
        prints.add(p)
    prints = sorted(prints)
    signed = [p - (p >> 63 << 64) for p in prints]
    found = S.similar_prints(spark.createDataFrame([(p,) for p in signed], "print long"), distance, parts, bucket)
    named = {r.node: r.component for r in found.collect()}
    group = plain_classes(prints, distance)
    low = {}
    for s, g in zip(signed, group):
        low[g] = min(low.get(g, s), s)
    sizes = {g: group.count(g) for g in group}
    assert named == {s: low[g] for s, g in zip(signed, group) if sizes[g] > 1}


def test_spread_counts_equal_all_values():
    counts = np.array([3, 0, 1, 0, 5, 0, 0, 2])
    for e, got_e in enumerate(S.spread_counts(counts, 3, 3)):
        assert got_e.tolist() == [sum(c for u, c in enumerate(counts.tolist()) if (u ^ v).bit_count() == e) for v in range(8)]


def test_thresholds_are_the_cheapest_and_cover():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 62, 50).astype(np.uint64) & np.uint64(0xFF00FF00FF)
    groups = S.group_bits(np.abs(np.corrcoef(rng.normal(size=(64, 90)))), 3)
    assert sorted(b for g in groups for b in g) == list(range(64)) and max(map(len, groups)) - min(map(len, groups)) <= 1
    spread = [S.spread_counts(np.bincount(S._value(prints, s).astype(int), minlength=1 << len(s)), len(s), 2)
              for g in groups for s in S._split(g)]
    plan = S.Plan(groups, spread, len(prints), 2)
    cost, chosen = plan.costs(prints), plan.thresholds(prints)
    options = [(a, b, 3 - a - b) for a in range(4) for b in range(4 - a)]
    for i in range(len(prints)):
        assert chosen[i].sum() == 0
        price = {o: sum(cost[i, g, u] for g, u in enumerate(o)) for o in options}
        assert np.isclose(price[tuple(int(t) + 1 for t in chosen[i])], min(price.values()))
