"""SimHash near-duplicates by the generalised pigeonhole principle.

1. Every whole text becomes a 64-bit fingerprint: a bit is set if more than half of its shingles' XXH64
   values (seed 42, repeats included) have it. Equal fingerprints form a class.
2. Correlated bits go together: from the 64 x 64 co-occurrence counts over all distinct fingerprints, groups of
   bits are filled greedily with the bit that correlates most with the group.
3. Thresholds: two fingerprints within ``distance`` bits differ in at most t_i bits of some group i whenever the
   t_i + 1 add up to ``distance + 1`` (-1: the group is not probed). For every fingerprint a dynamic program over the groups
   picks the t_i with the least estimated cost. Candidate counts come from histograms of sub-groups of up to
   11 bits over all distinct fingerprints, spread to distance 1, 2, ... and combined as if independent; they
   steer cost only, never the result.
4. Probe: every fingerprint stands in the bucket of its value in each group and probes the buckets whose value is within
   t_i bits. A bucket's members are compared inside a task; links that span what they join are returned.
5. Buckets above ``BUCKET`` members are not compared in pairs: their members meet again under all
   values that differ from them in at most half the distance, and each such value links its members to the smallest one.
   Two fingerprints are within the distance exactly if they share such a value, so this stays exact and linear.
6. Connected components by alternating large-star and small-star over fingerprints.

A text with fewer words than a shingle has its whole word sequence as one shingle; one without words, or a null, has
fingerprint zero and is linked like any other. Rows link by their texts: repeated rows share a
component, a null doc_id never names one unless the whole component has no other.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.llm import hashing as H
from hazardlake.llm.components import connected_components
from hazardlake.llm.staging import drop, stage

BITS, SEED = 64, 42
#: Members of a bucket that are compared in pairs, bits of a histogram, comparisons that one probe costs.
BUCKET, HISTOGRAM_BITS, PROBE_COST = 512, 11, 50
#: Shingles whose bits are counted at once.
BLOCK = 1 << 15
_U = np.uint64
_ONE = _U(1)


def shingle_ranges(raw: np.ndarray, offsets: np.ndarray, words: int):
    """(normalised bytes, shingle starts, ends, shingles per document): lower case, single spaces between words."""
    start, end, first = H.word_bounds(raw, offsets)
    length = end - start
    begin = np.cumsum(length + 1) - (length + 1)
    clean = np.full(int((length + 1).sum()), 32, np.uint8)
    total = int(length.sum())
    inside = np.arange(total) - np.repeat(np.cumsum(length) - length, length)
    clean[np.repeat(begin, length) + inside] = H._LOWER[raw[np.repeat(start, length) + inside]]
    n = np.diff(first)
    count = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), count)
    at = np.repeat(first[:-1], count) + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    last = np.minimum(at + words, first[doc + 1]) - 1
    return clean.tobytes(), begin[at], begin[last] + length[last], count


def fingerprints_of(raw: np.ndarray, offsets: np.ndarray, words: int) -> np.ndarray:
    """One fingerprint (unsigned 64 bits) per document."""
    data, start, end, count = shingle_ranges(raw, offsets, words)
    votes, full = np.zeros((len(count), BITS), np.int64), np.flatnonzero(count)
    cut = np.cumsum(count)[full] - count[full]
    digest = xxhash.xxh64_intdigest
    for s in range(0, len(start), BLOCK):
        e = min(s + BLOCK, len(start))
        h = np.array([digest(data[a:b], SEED) for a, b in zip(start[s:e].tolist(), end[s:e].tolist())], _U)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        low = np.searchsorted(cut, s, side="right") - 1
        high = np.searchsorted(cut, e, side="left")
        votes[full[low:high]] += np.add.reduceat(bits, np.maximum(cut[low:high] - s, 0), axis=0, dtype=np.int64)
    over = (2 * votes > count[:, None]).astype(np.uint8)
    return np.packbits(over, axis=1, bitorder="little").view(_U).ravel()


def _fingerprint_mapper(words: int):
    def run(batches):
        for batch in batches:
            raw, offs = H.text_buffer(batch.column(1))
            for a, b in H.chunks(offs):
                prints = fingerprints_of(raw[offs[a]:offs[b]], offs[a:b + 1] - offs[a], words)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(prints.view(np.int64))],
                                                 names=["doc_id", "print"])
    return run


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, print) per row of documents (doc_id, text, ...); print is the fingerprint as a signed long."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_fingerprint_mapper(words), "doc_id long, print long")


def _prints(batch: pa.RecordBatch, i: int = 0) -> np.ndarray:
    return batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64).view(_U)


def _bits(prints: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(prints).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _together_mapper(batches):
    total = np.zeros((BITS, BITS))
    for batch in batches:
        b = _bits(_prints(batch)).astype(np.float64)
        total += b.T @ b
    i, j = np.triu_indices(BITS)
    yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                      pa.array(total[i, j].astype(np.int64))], names=["i", "j", "c"])


def correlations(distinct: DataFrame, n: int) -> np.ndarray:
    """Absolute correlation of each pair of bits over all distinct fingerprints (0 for constant bits)."""
    both = np.zeros((BITS, BITS))
    counted = distinct.select("print").mapInArrow(_together_mapper, "i int, j int, c long")
    for r in counted.groupBy("i", "j").agg(F.sum("c").alias("c")).collect():
        both[r.i, r.j] = both[r.j, r.i] = r.c / n
    p = np.diag(both)
    spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    return np.abs(np.divide(both - np.outer(p, p), spread, out=np.zeros_like(both), where=spread > 0))


def group_bits(corr: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size, correlated bits together."""
    left, groups = list(range(len(corr))), []
    for k in range(parts):
        size = len(left) // (parts - k)
        weight = corr[np.ix_(left, left)].sum(1)
        group = [left.pop(int(np.argmax(weight)))]
        while len(group) < size:
            group.append(left.pop(int(np.argmax(corr[np.ix_(left, group)].sum(1)))))
        groups.append(sorted(group))
    return groups


def _value(prints: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(prints), _U)
    for k, b in enumerate(bits):
        out |= ((prints >> _U(b)) & _ONE) << _U(k)
    return out


def _split(group: list[int]) -> list[list[int]]:
    n = -(-len(group) // HISTOGRAM_BITS)
    return [group[k::n] for k in range(n)]


def _histogram_mapper(subs: list[list[int]]):
    def run(batches):
        total = [np.zeros(1 << len(s), np.int64) for s in subs]
        for batch in batches:
            prints = _prints(batch)
            for t, s in zip(total, subs):
                t += np.bincount(_value(prints, s).astype(np.int64), minlength=len(t))
        for k, t in enumerate(total):
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)),
                                              pa.array(t[at])], names=["k", "value", "c"])
    return run


def spread_counts(counts: np.ndarray, width: int, distance: int) -> list[np.ndarray]:
    """[values at distance 0, 1, ... of each value], weighted by ``counts``."""
    at = np.arange(len(counts))
    out = [counts.astype(float)]
    for e in range(1, distance + 1):
        near = sum((out[-1][at ^ (1 << b)] for b in range(width)), np.zeros(len(counts)))
        out.append((near - ((width - e + 2) * out[-2] if e > 1 else 0)) / e)
    return out


class Plan:
    """Bit groups, spread histograms, and the thresholds of any fingerprint."""

    def __init__(self, groups: list[list[int]], spread: list[list[np.ndarray]], n: int, distance: int):
        self.groups, self.spread, self.n, self.distance = groups, spread, n, distance

    def costs(self, prints: np.ndarray) -> np.ndarray:
        """(fingerprint, group, units) -> estimated cost; units = threshold + 1, no unit costs nothing."""
        out = np.zeros((len(prints), len(self.groups), self.distance + 2))
        k = 0
        for g, group in enumerate(self.groups):
            share = None
            for sub in _split(group):
                value = _value(prints, sub).astype(np.int64)
                own = np.stack([s[value] / self.n for s in self.spread[k]], axis=1)
                k += 1
                if share is None:
                    share = own
                else:
                    share = np.stack([sum(share[:, i] * own[:, e - i] for i in range(e + 1))
                                      for e in range(self.distance + 1)], axis=1)
            probes = np.cumsum([comb(len(group), t) for t in range(self.distance + 1)])
            out[:, g, 1:] = self.n * np.cumsum(share, axis=1) + PROBE_COST * probes
        return out

    def thresholds(self, prints: np.ndarray) -> np.ndarray:
        """Cheapest thresholds (fingerprint, group); their sum is distance - groups + 1."""
        cost, units = self.costs(prints), self.distance + 1
        best = np.full((len(prints), units + 1), np.inf)
        best[:, 0] = 0
        chosen = []
        for g in range(len(self.groups)):
            options = np.stack([np.concatenate([np.full((len(prints), u), np.inf),
                                                best[:, :units + 1 - u] + cost[:, g, u:u + 1]], axis=1)
                                for u in range(units + 1)], axis=2)
            chosen.append(options.argmin(axis=2))
            best = options.min(axis=2)
        out, left = np.zeros((len(prints), len(self.groups)), np.int64), np.full(len(prints), units)
        for g in reversed(range(len(self.groups))):
            out[:, g] = chosen[g][np.arange(len(prints)), left] - 1
            left = left - out[:, g] - 1
        return out


def make_plan(distinct: DataFrame, n: int, distance: int, parts: int) -> Plan:
    groups = group_bits(correlations(distinct, n), parts)
    subs = [s for g in groups for s in _split(g)]
    counts = [np.zeros(1 << len(s), np.int64) for s in subs]
    found = distinct.select("print").mapInArrow(_histogram_mapper(subs), "k int, value int, c long")
    for r in found.groupBy("k", "value").agg(F.sum("c").alias("c")).toLocalIterator():
        counts[r.k][r.value] = r.c
    return Plan(groups, [spread_counts(c, len(s), distance) for c, s in zip(counts, subs)], n, distance)


def _masks(bits: int, most: int) -> list[np.ndarray]:
    """[all values of ``bits`` bits with e bits set] for e up to ``most``."""
    return [np.array([sum(1 << b for b in c) for c in combinations(range(bits), e)], _U) for e in range(most + 1)]


def _probe_mapper(plan: Plan):
    """(print) -> (part, value, print): its own bucket in each group and the buckets that it probes."""
    def run(batches):
        for batch in batches:
            prints = _prints(batch)
            if not len(prints):
                continue
            wanted = plan.thresholds(prints)
            for g, group in enumerate(plan.groups):
                value = _value(prints, group)
                masks = _masks(len(group), int(max(wanted[:, g].max(), 0)))
                for e, mask in enumerate(masks):
                    some = slice(None) if e == 0 else wanted[:, g] >= e
                    key = (value[some][:, None] ^ mask).ravel()
                    who = np.repeat(prints[some], len(mask))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(key), g, np.int32)), pa.array(key.view(np.int64)),
                         pa.array(who.view(np.int64))], names=["part", "value", "print"])
    return run


def bucket_links(prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links within ``distance`` bits that span what they join, of one bucket's fingerprints."""
    label, links = np.arange(len(prints)), []
    for i in range(len(prints) - 1):
        near = np.flatnonzero(np.bitwise_count(prints[i + 1:] ^ prints[i]) <= distance) + i + 1
        near = near[label[near] != label[i]]
        if len(near):
            found, at = np.unique(label[near], return_index=True)
            links += [(i, int(j)) for j in near[at]]
            label[np.isin(label, found)] = label[i]
    return links


def _verify_mapper(distance: int):
    """Rows (part, value, print) sorted by bucket -> spanning links (a, b)."""
    def run(batches):
        kept = (np.zeros(0, np.int64),) * 3

        def links(part, value, prints):
            if not len(prints):
                return None
            new = np.ones(len(prints), bool)
            new[1:] = (part[1:] != part[:-1]) | (value[1:] != value[:-1])
            head = np.flatnonzero(new)
            size = np.diff(np.append(head, len(prints)))
            u = prints.view(_U)
            two = head[size == 2]
            two = two[np.bitwise_count(u[two] ^ u[two + 1]) <= distance]
            a, b = [prints[two]], [prints[two + 1]]
            for h, k in zip(head[size > 2].tolist(), size[size > 2].tolist()):
                found = bucket_links(u[h:h + k], distance)
                if found:
                    at = np.array(found) + h
                    a.append(prints[at[:, 0]])
                    b.append(prints[at[:, 1]])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [np.concatenate((k, batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)))
                    for i, k in enumerate(kept)]
            # The last bucket may go on in the next batch.
            last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            kept = tuple(c[cut:] for c in cols)
            if cut:
                yield links(*(c[:cut] for c in cols))
        if len(kept[2]):
            yield links(*kept)
    return run


def _neighbour_mapper(distance: int):
    """(print) -> (value, print, near) for all values within half the distance (rounded up); near: rounded down."""
    masks = _masks(BITS, -(-distance // 2))

    def run(batches):
        for batch in batches:
            prints = _prints(batch)
            for e, mask in enumerate(masks):
                value = (prints[:, None] ^ mask).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value.view(np.int64)), pa.array(np.repeat(prints, len(mask)).view(np.int64)),
                     pa.array(np.full(len(value), e <= distance // 2))], names=["value", "print", "near"])
    return run


def neighbour_links(prints: DataFrame, distance: int) -> DataFrame:
    """Links (a, b): every value's members to its smallest near member, at most ``distance`` bits away from each."""
    met = prints.mapInArrow(_neighbour_mapper(distance), "value long, print long, near boolean")
    low = (met.groupBy("value").agg(F.min(F.expr("if(near, print, null)")).alias("a"), F.count("*").alias("m"))
           .where("m > 1 and a is not null").select("value", "a"))
    return met.join(low, "value").where("print <> a").select("a", F.col("print").alias("b")).distinct()


def similar_prints(distinct: DataFrame, distance: int = 2, parts: int | None = None, bucket: int = BUCKET) -> DataFrame:
    """(node, component) of the fingerprints that have another one within ``distance`` bits; distinct: (print)."""
    n = distinct.count()
    plan = make_plan(distinct, max(n, 1), distance, parts or distance + 1)
    probes = stage(distinct.select("print").mapInArrow(_probe_mapper(plan), "part int, value long, print long"), "probes")
    hot = stage(probes.groupBy("part", "value").count().where(F.col("count") > bucket).select("part", "value"), "hot")
    cool = probes.join(hot, ["part", "value"], "left_anti")
    links = (cool.repartition("part", "value").sortWithinPartitions("part", "value")
             .mapInArrow(_verify_mapper(distance), "a long, b long"))
    if not hot.isEmpty():
        crowded = stage(probes.join(hot, ["part", "value"], "left_semi").select("print").distinct(), "crowded")
        links = links.unionByName(neighbour_links(crowded, distance))
    found = stage(links.distinct(), "links")
    drop(probes, hot)
    return connected_components(found, "a", "b", "prints")


def simhash_duplicates(docs: DataFrame, words: int = 3, distance: int = 2, parts: int | None = None,
                       bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text, ...).

    ``component_id`` is the smallest doc_id reachable over links of at most ``distance`` bits.
    """
    prints = stage(fingerprints(docs, words), "prints")
    classes = stage(prints.groupBy("print").agg(F.min("doc_id").alias("first")), "classes")
    parts_of = stage(similar_prints(classes.select("print"), distance, parts, bucket), "parts")
    roots = (parts_of.join(classes, parts_of["node"] == classes["print"])
             .groupBy("component").agg(F.min("first").alias("component_id")))
    joined = parts_of.join(roots, "component").select(F.col("node").alias("print"), "component_id")
    names = classes.join(joined, "print", "left").select("print", F.coalesce("component_id", "first").alias("component_id"))
    hexed = F.lpad(F.lower(F.hex("print")), 16, "0")
    return prints.join(names, "print").select("doc_id", hexed.alias("fingerprint"), "component_id")
