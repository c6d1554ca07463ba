"""Near-duplicate documents: MinHash, banding, verification, components.

1. Each document becomes its set of distinct word shingles (64-bit hashes)
   and a signature of ``bands * rows`` minima under universal hashes
   ``(a * x + b) mod 2^64`` (upper 32 bits kept).
2. Documents with equal sets form a class; its smallest doc_id stands for it.
3. Banding: representatives that agree on one whole band share a bucket. Each
   bucket links its members to its smallest member only, so a bucket of any
   size gives one row per member. Such a link stays if the signatures agree on
   at least half of their places; components of these links are first clusters.
4. Open buckets: where a bucket still holds members of several first clusters,
   all members of different ones are tested with each other, block by block
   inside tasks, and spanning links are returned. So any two documents that share a
   bucket and agree on half of their signatures are in one cluster.
5. Inside a cluster the full shingle sets decide. Large clusters are dealt
   into blocks of bounded size and each pair of blocks is one unit of work
   that gets exact overlaps from an inverted index over its shingles and returns
   spanning links only, never a row per pair.
6. Components of the exact links (alternating large-star and small-star).

With 32 bands of 4 rows two documents at similarity 0.8 share no bucket with
probability 5e-8. Empty texts and nulls have no shingles and link to nothing; a
row without doc_id is returned with a null component and kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.llm import hashing as H
from hazardlake.llm.components import connected_components
from hazardlake.llm.staging import bounded, drop, stage

BANDS, ROWS = 32, 4
#: Documents and shingles that one block of a large cluster holds on average.
BLOCK_DOCS, BLOCK_SHINGLES = 512, 400_000
#: Members of an open bucket that one block holds on average.
BUCKET_DOCS = 1024
#: Share of equal minima below which a bucket's link is no cluster link.
LOOSE = 0.5
_SETS = "doc_id long, n_shingles long, k1 long, k2 long, sig binary"


def _signature_mapper(shingle: int, n_hashes: int):
    def run(batches):
        mult, add = H.seeds(n_hashes, 21) | np.uint64(1), H.seeds(n_hashes, 22)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            raw, offs = H.text_buffer(texts)
            for a, b in H.chunks(offs):
                part, o = raw[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
                start, end, first = H.word_bounds(part, o)
                words = H.word_hashes(part, start, end, lower=True)
                flat, at = H.doc_shingles(words, first, shingle)
                size = np.diff(at)
                full = np.flatnonzero(size)
                k1, k2 = np.zeros(b - a, np.uint64), np.zeros(b - a, np.uint64)
                sig = np.zeros((b - a, n_hashes), np.uint32)
                if len(full):
                    cut = at[full]
                    k1[full] = np.add.reduceat(H.mix64(flat + np.uint64(7)), cut)
                    k2[full] = np.add.reduceat(H.mix64(flat ^ np.uint64(0x5851F42D4C957F2D)), cut)
                    for j in range(n_hashes):
                        sig[full, j] = np.minimum.reduceat(flat * mult[j] + add[j], cut) >> np.uint64(32)
                sigs = [sig[i].tobytes() if size[i] else b"" for i in range(b - a)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(size), pa.array(k1.view(np.int64)),
                     pa.array(k2.view(np.int64)), pa.array(sigs, pa.binary())],
                    names=["doc_id", "n_shingles", "k1", "k2", "sig"])
    return run


def shingle_signatures(docs: DataFrame, shingle: int, n_hashes: int) -> DataFrame:
    """(doc_id, n_shingles, k1, k2, sig) per row; equal sets have equal (k1, k2, n_shingles)."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(_signature_mapper(shingle, n_hashes), _SETS))


def _band_mapper(bands: int, rows: int):
    def run(batches):
        c = H.seeds(rows + 1, 31) | np.uint64(1)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(n, bands, rows)
            key = np.zeros((n, bands), np.uint64)
            for j in range(rows):
                key += sig[:, :, j].astype(np.uint64) * c[j]
            key = H.mix64(H.mix64(key) + np.arange(bands, dtype=np.uint64) * c[rows])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(ids, bands))], names=["band", "doc_id"])
    return run


def _agree_mapper(loose: float):
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(n, -1) for i in (2, 3))
            near = pa.array((x == y).mean(axis=1) >= loose)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near)],
                                             names=["a", "b"])
    return run


def loose_links(ids: np.ndarray, label: np.ndarray, side: np.ndarray, sig: np.ndarray, loose: float) -> list:
    """Links between members of different ``label`` that agree on ``loose`` of their signatures.

    ``side`` 0/1 are the two blocks (all 0: one block with itself). Linked labels
    become one, so the links only span what they join.
    """
    label, links, both = label.copy(), [], bool(side.any())
    for i in range(len(ids)):
        other = label[i + 1:] != label[i]
        if both:
            other &= side[i + 1:] != side[i]
        rest = np.flatnonzero(other) + i + 1
        if not len(rest):
            continue
        near = rest[(sig[rest] == sig[i]).mean(axis=1) >= loose]
        found, at = np.unique(label[near], return_index=True)
        if len(found):
            links += [(int(ids[i]), int(ids[j])) for j in near[at]]
            label[np.isin(label, found)] = label[i]
    return links


def _open_mapper(loose: float):
    """Rows (band, x, y, block, doc_id, label, sig) sorted by unit (band, x, y)."""
    def run(batches):
        key, rows = None, []

        def flush():
            ids, label, side = (np.array([r[i] for r in rows], np.int64) for i in range(3))
            sig = np.frombuffer(b"".join(r[3] for r in rows), np.uint32).reshape(len(rows), -1)
            links = loose_links(ids, label, side, sig, loose)
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()),
                                               pa.array([x[1] for x in links], pa.int64())], names=["a", "b"])

        for batch in batches:
            for band, x, y, block, doc, label, sig in zip(*(c.to_pylist() for c in batch.columns)):
                if (band, x, y) != key:
                    if len(rows) > 1:
                        yield flush()
                    key, rows = (band, x, y), []
                rows.append((doc, label, int(block != x), sig))
        if len(rows) > 1:
            yield flush()
    return run


def open_links(shared: DataFrame, clusters: DataFrame, sig: DataFrame) -> DataFrame:
    """Spanning loose links (a, b) between first clusters that meet in a bucket.

    shared: (band, doc_id) of all buckets; clusters: (node, component); sig: (doc_id, sig).
    """
    labelled = stage(shared.join(clusters.withColumnRenamed("node", "doc_id"), "doc_id", "left")
                     .select("band", "doc_id", F.coalesce("component", "doc_id").alias("label")), "labelled")
    left = stage(labelled.groupBy("band").agg(F.count("*").alias("m"), F.min("label").alias("low"),
                                              F.max("label").alias("high")).where("low < high")
                 .select("band", F.ceil(F.col("m") / BUCKET_DOCS).cast("long").alias("n_blocks")), "open")
    dealt = labelled.join(bounded(left, 16), "band").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("n_blocks")))
    units = (dealt.join(sig, "doc_id")
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
             .select("band", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
                     "block", "doc_id", "label", "sig")
             .repartition("band", "x", "y").sortWithinPartitions("band", "x", "y"))
    found = stage(units.mapInArrow(_open_mapper(LOOSE), "a long, b long"), "met")
    drop(labelled, left)
    return found


def spanning_links(ids: np.ndarray, side: np.ndarray, flat: np.ndarray, at: np.ndarray, percent: int) -> list:
    """Links (i, j) with 100 * overlap >= percent * union that span the pairs compared.

    ``side`` 0/1 are the two blocks (all 0: one block with itself). An inverted
    index over the unit's shingles gives the overlaps of one document with
    all others at once.
    """
    n, size = len(ids), np.diff(at)
    owner = np.repeat(np.arange(n), size)
    _, token = np.unique(flat, return_inverse=True)
    order = np.argsort(token, kind="stable")
    posting, first = owner[order], np.concatenate(([0], np.cumsum(np.bincount(token))))
    label, links = np.arange(n), []
    both = bool(side.any())
    for i in range(n):
        t = token[at[i]:at[i + 1]]
        lo, width = first[t], first[t + 1] - first[t]
        base = np.repeat(lo - np.concatenate(([0], np.cumsum(width)[:-1])), width)
        common = np.bincount(posting[base + np.arange(len(base))], minlength=n)
        linked = 100 * common >= percent * (size + size[i] - common)
        linked &= (label != label[i]) & (size > 0)
        if both:
            linked &= side != side[i]
        found = np.unique(label[linked])
        if len(found):
            links += [(ids[i], ids[int(j)]) for j in found]
            mine = np.append(found, label[i])
            label[np.isin(label, mine)] = mine.min()
    return links


def _verify_mapper(shingle: int, percent: int):
    """Rows (cluster, x, y, block, doc_id, text) sorted by unit (cluster, x, y)."""
    def unit(rows):
        ids = np.array([r[0] for r in rows], np.int64)
        side = np.array([r[1] for r in rows], np.int64)
        raw, offs = H.text_buffer(pa.array([r[2] for r in rows], pa.large_string()).cast(pa.large_string()))
        parts, sizes = [], []
        for a, b in H.chunks(offs):
            part, o = raw[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
            start, end, first = H.word_bounds(part, o)
            flat, at = H.doc_shingles(H.word_hashes(part, start, end, lower=True), first, shingle)
            parts.append(flat)
            sizes.append(np.diff(at))
        at = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
        return spanning_links(ids, side, np.concatenate(parts), at, percent)

    def run(batches):
        key, rows = None, []

        def flush():
            links = unit(rows) if len(rows) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([int(x[0]) for x in links], pa.int64()),
                                               pa.array([int(x[1]) for x in links], pa.int64())], names=["a", "b"])

        for batch in batches:
            cols = [batch.column(i) for i in range(6)]
            keys = list(zip(*(c.to_pylist() for c in cols[:3])))
            for i, k in enumerate(keys):
                if k != key:
                    if rows:
                        yield flush()
                    key, rows = k, []
                rows.append((cols[4][i].as_py(), int(cols[3][i].as_py() != k[1]), cols[5][i].as_py()))
        if rows:
            yield flush()
    return run


def exact_links(docs: DataFrame, members: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Spanning exact links (a, b) inside clusters; members: (node, component, n_shingles)."""
    load = (members.groupBy("component").agg(F.count("*").alias("m"), F.sum("n_shingles").alias("w"))
            .select("component", F.greatest(F.ceil(F.col("m") / BLOCK_DOCS),
                                            F.ceil(F.col("w") / BLOCK_SHINGLES)).cast("long").alias("n_blocks")))
    dealt = stage(members.join(load, "component")
                  .withColumn("block", F.pmod(F.xxhash64("node"), F.col("n_blocks")))
                  .select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"), "block", "n_blocks"),
                  "blocks")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    units = (texts.join(bounded(dealt, 48), "doc_id")
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
             .select("cluster", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
                     "block", "doc_id", "text")
             .repartition("cluster", "x", "y").sortWithinPartitions("cluster", "x", "y"))
    return units.mapInArrow(_verify_mapper(shingle, percent), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text, ...).

    ``component_id`` is the smallest doc_id reachable over links of at least
    ``percent`` similarity. Rows that share a doc_id count as one document
    for linking, each with its own set.
    """
    sets = stage(shingle_signatures(docs, shingle, bands * rows), "sets")
    ids = sets.select("doc_id", "n_shingles", "k1", "k2")
    classes = stage(ids.where("n_shingles > 0 and doc_id is not null").groupBy("k1", "k2", "n_shingles")
                    .agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last")).where("rep < last").drop("last"),
                    "classes")
    classed = ids.join(bounded(classes, 40), ["k1", "k2", "n_shingles"], "left")
    copies = F.col("rep").isNull() | (F.col("rep") == F.col("doc_id"))
    reps = (sets.join(bounded(classes, 40), ["k1", "k2", "n_shingles"], "left")
            .where("n_shingles > 0 and doc_id is not null").where(copies).select("doc_id", "n_shingles", "sig"))

    banded = reps.select("doc_id", "sig").mapInArrow(_band_mapper(bands, rows), "band long, doc_id long")
    buckets = banded.groupBy("band").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).where("a < z")
    shared = stage(banded.join(buckets.select("band", "a"), "band"), "shared")
    pairs = stage(shared.where("doc_id > a").select("a", F.col("doc_id").alias("b")).distinct(), "pairs")
    sig = reps.select("doc_id", "sig")
    small = bounded(pairs, 24)
    first = sig.join(small, sig.doc_id == pairs.a).select("a", "b", F.col("sig").alias("sig_a"))
    both = sig.join(first, sig.doc_id == first.b).select("a", "b", "sig_a", "sig")
    loose = both.mapInArrow(_agree_mapper(LOOSE), "a long, b long")
    clusters = connected_components(loose, "a", "b", "clusters")
    met = open_links(shared.select("band", "doc_id"), clusters, sig)
    if not met.isEmpty():
        starred = clusters.select(F.col("component").alias("a"), F.col("node").alias("b"))
        clusters = connected_components(starred.unionByName(met), "a", "b", "joined")
    members = clusters.join(reps.select(F.col("doc_id").alias("node"), "n_shingles").distinct(), "node")
    exact = exact_links(docs, members, shingle, percent)
    parts = stage(connected_components(exact, "a", "b", "links"), "parts")
    drop(pairs, shared, met)

    out = classed.withColumn("rep", F.coalesce("rep", "doc_id"))
    out = out.join(bounded(parts, 32).withColumnRenamed("node", "rep"), "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one document of each group stays, with its own columns.

    Of rows equal in doc_id and text one stays; rows without doc_id all stay.
    """
    found = stage(near_duplicates(docs, shingle, percent), "classes")
    lost = stage(found.where("not kept").select(F.col("doc_id").alias("lost")).distinct(), "lost")
    repeated = not found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty()
    out = docs.join(bounded(lost, 16), docs["doc_id"] == lost["lost"], "left_anti")
    if repeated:
        out = (out.where(docs["doc_id"].isNotNull()).dropDuplicates(["doc_id", "text"])
               .unionByName(out.where(docs["doc_id"].isNull())))
    return out
