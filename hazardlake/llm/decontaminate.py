"""Benchmark decontamination: containment search for short items in long documents.

An item is contaminated text if a document holds at least ``percent`` of
the item's distinct five-word shingles (ASCII-lower-cased words; an item of fewer
words counts as one shingle of its own length).

1. Items are partitioned by size: class c holds items of up to 2^c shingles.
   The MinHash sketch of an item is its smallest shingle hashes, as many as an
   item of the class may miss plus ``SPARE``. A document that holds ``percent``
   of the item then holds at least ``sketch - allowed misses`` of these minima,
   so the search has no false negatives whatever the document's length.
2. Documents are streamed past the sketches once, whole texts, inside map
   tasks: no document text is shuffled.
3. Candidates are verified by exact containment of the item's full shingle set.

The items are a stated query set. They are read in blocks of bounded size
(``BLOCK_ITEMS`` hashes); each block is broadcast and searched in all documents.
Items and documents without words never match; null ids are kept as null;
repeated items each report their own item_id. A document is known by its id and the hash of its
text, so rows that share an id or have none are judged each by its own text.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake.llm import hashing as H
from hazardlake.llm.staging import bounded, stage

SHINGLE, PERCENT = 5, 80
#: Minima of a sketch beyond those that its size class may miss.
SPARE = 2
#: Shingle hashes of one broadcast block of items (8 bytes each).
BLOCK_ITEMS = 2_000_000
_HITS = "doc_id long, text_crc long, text_hash long, item_id long, containment double"


def _item_mapper(shingle: int):
    def run(batches):
        for batch in batches:
            raw, offs = H.text_buffer(batch.column(1))
            for a, b in H.chunks(offs):
                part, o = raw[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
                start, end, first = H.word_bounds(part, o)
                flat, at = H.doc_shingles(H.word_hashes(part, start, end, lower=True), first, shingle)
                sets = [flat[at[i]:at[i + 1]].tobytes() for i in range(b - a)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.minimum(np.diff(first), shingle)),
                     pa.array(np.diff(at)), pa.array(sets, pa.binary())],
                    names=["item_id", "words", "size", "shingles"])
    return run


def item_sets(items: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(item_id, words, size, shingles): the shingle set of every item that has words."""
    return (items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(_item_mapper(shingle), "item_id long, words long, size long, shingles binary")
            .where("size > 0"))


class ItemIndex:
    """Sketches of one block of items, looked up for many document shingles at once."""

    def __init__(self, rows, percent: int):
        self.ids = [item for item, _ in rows]
        self.sets = [np.frombuffer(shingles, np.uint64) for _, shingles in rows]
        self.size = np.array([len(s) for s in self.sets], np.int64)
        self.need = -(-percent * self.size // 100)
        upper = 1 << np.ceil(np.log2(self.size)).astype(np.int64)
        sketch = np.minimum(self.size, upper - (-(-percent * upper // 100)) + SPARE)
        self.at_least = np.maximum(1, sketch - (self.size - self.need))
        pairs = np.concatenate([s[:k] for s, k in zip(self.sets, sketch)])
        owner = np.repeat(np.arange(len(rows)), sketch)
        order = np.argsort(pairs, kind="stable")
        self.hashes, first = np.unique(pairs[order], return_index=True)
        self.owner, self.first = owner[order], np.append(first, len(pairs))

    def candidates(self, flat: np.ndarray, at: np.ndarray) -> list[tuple[int, int]]:
        """(document, item) pairs that share enough sketch minima."""
        place = np.searchsorted(self.hashes, flat)
        place[place == len(self.hashes)] = 0
        met = np.flatnonzero(self.hashes[place] == flat)
        if not len(met):
            return []
        width = self.first[place[met] + 1] - self.first[place[met]]
        base = np.repeat(self.first[place[met]] - np.concatenate(([0], np.cumsum(width)[:-1])), width)
        item = self.owner[base + np.arange(len(base))]
        doc = np.repeat(np.searchsorted(at, met, side="right") - 1, width)
        pair, count = np.unique(doc * len(self.ids) + item, return_counts=True)
        pair = pair[count >= self.at_least[pair % len(self.ids)]]
        return [(int(p) // len(self.ids), int(p) % len(self.ids)) for p in pair]


def _search_mapper(items, shingle: int, percent: int):
    """``items``: broadcast {words per shingle: [(item_id, shingle hashes)]}."""
    def run(batches):
        index = {n: ItemIndex(rows, percent) for n, rows in items.value.items()}
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            raw, offs = H.text_buffer(texts)
            out = []
            for a, b in H.chunks(offs):
                part, o = raw[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
                start, end, first = H.word_bounds(part, o)
                words = H.word_hashes(part, start, end, lower=True)
                for n, block in index.items():
                    if n == shingle:
                        flat, at = H.doc_shingles(words, first, shingle)
                    else:
                        flat, at = _short_runs(words, first, n)
                    for d, i in block.candidates(flat, at):
                        own, item = flat[at[d]:at[d + 1]], block.sets[i]
                        place = np.minimum(np.searchsorted(own, item), len(own) - 1)
                        share = int((own[place] == item).sum())
                        if 100 * share >= percent * len(item):
                            text = part[o[d]:o[d + 1]].tobytes()
                            out.append((ids[a + d].as_py(), zlib.crc32(text), _signed(xxhash.xxh64_intdigest(text, 42)),
                                        block.ids[i], share / len(item)))
            cols = list(zip(*out)) or [[]] * 5
            types = [pa.int64()] * 4 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=["doc_id", "text_crc", "text_hash", "item_id", "containment"])
    return run


def _short_runs(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``n``-word runs per document, hashed as a short item's only shingle is."""
    grams = H.ngram_hashes(words, n, stream=100 + n)
    parts = [np.unique(grams[a:max(a, b - n + 1)]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
    return (np.concatenate(parts) if parts else grams,
            np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64))))


def _signed(h: int) -> int:
    return h - (h >> 63 << 64)


def _text_hash(text) -> Column:
    """The same 64-bit hash as in the search tasks."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def contaminated(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
                 block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(doc_id, text_crc, text_hash, item_id, containment) for each document and item found in it."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = stage(item_sets(items, shingle), "items")
    total = sets.agg(F.sum("size")).first()[0] or 0
    blocks = -(-total // block_items)
    found = None
    for k in range(blocks):
        # One block: about block_items hashes, whatever the number of items.
        block = sets.where(F.pmod(F.xxhash64("item_id", "shingles"), F.lit(blocks)) == k)
        by_words: dict[int, list] = {}
        for r in block.toLocalIterator():
            # An item shorter than a shingle is one run of its own length.
            by_words.setdefault(r.words, []).append((r.item_id, bytes(r.shingles)))
        if by_words:
            sent = spark.sparkContext.broadcast(by_words)
            hits = rows.mapInArrow(_search_mapper(sent, shingle, percent), _HITS)
            found = hits if found is None else found.unionByName(hits)
    if found is None:
        return spark.createDataFrame([], _HITS)
    return stage(found, "hits")


def decontaminate(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, item_ids (ascending), containment (largest) and kept."""
    hits = contaminated(docs, items, shingle, percent)
    each = stage(hits.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"),
                                            F.max("containment").alias("containment")), "hit_docs")
    ids = docs.select(F.col("doc_id").cast("long").alias("id"), _text_hash("text").alias("hash"))
    out = ids.join(bounded(each, 72), ids.id.eqNullSafe(each.doc_id) & (ids.hash == each.text_hash), "left")
    return out.select(F.col("id").alias("doc_id"), F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
                      F.coalesce("containment", F.lit(0.0)).alias("containment"),
                      F.col("containment").isNull().alias("kept"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their own columns."""
    bad = stage(contaminated(docs, items).select(F.col("doc_id").alias("bad_id"), "text_hash").distinct(), "leaks")
    same = docs["doc_id"].cast("long").eqNullSafe(bad["bad_id"]) & (_text_hash(docs["text"]) == bad["text_hash"])
    return docs.join(bounded(bad, 32), same, "left_anti")
