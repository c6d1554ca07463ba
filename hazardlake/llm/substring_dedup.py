"""Substring dedup: FM-index shards answer which word windows occur in an earlier document.

A window is ``WINDOW`` consecutive words of one document; a word is removed if
a window that covers it also starts in a document with a smaller doc_id.

1. Routing. The key of a window is the smallest hash among its ``GRAM``-word
   runs, so equal windows have equal keys wherever they are. Neighbouring
   windows with one key form a passage (stored as key, document, position and a
   128-bit content hash); equal passages are pre-aggregated to their smallest
   document before any shuffle is read. Keys met in one document only are
   dropped: none of their windows can repeat.
2. Index. Each distinct passage that is left goes once to the shard of its key.
   A shard holds whole keys up to a bounded number of words; there
   an FM-index is built: suffix array by prefix doubling, Burrows-Wheeler
   transform in a wavelet matrix with packed bit vectors, and a range-minimum
   table of document ids in suffix order.
3. Search. Passages are streamed against their shard's index, all in
   lock-step: backward search extends matches to the left while the suffix
   interval still holds a smaller document, skips the windows that a failed
   match excludes, and finds the longest matches. Intervals of at
   least ``WINDOW`` words are reported.
4. The intervals go back to every document that holds the passage.

A key with very many distinct passages is dealt into several index parts of
bounded size; its passages are searched in each part, so nothing is capped.
Words are compared by 64-bit hashes. Null and short texts lose nothing.
A row is known by its doc_id and the hash of its text, so rows that share a doc_id or have none keep
their own spans; a null doc_id sorts last, and rows with one doc_id never take words from each other.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.llm import hashing as H
from hazardlake.llm.fm_index import FMIndex, earlier_windows
from hazardlake.llm.staging import bounded, drop, stage

WINDOW, GRAM = 50, 10
#: Windows of one passage at most, words of one index, passages of one key in an index part.
PASSAGE_WINDOWS, SHARD_WORDS, PART_PASSAGES = 64, 400_000, 20_000
_NO_ID = np.iinfo(np.int64).max
_U = np.uint64
_PASSAGES = "key long, doc_id long, text_key long, first int, windows int, h1 long, h2 long"


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values (prefix and suffix minima of blocks)."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    blocks = -(-len(x) // width)
    full = np.full(blocks * width, np.iinfo(x.dtype).max, x.dtype)
    full[:len(x)] = x
    full = full.reshape(blocks, width)
    left = np.minimum.accumulate(full, axis=1).ravel()
    right = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1:width - 1 + n])


class _RunHash:
    """128-bit hash of any run of words, from prefix sums with an invertible base."""

    def __init__(self):
        self.base = H.seeds(2, 41) | _U(1)
        self.base[self.base % _U(4) == 3] += _U(2)
        self.inverse = np.array([pow(int(b), -1, 1 << 64) for b in self.base], _U)
        self.up, self.down = [np.ones(1, _U)] * 2, [np.ones(1, _U)] * 2

    def __call__(self, words: np.ndarray, start: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
        out = []
        for j in range(2):
            if len(self.up[j]) < len(words) + 1:
                step = np.full(len(words) + 1, self.base[j], _U)
                step[0] = 1
                self.up[j] = np.cumprod(step)
                step = np.full(len(words) + 1, self.inverse[j], _U)
                step[0] = 1
                self.down[j] = np.cumprod(step)
            value = H.mix64(words + H.seeds(1, 43 + j)[0]) * self.up[j][:len(words)]
            prefix = np.concatenate((np.zeros(1, _U), np.cumsum(value)))
            raw = (prefix[start + length] - prefix[start]) * self.down[j][start]
            out.append(H.mix64(raw + length.astype(_U)).view(np.int64))
        return out


def passages(words: np.ndarray, bounds: np.ndarray, window: int, gram: int):
    """(document index, key, first window start in the document, windows) of all passages."""
    grams = H.ngram_hashes(words, gram, stream=47)
    low = sliding_min(grams, window - gram + 1)
    size = np.diff(bounds)
    count = np.maximum(size - window + 1, 0)
    doc = np.repeat(np.arange(len(size)), count)
    total = int(count.sum())
    inside = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
    key = low[np.repeat(bounds[:-1], count) + inside]
    if not total:
        return doc, key, inside, inside
    new = np.ones(total, bool)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)
    length = np.diff(np.append(head, total))
    if length.max() > PASSAGE_WINDOWS:
        at = np.arange(total) - np.repeat(head, length)
        head = np.flatnonzero(at % PASSAGE_WINDOWS == 0)
        length = np.diff(np.append(head, total))
    return doc[head], key[head], inside[head], length


def _passage_mapper(window: int, gram: int):
    def run(batches):
        run_hash = _RunHash()
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            raw, offs = H.text_buffer(batch.column(1))
            for a, b in H.chunks(offs):
                part, o = raw[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
                start, end, bounds = H.word_bounds(part, o)
                words = H.word_hashes(part, start, end)
                doc, key, first, count = passages(words, bounds, window, gram)
                h1, h2 = run_hash(words, bounds[doc] + first, count + window - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(ids[a + doc]), pa.array(texts[a + doc]),
                     pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(h1), pa.array(h2)],
                    names=["key", "doc_id", "text_key", "first", "windows", "h1", "h2"])
    return run


def _content_mapper(window: int):
    """Documents with wanted passages -> one row per passage with its word hashes."""
    def run(batches):
        for batch in batches:
            raw, offs = H.text_buffer(batch.column(1))
            wanted = batch.column(2)
            at = wanted.offsets.to_numpy()
            flat = wanted.values
            # A sliced list column keeps the values of its parent.
            first, count = (flat.field(f).to_numpy() for f in ("first", "windows"))
            for a, b in H.chunks(offs):
                part, o = raw[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
                start, end, bounds = H.word_bounds(part, o)
                words = H.word_hashes(part, start, end)
                some = slice(int(at[a]), int(at[b]))
                doc = np.repeat(np.arange(b - a), np.diff(at[a:b + 1]))
                begin = bounds[doc] + first[some]
                length = count[some].astype(np.int64) + (window - 1)
                content = [words[x:x + n].tobytes() for x, n in zip(begin.tolist(), length.tolist())]
                rows = flat.slice(some.start, some.stop - some.start)
                yield pa.RecordBatch.from_arrays(
                    [rows.field("key"), rows.field("h1"), rows.field("h2"), rows.field("rep"),
                     rows.field("parts"), pa.array(content, pa.binary())],
                    names=["key", "h1", "h2", "doc_id", "parts", "words"])
    return run


def _search_mapper(window: int, shard_words: int):
    """Rows (key, part, indexed, h1, h2, doc_id, words) sorted by (key, part) -> repeated intervals."""
    def answer(rows):
        indexed = np.array([r[0] for r in rows], bool)
        # Documents by rank: the range-minimum table then takes four bytes an entry.
        docs = np.unique(np.array([r[3] for r in rows], np.int64), return_inverse=True)[1].astype(np.int32)
        text = [np.frombuffer(r[4], np.uint64) for r in rows]
        size = np.array([len(x) for x in text], np.int64)
        chosen = np.flatnonzero(indexed)
        depth = int(size.max())
        index = FMIndex(np.concatenate([text[i] for i in chosen]), size[chosen], docs[chosen], depth)
        hit = earlier_windows(index, np.concatenate(text), size, docs, window)
        edge = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
        first = np.cumsum(size) - size
        begin, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        who = np.searchsorted(first, begin, side="right") - 1
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[i][1] for i in who], pa.int64()), pa.array([rows[i][2] for i in who], pa.int64()),
             pa.array((begin - first[who]).astype(np.int32)), pa.array((stop - first[who]).astype(np.int32))],
            names=["h1", "h2", "a", "z"])

    def run(batches):
        rows, held, group = [], 0, None
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            for key, part, *row in zip(*cols):
                if (key, part) != group:
                    if held >= shard_words:
                        yield answer(rows)
                        rows, held = [], 0
                    group = (key, part)
                rows.append(row)
                held += len(row[4]) // 8
        if rows:
            yield answer(rows)
    return run


def _removal_mapper(window: int):
    """(doc_id, text, spans of window starts) -> word counts and the text that is left."""
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            raw, offs = H.text_buffer(batch.column(1))
            spans = batch.column(2)
            for a, b in H.chunks(offs):
                part, o = raw[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
                start, end, bounds = H.word_bounds(part, o)
                mark = np.zeros(len(start) + 1, np.int32)
                some = spans.slice(a, b - a)
                for i, ranges in enumerate(some):
                    if ranges.is_valid:
                        flat, size = ranges.values, bounds[i + 1] - bounds[i]
                        np.add.at(mark, bounds[i] + np.clip(flat.field("a").to_numpy(), 0, size), 1)
                        np.add.at(mark, bounds[i] + np.clip(flat.field("z").to_numpy() + (window - 1), 0, size), -1)
                gone = np.cumsum(mark)[:-1] > 0
                removed = np.concatenate(([0], np.cumsum(gone)))
                kept = np.flatnonzero(~gone)
                # A kept word takes the white space byte before it along unless it is the first kept one of its text.
                lead = np.zeros(len(kept), bool)
                home = np.searchsorted(bounds, kept, side="right")
                lead[1:] = home[1:] == home[:-1]
                edge = np.zeros(len(part) + 1, np.int8)
                edge[start[kept]] += 1
                edge[end[kept]] -= 1
                take = np.cumsum(edge[:-1]).astype(bool)
                take[start[kept[lead]] - 1] = True
                clean = np.where(_is_space(part), np.uint8(32), part)[take]
                offsets = np.concatenate(([0], np.cumsum(take)))[o].astype(np.int32)
                text = pa.StringArray.from_buffers(b - a, pa.py_buffer(offsets), pa.py_buffer(clean))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(np.diff(bounds)),
                     pa.array(removed[bounds[1:]] - removed[bounds[:-1]]), text],
                    names=["doc_id", "n_words", "n_removed", "kept_text"])
    return run


def _is_space(raw: np.ndarray) -> np.ndarray:
    return (raw == 32) | ((raw >= 9) & (raw <= 13))


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text, text_key): null ids last, rows told apart by the hash of their text."""
    text = F.col("text").cast("string")
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"), text.alias("text"),
                       F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM,
                   part_passages: int = PART_PASSAGES, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, text_key, spans): per row with repeats, ranges [a, z) of window starts met in a smaller document."""
    rows = _rows(docs)
    found = stage(rows.mapInArrow(_passage_mapper(window, gram), _PASSAGES), "passages")
    keys = stage(found.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
                 .where("lo < hi").select("key"), "keys")
    held = stage(found.join(bounded(keys, 16), "key"), "held")
    texts = (held.groupBy("key", "h1", "h2").agg(F.min(F.struct("doc_id", "text_key")).alias("low"))
             .select("key", "h1", "h2", F.col("low.doc_id").alias("rep"), F.col("low.text_key").alias("rep_key")))
    size = texts.groupBy("key").agg(F.count("*").alias("parts"))
    texts = stage(texts.join(size, "key").withColumn("parts", F.ceil(F.col("parts") / part_passages).cast("int")),
                  "texts")
    home = (held.join(texts, ["key", "h1", "h2"]))
    wanted = stage(home.where("doc_id = rep and text_key = rep_key").groupBy("rep", "rep_key", "key", "h1", "h2", "parts")
                   .agg(F.min("first").alias("first"), F.first("windows").alias("windows"))
                   .groupBy(F.col("rep").alias("doc_id"), F.col("rep_key").alias("text_key"))
                   .agg(F.collect_list(F.struct("key", "h1", "h2", "rep", "parts", "first", "windows"))
                        .alias("wanted")), "wanted")
    content = (rows.join(wanted, ["doc_id", "text_key"]).select("doc_id", "text", "wanted")
               .mapInArrow(_content_mapper(window), "key long, h1 long, h2 long, doc_id long, parts int, words binary"))
    dealt = (content.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("key", "part", (F.pmod("h1", "parts") == F.col("part")).alias("indexed"),
                     "h1", "h2", "doc_id", "words")
             .repartition("key", "part").sortWithinPartitions("key", "part"))
    hits = stage(dealt.mapInArrow(_search_mapper(window, shard_words), "h1 long, h2 long, a int, z int")
                 .distinct(), "hits")
    first = F.col("first")
    # The passage's smallest document has the searched intervals; in later ones every window has a smaller copy.
    own = (home.where("doc_id = rep").join(hits, ["h1", "h2"])
           .select("doc_id", "text_key", (first + F.col("a")).alias("a"), (first + F.col("z")).alias("z")))
    later = home.where("doc_id > rep").select("doc_id", "text_key", first.alias("a"), (first + F.col("windows")).alias("z"))
    spans = stage(own.unionByName(later).groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("a", "z")).alias("spans")),
                  "spans")
    drop(found, keys, held, texts, wanted, hits)
    return spans


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, **limits) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) for every row of documents (doc_id, text, ...)."""
    spans = repeated_spans(docs, window, gram, **limits)
    out = (_rows(docs).join(spans, ["doc_id", "text_key"], "left").select("doc_id", "text", "spans")
           .mapInArrow(_removal_mapper(window), "doc_id long, n_words long, n_removed long, kept_text string"))
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(_NO_ID)))
