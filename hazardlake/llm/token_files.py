"""Token-ID files: flat unsigned integers plus 64-bit document offsets.

A folder holds, for each part p, in ascending doc_id order over all parts:
``tokens-p.bin`` (ids as little-endian uint16, or uint32 for vocabularies beyond
65,536), ``offsets-p.bin`` (uint64: global start of each document, and the end
of the last) and ``docs-p.bin`` (int64 doc_ids). Readers map them into memory.

Documents are range-sorted by doc_id; each task encodes and writes one part.
The parts' token counts, one row each, are added up to the parts' bases, and a
second pass over the small offset files makes them global. A file is written
under a name of its attempt and then renamed, so repeated and speculative
attempts leave one whole file. The folder must be mounted on all executors,
since files are mapped into memory; the text itself only moves through Spark.

With ``special_ids`` (``encode_documents`` sets it) a special token's string inside a
text gets the special id, the tokenizer's default; without it, it is plain text.

Null texts are empty: they hold the end id only. A null doc_id is stored as the
largest 64-bit number, comes last, and is read back as null. Repeated doc_ids are kept.
"""

from __future__ import annotations

import os
import re
import zlib
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.llm import hashing as H
from hazardlake.llm.staging import new_path

_NO_ID = np.iinfo(np.int64).max
#: Bytes of text encoded at once in one task; units remembered by a Python worker.
_CHUNK_BYTES, _CACHE_UNITS = 1 << 21, 2_000_000
_ASCII_SOLID = np.zeros(256, bool)
_ASCII_SOLID[0x21:0x7F] = True
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: Lead bytes of two-byte characters without white space among them.
_TWO_BYTES = np.zeros(256, bool)
_TWO_BYTES[0xC3:0xE0] = True


def unit_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First bytes of the units that a chunk of documents is encoded in.

    Units begin at document starts and at certain borders of byte-level
    pre-tokenization: a single space or line feed between two characters that
    surely are no white space, and a comma or full stop after an ASCII letter
    that closes a word. BPE merges never cross them, so the ids of a text
    are those of its units joined.
    """
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64)
    before = np.zeros(n, bool)
    before[1:] = _ASCII_SOLID[raw[:-1]]
    before[2:] |= (raw[1:-1] >= 0x80) & _TWO_BYTES[raw[:-2]]
    after = np.zeros(n, bool)
    after[:-1] = _ASCII_SOLID[raw[1:]] | _TWO_BYTES[raw[1:]] | (raw[1:] >= 0xE4)
    filled = offsets[:-1][np.diff(offsets) > 0]
    before[filled] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    cut = ((raw == 32) | (raw == 10)) & before & after
    closes = np.zeros(n, bool)
    closes[:-1] = cut[1:]
    closes[offsets[1:][offsets[1:] > 0] - 1] = True
    mark = ((raw == 44) | (raw == 46)) & closes
    mark[0] = False
    mark[1:] &= _ASCII_LETTER[raw[:-1]]
    cut |= mark
    cut[filled] = True
    return np.flatnonzero(cut)


class _Rows:
    """A numpy array that grows at its end."""

    def __init__(self, values: np.ndarray):
        self.data, self.n = values, len(values)

    def append(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.data):
            grown = np.empty(2 * (self.n + len(values)), self.data.dtype)
            grown[:self.n] = self.data[:self.n]
            self.data = grown
        self.data[self.n:self.n + len(values)] = values
        self.n += len(values)


class UnitEncoder:
    """Encodes texts unit by unit with the tokenizers library, each distinct unit once.

    The ids of known units lie in one pool; a unit is looked up by a 64-bit hash of its
    bytes in a sorted array. ``special_ids``: a special token's string gets its id, the
    tokenizer's default, and is not read as plain text. Tokenizer and pool outlive a task in its Python worker.
    """

    def __init__(self, tokenizer_json: str, dtype: str, end_id: int, special_ids: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers
        shared = tokenizers.__dict__.setdefault("_unit_encoders", {})
        key = (zlib.crc32(tokenizer_json.encode()), dtype, end_id, special_ids)
        if key not in shared:
            tokenizer = tokenizers.Tokenizer.from_str(tokenizer_json)
            tokenizer.encode_special_tokens = not special_ids
            vocab = tokenizer.get_vocab()
            opens = np.zeros(max(vocab.values()) + 1, bool)
            # "\u0120" is how byte-level vocabularies write a space.
            opens[[i for t, i in vocab.items() if t.startswith("\u0120")]] = True
            added = sorted((t for t in tokenizer.get_added_tokens_decoder().values()
                            if t.content and (special_ids or not t.special)),
                           key=lambda t: -len(t.content.encode()))
            shared[key] = {"tokenizer": tokenizer, "opens": opens,
                           "special": re.compile(b"|".join(re.escape(t.content.encode()) for t in added)) if added else None,
                           "apart": not any(t.lstrip or t.rstrip or t.single_word for t in added)}
        self.state, self.dtype, self.end_id = shared[key], np.dtype(dtype), end_id
        if "keys" not in self.state:
            self._clear()

    def _clear(self) -> None:
        """Unit 0 is the end of a document."""
        self.state |= {"keys": np.zeros(0, np.uint64), "unit": np.zeros(0, np.int64),
                       "pool": _Rows(np.array([self.end_id], self.dtype)),
                       "begin": _Rows(np.zeros(1, np.int64)), "width": _Rows(np.ones(1, np.int64))}

    def _starts(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Unit starts where added tokens are units of their own.

        Where a token takes its surroundings into account, a document that holds one is one unit.
        """
        start, special = unit_starts(raw, offsets), self.state["special"]
        data = raw.tobytes() if special else b""
        if not special or not special.search(data):
            return start
        inside, more = np.zeros(len(raw) + 1, bool), []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            for m in special.finditer(data, a, b):
                lo, hi = m.span() if self.state["apart"] else (a, b)
                inside[lo + 1:hi] = True
                more += [lo] + ([hi] if hi < b else [])
                if not self.state["apart"]:
                    break
        return np.union1d(start[~inside[start]], np.array(more, np.int64))

    def _each(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.state["tokenizer"].encode_batch_fast(units, add_special_tokens=False)
        ids = [e.ids for e in found]
        return (np.array([i for x in ids for i in x], self.dtype), np.array([len(x) for x in ids], np.int64))

    def _joined(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Units " word" encoded as one text; a token that opens with a space begins the next unit."""
        ids = np.array(self.state["tokenizer"].encode_batch_fast(["".join(units)], add_special_tokens=False)[0].ids,
                       self.dtype)
        start = np.flatnonzero(self.state["opens"][ids])
        if len(start) != len(units):
            return self._each(units)
        return ids, np.diff(np.append(start, len(ids)))

    def _learn(self, units: list[str]) -> np.ndarray:
        """Adds units to the pool; returns their numbers."""
        state, out = self.state, np.zeros(len(units), np.int64)
        plain = np.array([u[0] == " " and u.split() == [u[1:]] for u in units], bool)
        for group, encode in ((np.flatnonzero(plain), self._joined), (np.flatnonzero(~plain), self._each)):
            if len(group):
                ids, width = encode([units[i] for i in group])
                out[group] = state["begin"].n + np.arange(len(group))
                state["begin"].append(state["pool"].n + np.cumsum(width) - width)
                state["width"].append(width)
                state["pool"].append(ids)
        return out

    def __call__(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per document) of a chunk of documents; the end id closes each."""
        state, n_docs = self.state, len(offsets) - 1
        start = self._starts(raw, offsets)
        known, first, place = np.unique(H.run_hashes(raw, start, stream=61), return_index=True, return_inverse=True)
        if len(state["keys"]) > _CACHE_UNITS:
            self._clear()
        at = np.searchsorted(state["keys"], known)
        met = np.zeros(len(known), bool)
        inside = at < len(state["keys"])
        met[inside] = state["keys"][at[inside]] == known[inside]
        unit = np.zeros(len(known), np.int64)
        unit[met] = state["unit"][at[met]]
        fresh = np.flatnonzero(~met)
        if len(fresh):
            end = np.append(start[1:], len(raw))
            data, pick = raw.tobytes(), first[fresh]
            unit[fresh] = self._learn([data[a:b].decode() for a, b in zip(start[pick].tolist(), end[pick].tolist())])
            state["keys"] = np.insert(state["keys"], at[fresh], known[fresh])
            state["unit"] = np.insert(state["unit"], at[fresh], unit[fresh])
        bounds = np.searchsorted(start, offsets)
        order = np.insert(unit[place], bounds[1:], 0)
        width = state["width"].data[order]
        total = np.cumsum(width)
        ids = state["pool"].data[np.repeat(state["begin"].data[order] - (total - width), width)
                                 + np.arange(int(total[-1]) if n_docs else 0)]
        ends = total[bounds[1:] + np.arange(n_docs)]
        return ids, np.diff(np.concatenate(([0], ends)))


def local_folder(path: str) -> str:
    """The POSIX path of a shared folder; other stores cannot be mapped into memory."""
    u = urlparse(path)
    if u.scheme not in ("", "file"):
        raise ValueError(f"token files need a folder mounted on all executors, not {u.scheme}://")
    return u.path


def _replace(folder: str, name: str, data) -> None:
    tmp = f"{folder}/.{name}.{TaskContext.get().taskAttemptId()}"
    data.tofile(tmp)
    os.replace(tmp, f"{folder}/{name}")


def _write_mapper(folder: str, tokenizer_json: str, dtype: str, end_id: int, special_ids: bool):
    def run(batches):
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        os.makedirs(folder, exist_ok=True)
        encode = UnitEncoder(tokenizer_json, dtype, end_id, special_ids)
        sizes, docs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        name = f"tokens-{part:05d}.bin"
        with open(f"{folder}/.{name}.{attempt}", "wb") as out:
            for batch in batches:
                docs.append(batch.column(0).to_numpy())
                raw, offs = H.text_buffer(batch.column(1))
                for a, b in H.chunks(offs, _CHUNK_BYTES):
                    ids, size = encode(raw[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
                    ids.tofile(out)
                    sizes.append(size)
        os.replace(f"{folder}/.{name}.{attempt}", f"{folder}/{name}")
        offsets = np.concatenate(([0], np.cumsum(np.concatenate(sizes)))).astype("<u8")
        ids = np.concatenate(docs)
        _replace(folder, f"docs-{part:05d}.bin", ids.astype("<i8"))
        _replace(folder, f"local-{part:05d}.bin", offsets)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(ids)], pa.int64()),
                                          pa.array([int(offsets[-1])], pa.int64())],
                                         names=["part", "n_docs", "n_tokens"])
    return run


def _base_mapper(folder: str):
    def run(batches):
        for batch in batches:
            for part, base in zip(*(c.to_pylist() for c in batch.columns)):
                offsets = np.fromfile(f"{folder}/local-{part:05d}.bin", "<u8") + np.uint64(base)
                _replace(folder, f"offsets-{part:05d}.bin", offsets)
            yield batch
    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer_json: str, end_id: int = 0,
                      special_ids: bool = False) -> dict:
    """Encode all documents into ``folder``; returns the manifest (parts, bases, type of ids)."""
    from tokenizers import Tokenizer
    spark = docs.sparkSession
    local = local_folder(folder)
    dtype = "<u2" if Tokenizer.from_str(tokenizer_json).get_vocab_size() <= 1 << 16 else "<u4"
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(int(_NO_ID))).alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
    stats = sorted(ordered.mapInArrow(_write_mapper(local, tokenizer_json, dtype, end_id, special_ids),
                                      "part int, n_docs long, n_tokens long").collect())
    bases, at = [], 0
    for s in stats:
        bases.append((s.part, at))
        at += s.n_tokens
    if bases:
        spread = spark.createDataFrame(bases, "part int, base long").repartition(min(len(bases), 64))
        spread.mapInArrow(_base_mapper(local), "part int, base long").count()
    return {"folder": local, "dtype": dtype, "parts": [b for b, s in zip(bases, stats) if s.n_docs]}


def _read_mapper(folder: str, dtype: str):
    def run(batches):
        for batch in batches:
            for part in batch.column(0).to_pylist():
                docs = np.fromfile(f"{folder}/docs-{part:05d}.bin", "<i8")
                offsets = np.memmap(f"{folder}/offsets-{part:05d}.bin", "<u8", "r")
                tokens = np.asarray(np.memmap(f"{folder}/tokens-{part:05d}.bin", dtype, "r"))
                base, step = int(offsets[0]), 20_000
                for i in range(0, len(docs), step):
                    at = offsets[i:i + step + 1].astype(np.int64)
                    crc = [zlib.crc32(tokens[a - base:b - base].astype("<u4").tobytes())
                           for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                    ids = docs[i:i + step]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, mask=ids == _NO_ID), pa.array(at[:-1]), pa.array(np.diff(at)),
                         pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read_token_files(spark: SparkSession, manifest: dict) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the mapped files."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not manifest["parts"]:
        return spark.createDataFrame([], schema)
    parts = spark.createDataFrame(manifest["parts"], "part int, base long")
    return (parts.repartition(len(manifest["parts"]), "part")
            .mapInArrow(_read_mapper(manifest["folder"], manifest["dtype"]), schema))


def encode_documents(docs: DataFrame, tokenizer_json: str) -> DataFrame:
    """Write the documents' token files to the shared folder and read them back."""
    spark = docs.sparkSession
    return read_token_files(spark, write_token_files(docs, new_path(spark, "tokens"), tokenizer_json,
                                                     special_ids=True))
