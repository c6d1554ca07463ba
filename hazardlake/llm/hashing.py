"""Vectorised word and shingle hashing over Arrow batches.

These helpers run inside ``mapInArrow`` tasks: they view the UTF-8 buffer of a
string column directly, so no Python string is made per row or per word. A
word is a maximal run of bytes outside space, tab, LF, VT, FF and CR.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text hashed at once; bounds the temporary arrays of one task.
CHUNK_BYTES = 1 << 20

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (public splitmix64 constants)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def seeds(n: int, stream: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers; the same on every executor."""
    return mix64((np.arange(1, n + 1, dtype=_U) + _U(stream << 32)) * _U(0x9E3779B97F4A7C15))


class _ByteHash:
    """Polynomial hash over per-byte random numbers; one instance per stream."""

    def __init__(self, stream: int):
        self.table = seeds(256, stream)
        self.table[_SPACE] = 0
        self.base = seeds(1, stream + 1)[0] | _U(1)
        self.powers = np.ones(1, _U)

    def power(self, n: int) -> np.ndarray:
        if len(self.powers) < n:
            step = np.full(max(n, 64), self.base, _U)
            step[0] = 1
            self.powers = np.cumprod(step)
        return self.powers


_HASHES: dict[int, _ByteHash] = {}


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    column = pc.fill_null(column, "")
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of about ``limit`` bytes each (one at least)."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, end byte, first word of each document) for all words."""
    solid = ~_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(raw), bool)
    if len(raw):
        before[1:] = solid[:-1]
        before &= ~edge[:-1]
    start = np.flatnonzero(solid & ~before)
    after = np.zeros(len(raw), bool)
    if len(raw):
        after[:-1] = solid[1:]
        after &= ~edge[1:]
    end = np.flatnonzero(solid & ~after) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, stream: int = 1,
                lower: bool = False) -> np.ndarray:
    """One 64-bit hash per word."""
    if not len(start):
        return np.zeros(0, _U)
    if stream not in _HASHES:
        _HASHES[stream] = _ByteHash(stream)
    h = _HASHES[stream]
    first = int(start[0])
    body = raw[first:]
    if lower:
        body = _LOWER[body]
    length = np.diff(np.append(start, len(raw)))
    at = np.arange(len(body), dtype=np.int64) - np.repeat(start - first, length)
    value = h.table[body] * h.power(int(length.max()))[at]
    return mix64(np.add.reduceat(value, start - first) + (end - start).astype(_U) * h.base)


def run_hashes(raw: np.ndarray, start: np.ndarray, stream: int) -> np.ndarray:
    """One 64-bit hash per run of bytes; runs begin at ``start`` and end at the next one. Every byte counts."""
    if not len(start):
        return np.zeros(0, _U)
    if stream not in _HASHES:
        _HASHES[stream] = _ByteHash(stream)
        _HASHES[stream].table = seeds(256, stream)
    h = _HASHES[stream]
    length = np.diff(np.append(start, len(raw)))
    at = np.arange(len(raw) - int(start[0]), dtype=np.int64) - np.repeat(start - int(start[0]), length)
    value = h.table[raw[int(start[0]):]] * h.power(int(length.max()))[at]
    return mix64(np.add.reduceat(value, start - int(start[0])) + length.astype(_U) * h.base)


def ngram_hashes(words: np.ndarray, n: int, stream: int = 11) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words, document ends ignored."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, _U)
    out = np.zeros(count, _U)
    for j, c in enumerate(seeds(n, stream) | _U(1)):
        out += words[j:j + count] * c
    return mix64(out)


def doc_shingles(words: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, document bounds) of the distinct ``n``-word shingles, sorted per document.

    A document with 1 to n-1 words has its whole sequence as one shingle; one
    without words has none.
    """
    grams = ngram_hashes(words, n)
    parts, sizes = [], np.zeros(len(bounds) - 1, np.int64)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if b - a >= n:
            s = np.unique(grams[a:b - n + 1])
        elif b > a:
            s = ngram_hashes(words[a:b], b - a, stream=100 + (b - a))
        else:
            continue
        parts.append(s)
        sizes[i] = len(s)
    flat = np.concatenate(parts) if parts else np.zeros(0, _U)
    return flat, np.concatenate(([0], np.cumsum(sizes)))
