"""FM-index over word sequences, searched for many patterns in lock-step.

The Burrows-Wheeler transform is held in a wavelet matrix: one packed bit
vector per bit of the word number, with a running count per 64-bit block.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix order by prefix doubling, exact at least up to ``depth`` words."""
    n = len(text)
    rank, done = text.astype(np.int64), 1
    while True:
        second = np.zeros(n, np.int64)
        second[:n - done] = rank[done:] + 1
        both = rank * (int(rank.max()) + 2) + second
        order = np.argsort(both)
        step = np.empty(n, np.int64)
        step[0] = 0
        step[1:] = both[order[1:]] != both[order[:-1]]
        named = np.cumsum(step)
        rank = np.empty(n, np.int64)
        rank[order] = named
        done *= 2
        if done >= depth or named[-1] == n - 1:
            return order


class BitVector:
    """Packed bits with the number of ones before every 64-bit block."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.blocks = np.packbits(padded, bitorder="little").view(_U)
        ones = np.bitwise_count(self.blocks).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(ones)[:-1])).astype(np.int32)

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Number of ones among the first ``i`` bits."""
        block = i >> 6
        mask = (_U(1) << (i & 63).astype(_U)) - _U(1)
        return self.before[block] + np.bitwise_count(self.blocks[block] & mask)


class WaveletMatrix:
    """Rank over a sequence of numbers, one bit vector per bit."""

    def __init__(self, values: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        self.levels, self.zeros = [], []
        rest, start = values.astype(np.int64), np.zeros(sigma, np.int64)
        symbols = np.arange(sigma, dtype=np.int64)
        for level in range(self.bits):
            shift = self.bits - 1 - level
            bit = (rest >> shift) & 1
            vector, zeros = BitVector(bit), int(len(bit) - bit.sum())
            self.levels.append(vector)
            self.zeros.append(zeros)
            ones = vector.ones(start)
            start = np.where((symbols >> shift) & 1, zeros + ones, start - ones)
            rest = np.concatenate((rest[bit == 0], rest[bit == 1]))
        self.start = start

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` is among the first ``i`` values."""
        for level in range(self.bits):
            ones = self.levels[level].ones(i)
            one = (symbol >> (self.bits - 1 - level)) & 1
            i = np.where(one, self.zeros[level] + ones, i - ones)
        return i - self.start[symbol]


class FMIndex:
    """Index of word sequences (lists joined by separators) that belong to documents."""

    def __init__(self, words: np.ndarray, lengths: np.ndarray, docs: np.ndarray, depth: int):
        self.alphabet, numbers = np.unique(words, return_inverse=True)
        sep_at = np.cumsum(lengths) + np.arange(len(lengths))
        text = np.ones(len(words) + len(lengths) + 1, np.int64)
        text[-1] = 0
        solid = np.ones(len(text), bool)
        solid[sep_at] = False
        solid[-1] = False
        text[solid] = numbers + 2
        self.none = np.iinfo(docs.dtype).max
        owner = np.repeat(np.append(docs, self.none).astype(docs.dtype), np.append(lengths + 1, 1))
        order = suffix_array(text, depth)
        self.sigma = len(self.alphabet) + 2
        self.matrix = WaveletMatrix(text[order - 1], self.sigma)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=self.sigma))[:-1]))
        self.size = len(text)
        # Range minimum of document ids in suffix order.
        self.low = [owner[order]]
        width = 1
        while 2 * width <= self.size:
            prev = self.low[-1]
            self.low.append(np.minimum(prev[:len(prev) - width], prev[width:]))
            width *= 2
        self.low_flat = np.concatenate(self.low)
        self.low_at = np.concatenate(([0], np.cumsum([len(x) for x in self.low])[:-1]))

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """Word numbers; 0 (never inside a sequence) for unknown words."""
        at = np.searchsorted(self.alphabet, words)
        at[at == len(self.alphabet)] = 0
        return np.where(self.alphabet[at] == words, at + 2, 0)

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: suffix intervals of symbol + pattern."""
        n = len(symbol)
        both = self.matrix.rank(np.concatenate((symbol, symbol)), np.concatenate((lo, hi)))
        base = self.before[symbol]
        return base + both[:n], base + both[n:]

    def smallest(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Smallest document in each suffix interval (empty: the type's largest number)."""
        out = np.full(len(lo), self.none)
        some = np.flatnonzero(hi > lo)
        if len(some):
            a, width = lo[some], hi[some] - lo[some]
            level = np.frexp(width.astype(np.float64))[1] - 1
            base = self.low_at[level]
            out[some] = np.minimum(self.low_flat[base + a], self.low_flat[base + hi[some] - (1 << level)])
        return out


def earlier_windows(index: FMIndex, words: np.ndarray, lengths: np.ndarray, docs: np.ndarray,
                    window: int) -> np.ndarray:
    """For every word position: does the window that starts there occur in a smaller document?

    All patterns advance one backward step at a time. A pattern scans a window
    from its right end; a failed match w[i..e] rules out every window that
    holds it, so the scan goes on at i + 1. After a full window the match is
    stretched to the right end of the pattern, or by halving to the longest
    stretch, so long matches cost no step per window.
    """
    numbers = index.numbers(words)
    base = np.cumsum(lengths) - lengths
    last = lengths - 1                       # last word of each pattern
    hit = np.zeros(len(words) + 1, np.int64)  # +1/-1 at ends of matched runs of window starts
    # Lane state: s = first word wanted, e = last word of the tried stretch, good/bad = known ends while stretching.
    lane = np.flatnonzero(lengths >= window)
    s = np.zeros(len(lane), np.int64)
    e = np.full(len(lane), window - 1, np.int64)
    good, bad = np.full(len(lane), -1), np.full(len(lane), -1)
    i = e.copy()
    lo, hi = np.zeros(len(lane), np.int64), np.full(len(lane), index.size)
    while len(lane):
        lo, hi = index.extend(numbers[base[lane] + i], lo, hi)
        fine = index.smallest(lo, hi) < docs[lane]
        i = np.where(fine, i - 1, i)
        full, failed = fine & (i < s), ~fine
        turn = np.flatnonzero(full | failed)
        if not len(turn):
            continue
        stretch = good[turn] >= 0
        won, at = full[turn], i[turn]
        end = last[lane[turn]]
        # Stretching: narrow (good, bad); plain scan: a full window starts stretching, a failure skips.
        g = np.where(won, e[turn], good[turn])
        b = np.where(stretch, np.where(won, bad[turn], e[turn]), end + 1)
        skip = ~stretch & ~won
        more = ~skip & (g + 1 < b)
        ended = ~skip & ~more                # stretch [s..g] is as long as it gets
        first = base[lane[turn]]
        np.add.at(hit, first[ended] + s[turn][ended], 1)
        np.add.at(hit, first[ended] + g[ended] - window + 2, -1)
        fresh = ~stretch & won
        tried = np.where(fresh, end, (g + b) // 2)
        s[turn] = np.where(skip, at + 1, np.where(ended, g - window + 2, s[turn]))
        e[turn] = np.where(more, tried, s[turn] + window - 1)
        good[turn] = np.where(more, g, -1)
        bad[turn] = np.where(more, b, -1)
        i[turn] = e[turn]
        lo[turn], hi[turn] = 0, index.size
        live = s + window - 1 <= last[lane]
        live |= good >= 0
        if not live.all():
            lane, s, e, good, bad, i, lo, hi = (x[live] for x in (lane, s, e, good, bad, i, lo, hi))
    return np.cumsum(hit)[:-1] > 0
