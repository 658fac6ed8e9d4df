"""A compressed FM-index of integer sequences, searched for many patterns at once.

The text is the concatenation of sequences, each closed by symbol 0.  Its
Burrows-Wheeler transform is kept as a wavelet matrix: one bit vector for each
bit of a symbol, packed into 64-bit words with a running count.  The transform
comes from an order of the suffixes by their first ``depth`` symbols, which is
all that patterns up to that length need.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by the ``depth`` symbols that follow, at least (prefix doubling)."""
    rank, size = text.astype(np.int32), 1  # of up to 2 ** 31 symbols; large temporaries go as soon as they are used
    while True:
        if size >= depth:
            return np.argsort(rank, kind="stable")
        keys = rank * np.int64(int(rank.max(initial=0)) + 2)
        keys[:-size] += rank[size:]
        keys[:-size] += 1
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        new = np.zeros(len(keys), np.int32)
        new[1:] = keys[1:] != keys[:-1]
        del keys
        rank[order] = np.cumsum(new, dtype=np.int32)
        del order, new
        size *= 2


class Bits:
    """A bit vector with rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) >> 6) * 64 + 64, bool)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words))[:-1]].astype(np.int32)
        self.zeros = len(bits) - int(bits.sum())

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Set bits before position i."""
        word = i >> 6
        low = self.words[word] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)


class FMIndex:
    """Backward search over the wavelet matrix of the text's Burrows-Wheeler transform."""

    def __init__(self, text: np.ndarray, depth: int):
        order = suffix_order(text, depth)
        bwt = text[order - 1]
        self.size = len(text)
        self.levels: list[Bits] = []
        self.depth = max(1, int(text.max(initial=0)).bit_length())
        counts = np.bincount(text, minlength=1 << self.depth)
        self.first = np.cumsum(counts) - counts  # smaller symbols in the text
        for bit in range(self.depth - 1, -1, -1):
            set_ = (bwt >> bit & 1).astype(bool)
            self.levels.append(Bits(set_))
            bwt = np.concatenate([bwt[~set_], bwt[set_]])
        values, at = np.unique(bwt, return_index=True)
        self.begin = np.zeros(1 << self.depth, np.int64)  # of each symbol's run after the last level
        self.begin[values] = at

    def step(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns one symbol longer on the left."""
        n = len(symbols)
        at = np.concatenate([low, high])
        for bits, shift in zip(self.levels, range(self.depth - 1, -1, -1), strict=True):
            ones = bits.ones(at)
            set_ = np.tile((symbols >> shift & 1).astype(bool), 2)
            at = np.where(set_, bits.zeros + ones, at - ones)
        shift = self.first[symbols] - self.begin[symbols]
        return at[:n] + shift, at[n:] + shift

    def matching(self, text: np.ndarray, ends: np.ndarray, longest: int, least: int = 2) -> np.ndarray:
        """Matching statistics: for each end, the length of the longest pattern up
        to there (of ``longest`` symbols at most) that occurs ``least`` times in the index."""
        length = np.zeros(len(ends), np.int64)
        alive, low, high = np.arange(len(ends)), np.zeros(len(ends), np.int64), np.full(len(ends), self.size)
        for step in range(1, longest + 1):
            low, high = self.step(text[ends[alive] - step], low, high)
            found = high - low >= least
            alive, low, high = alive[found], low[found], high[found]
            if not len(alive):
                break
            length[alive] = step
        return length
