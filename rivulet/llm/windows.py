"""Where windows of a fixed number of units can repeat: anchors and segments.

A text is a sequence of units (words or bytes).  Of the ``gram``-unit grams in
each window of ``window`` units, the one of least hash (the leftmost of equals)
is the window's anchor.  Equal windows have equal anchors, so windows need only be
compared where their anchors are equal.  Neighbouring windows with the same
anchor make one segment: ``count`` windows from ``start`` on, that is
``count + window - 1`` units.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import xxhash

#: Windows handled at once in one array, and bits of a key that hold a place in it.
BLOCK = 1 << 16
PLACE_BITS = 21
BASE = 0x9E3779B97F4A7C15 | 1


@dataclass(frozen=True)
class Unit:
    """What a text consists of, and the windows and grams that are compared."""

    words: bool
    window: int
    gram: int

    def codes(self, text: bytes) -> np.ndarray:
        """A 64-bit hash for each unit."""
        if self.words:
            words = text.split()
            return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        return _byte_codes()[np.frombuffer(text, np.uint8)]


@functools.lru_cache(1)
def _byte_codes() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def gram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n units from each position on."""
    part, size, out, done = codes, 1, None, 0
    while True:
        if n & size:
            if out is None:
                out, done = part, size
            else:
                m = len(codes) - done - size + 1
                out = out[:m] + part[done:done + m] * np.uint64(pow(BASE, done, 1 << 64))
                done += size
        if done == n:
            return mixed(out)
        m = len(codes) - 2 * size + 1
        part = part[:m] + part[size:size + m] * np.uint64(pow(BASE, size, 1 << 64))
        size *= 2


def least_from(values: np.ndarray, width: int) -> np.ndarray:
    """Least of the ``width`` values from each position on."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    if size < width:
        values = np.minimum(values[:len(values) - (width - size)], values[width - size:])
    return values


def segments(codes: np.ndarray, sizes: np.ndarray, unit: Unit) -> tuple[np.ndarray, ...]:
    """Segments of several texts whose units stand in one array, ``sizes`` of them each.

    Gives arrays (text, start, count, anchor): start counts units of the text.
    What exceeds a block is handled in overlapping blocks, whose ends cut
    segments and nothing else; a text has the same segments beside any others
    as long as they fit one block together, or it stands alone.
    """
    ends = np.cumsum(sizes)
    found = []
    total = len(codes) - unit.window + 1
    for a in range(0, max(total, 0), BLOCK):
        b = min(a + BLOCK, total)  # window starts a to b
        part = codes[a:b + unit.window - 1]
        grams = gram_hashes(part, unit.gram)
        bits = np.uint64(PLACE_BITS)
        keys = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
        at = (least_from(keys, unit.window - unit.gram + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        starts = np.arange(a, b)
        text = np.searchsorted(ends, starts, side="right") if len(ends) > 1 else np.zeros(b - a, np.int64)
        whole = starts + unit.window <= ends[text]
        new = np.r_[True, (at[1:] != at[:-1]) | (text[1:] != text[:-1]) | ~whole[:-1]] & whole
        first = np.flatnonzero(new)
        # a segment ends where the next begins or where its text has no more windows
        last = np.minimum(np.r_[first[1:], b - a], ends[text[first]] - unit.window + 1 - a)
        found.append((text[first], first + a - (ends - sizes)[text[first]], last - first, grams[at[first]]))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def range_hashes(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hash of the units in each of the given ranges of one array (ranges of up to a few thousand units)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    order = np.argsort(starts, kind="stable")
    out = np.zeros(len(starts), np.uint64)
    for i in range(0, len(order), 1 << 16):
        some = order[i:i + (1 << 16)]
        low, high = int(starts[some[0]]), int((starts[some] + sizes[some]).max())
        powers, inverse = _powers(high - low + 1)
        sums = np.r_[np.uint64(0), np.cumsum(codes[low:high] * powers[:high - low])]
        a, b = starts[some] - low, starts[some] + sizes[some] - low
        out[some] = (sums[b] - sums[a]) * inverse[a] + sizes[some].astype(np.uint64) * np.uint64(BASE)
    return mixed(out)


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << n.bit_length()
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS


def spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers begin, begin + 1, ... of each range, one range after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(begins - before, sizes) + np.arange(int(sizes.sum()))
