"""Byte-wise removal of repeated strings by suffix arrays, sorted in two stages.

A shard's distinct segments stand in one array.  Of the suffixes that start a
window (and those that follow until their type is known), only those smaller
than their successor are sorted directly.  The others are induced: bucket by
bucket of the first byte, each suffix met in order puts its larger predecessor
at the next free place of that predecessor's bucket.  Common prefixes of
neighbours in the finished array then give the groups of equal windows; all but
the first window of each group are repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import chunks, text_bytes
from .repeats import HOT, SHARD_BYTES, covered, with_repeats
from .windows import Unit, spread

WINDOW = 100
#: Bytes of the grams that anchor a window.
GRAM = 32


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """For each position whether its suffix is smaller than the next one's (the last one's is not)."""
    n = len(text)
    differs = np.flatnonzero(text[1:] != text[:-1])  # the first place from each position on where neighbours differ decides
    out = np.zeros(n, bool)
    at = np.searchsorted(differs, np.arange(n))
    known = at < len(differs)
    place = differs[at[known]]
    out[known] = text[place] < text[place + 1]
    return out


def two_stage(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted suffixes in order of their first ``depth`` bytes at least, and maybe others between them.

    ``text`` holds values 1 to 256 and closes each segment by 0; a wanted suffix
    has ``depth`` symbols before that.
    """
    n = len(text)
    if not len(wanted):
        return np.zeros(0, np.int64)
    small = smaller_than_next(text)
    small[text == 0] = True  # ends of segments are sorted directly
    # a larger suffix is induced by its successor, so all up to the next smaller one are needed
    need = np.zeros(n, bool)
    need[wanted] = True
    last = np.where(small, np.arange(n), n)
    following = np.minimum.accumulate(last[::-1])[::-1]
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, wanted, 1)
    np.subtract.at(steps, np.minimum(following[wanted], n - 1) + 1, 1)
    need = np.cumsum(steps[:-1]) > 0
    raw = np.clip(text - 1, 0, 255).astype(np.uint8).tobytes()
    closing = np.flatnonzero(text == 0)
    place = np.flatnonzero(need & small)
    limit = np.minimum(place + depth + 1, np.append(closing, n)[np.searchsorted(closing, place)])
    first = text[place]
    direct: dict[int, np.ndarray] = {}
    order = np.argsort(first, kind="stable")
    values, at = np.unique(first[order], return_index=True)
    for value, a, b in zip(values.tolist(), at, [*at[1:], len(order)], strict=True):
        mine = order[a:b]
        starts, ends = place[mine].tolist(), limit[mine].tolist()
        slices = [raw[s:e] for s, e in zip(starts, ends, strict=True)]
        direct[value] = place[mine[sorted(range(len(mine)), key=slices.__getitem__)]]
    induced: dict[int, list[np.ndarray]] = {}
    out = []
    for value in range(int(text.max(initial=0)) + 1):
        # a bucket holds its induced (larger) suffixes first, then its directly sorted ones
        now = np.concatenate(induced.pop(value, [np.zeros(0, np.int64)]))
        while len(now) or value in direct:
            if not len(now):
                now = direct.pop(value)
            out.append(now)
            before = now[now > 0] - 1
            before = before[need[before] & ~small[before]]
            letters = text[before]
            now = before[letters == value]  # runs of one byte come back into the same bucket, behind the rest
            by = np.argsort(letters, kind="stable")
            found, cut = np.unique(letters[by], return_index=True)
            for letter, part in zip(found.tolist(), np.split(before[by], cut[1:]), strict=False):
                if letter != value:
                    induced.setdefault(letter, []).append(part)
    return np.concatenate(out)


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Bytes, up to ``depth``, that each of the given suffixes has in common with the one before it (0 for the first).

    ``data`` holds bytes; each suffix has ``depth`` of them at least.
    """
    padded = np.concatenate([data, np.zeros(16, np.uint8)]).astype(np.uint64)
    eight = np.zeros(len(data) + 1, np.uint64)
    for k in range(8):
        eight |= padded[k:k + len(eight)] << np.uint64(8 * k)
    out = np.zeros(len(order), np.int64)
    alive = np.arange(1, len(order))
    for step in range(0, depth, 8):
        differs = eight[order[alive] + step] ^ eight[order[alive - 1] + step]
        lowest = differs & (~differs + np.uint64(1))
        out[alive] = np.minimum(step + np.where(differs == 0, 8, np.bitwise_count(lowest - np.uint64(1)) >> 3), depth)
        alive = alive[differs == 0]
        if not len(alive):
            break
    return out


def search_shard(group: pd.DataFrame, unit: Unit) -> np.ndarray:
    """Which windows of the shard's segments also start earlier: at a smaller (id, row), or further left in the same."""
    number: dict[bytes, int] = {}
    entry = np.array([number.setdefault(c, len(number)) for c in group["content"]], np.int64)
    row, start, count = (group[c].to_numpy().astype(np.int64) for c in ("row", "start", "count"))
    ids = dict(zip(group["row"], group["doc_id"], strict=True))
    rank = {r: i for i, (_, _, r) in enumerate(sorted((not pd.isna(d), None if pd.isna(d) else d, r) for r, d in ids.items()))}
    key = (np.array([rank[r] for r in group["row"]], np.int64) << 32) + start
    order = np.lexsort((key, entry))
    is_first = np.r_[True, entry[order][1:] != entry[order][:-1]]
    firsts = np.empty(len(number), np.int64)  # the group's row at which each entry is first met
    firsts[entry[order[is_first]]] = order[is_first]
    sizes = np.fromiter(map(len, number), np.int64, len(number))
    begins = np.cumsum(sizes + 1) - sizes - 1
    inside = spread(begins, sizes)
    data = np.zeros(int(sizes.sum()) + len(number), np.uint8)
    data[inside] = np.frombuffer(b"".join(number), np.uint8)
    text = np.zeros(len(data), np.int16)
    text[inside] = data[inside].astype(np.int16) + 1
    windows = count[firsts]
    place = spread(begins, windows)
    wanted = np.zeros(len(text), bool)
    wanted[place] = True
    suffixes = two_stage(text, place, unit.window)
    suffixes = suffixes[wanted[suffixes]]
    equal = common_prefixes(data, suffixes, unit.window) >= unit.window
    at = np.zeros(len(text), np.int64)
    at[place] = spread(key[firsts], windows)
    at = at[suffixes]
    begin = np.flatnonzero(~equal)
    least = np.repeat(np.minimum.reduceat(at, begin), np.diff(np.r_[begin, len(at)]))
    late = np.zeros(len(text), bool)
    late[suffixes] = at > least
    found = late[spread(begins[entry], count)]
    found |= np.repeat(firsts[entry] != np.arange(len(group)), count)
    return found


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM,
                   shard_bytes: int = SHARD_BYTES, hot: int = HOT) -> DataFrame:
    """``row, doc_id, n_bytes, n_removed, n_spans, kept`` (binary) for every row of ``docs``.

    A byte is removed if a string of ``window`` bytes around it also starts
    earlier: in a row with a smaller id (null ids before all; rows of one id in
    the order of the table), or further left in the same row.  Null text counts as
    empty; a whole text repeated is removed but for its first row if it has
    ``window`` bytes; an empty table gives no rows; further columns are ignored.
    """
    unit = Unit(False, window, gram)
    found = with_repeats(docs, unit, search_shard, True, doc_id, text, shard_bytes, hot)
    kind = found.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ranges, original = batch.column("text"), batch.column("ranges"), batch.column("original").to_pylist()
            for a, b in chunks(pc.binary_length(texts).to_pylist()):
                n_bytes, n_removed, n_spans, kept = [], [], [], []
                for i, t in enumerate(text_bytes(texts.slice(a, b - a)), start=a):
                    gone = np.ones(len(t), bool) if not original[i] and len(t) >= window else covered(ranges[i].as_py(), len(t))
                    n_bytes.append(len(t))
                    n_removed.append(int(gone.sum()))
                    n_spans.append(int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(t) else 0)
                    kept.append(np.frombuffer(t, np.uint8)[~gone].tobytes() if n_removed[-1] else t)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(a, b - a), batch.column("doc_id").slice(a, b - a),
                     *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(kept, pa.binary())],
                    names=["row", "doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return found.select("row", "doc_id", "text", "original", "ranges").mapInArrow(
        run, f"row long, doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
