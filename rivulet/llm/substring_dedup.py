"""Substring removal by FM-indexes: every word of a window that occurs again.

Each shard builds a compressed FM-index of its distinct segments and streams
them through it: backward search gives, for each window's end, the length of the
longest match that occurs at least twice (the matching statistics), and the
windows that match in full are reported as ranges.  Copies of a segment are one
entry with a weight; a segment of weight two needs no search.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import chunks, text_bytes
from .fm_index import FMIndex
from .repeats import HOT, SHARD_BYTES, covered, with_repeats
from .windows import Unit, spread

WINDOW = 35
#: Words of the grams that anchor a window.
GRAM = 12
#: Window ends searched at once.
SEARCH = 1 << 18


def search_shard(group: pd.DataFrame, unit: Unit) -> np.ndarray:
    """Which windows of the shard's segments occur at least twice among them."""
    number: dict[bytes, int] = {}
    entry = np.array([number.setdefault(c, len(number)) for c in group["content"]], np.int64)
    weight = np.bincount(entry, weights=group["weight"].to_numpy()).astype(np.int64)
    symbols: dict[bytes, int] = {}
    sizes = np.empty(len(number), np.int64)  # words of each distinct segment
    sizes[entry] = group["count"].to_numpy() + unit.window - 1
    begins = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(int(sizes.sum()) + len(number), np.int32)
    words = (symbols.setdefault(w, len(symbols) + 1) for content in number for w in content.split())
    text[spread(begins, sizes)] = np.fromiter(words, np.int32, int(sizes.sum()))
    windows = sizes - unit.window + 1
    found = np.repeat(weight > 1, windows)
    todo = np.flatnonzero(~found)
    if len(todo):
        index = FMIndex(text, unit.window)
        ends = spread(begins, windows)[todo] + unit.window
        for i in range(0, len(todo), SEARCH):
            found[todo[i:i + SEARCH]] = index.matching(text, ends[i:i + SEARCH], unit.window) >= unit.window
    first = np.cumsum(windows) - windows
    return found[spread(first[entry], windows[entry])]


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM,
                   shard_bytes: int = SHARD_BYTES, hot: int = HOT, carry: Sequence[str] = (), verbatim: bool = False) -> DataFrame:
    """``row, doc_id, n_words, n_removed, kept`` for every row of ``docs``.

    The columns ``carry`` come along as one struct, ``carried``.  With
    ``verbatim``, a text that loses nothing is kept as it stands.

    ``row`` is the row's number (as ``monotonically_increasing_id`` gives it),
    ``kept`` the words that are not removed, joined by one space.  Words are
    what white space separates.  A text that another row repeats whole counts
    as occurring again; null and empty text has no words; null ids are
    allowed, ids are not used; an empty table gives no rows; further columns are ignored.
    """
    unit = Unit(True, window, gram)
    found = with_repeats(docs, unit, search_shard, False, doc_id, text, shard_bytes, hot, carry)
    passed = [c for c in ("row", "doc_id", "carried") if c in found.columns]
    schema = ", ".join(f"{c} {found.schema[c].dataType.simpleString()}" for c in passed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ranges, copies = batch.column("text"), batch.column("ranges"), batch.column("copies").to_pylist()
            for a, b in chunks(pc.binary_length(texts).to_pylist()):
                n_words, n_removed, kept = [], [], []
                for i, t in enumerate(text_bytes(texts.slice(a, b - a)), start=a):
                    words = t.split()
                    if (copies[i] or 1) > 1 and len(words) >= window:
                        gone = np.ones(len(words), bool)
                    else:
                        gone = covered(ranges[i].as_py(), len(words))
                    n_words.append(len(words))
                    n_removed.append(int(gone.sum()))
                    kept.append(t if verbatim and not n_removed[-1]
                                else b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(a, b - a) for c in passed), pa.array(n_words, pa.int64()),
                     pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=[*passed, "n_words", "n_removed", "kept"])

    return found.select(*passed, "text", "copies", "ranges").mapInArrow(
        run, f"{schema}, n_words long, n_removed long, kept string")
