"""Repeated windows of a whole table: what both substring operators share.

1. Copies of a whole text collapse to their first row before anything else.
2. Every text is cut into segments (see ``windows``); anchors met at least
   twice are found by a count with map-side combining, and joined back to the
   places where they occur (a sort-merge join, split by AQE where skewed).
3. The segments at those places travel with their content to a shard chosen by
   their anchor, so equal windows meet in one shard.  The operator's own index
   is built there; shards are sized by the table, and one anchor brings at most
   ``HOT`` segments to its shard.
4. The segments of anchors beyond that are cut into single windows, which are
   counted by content with map-side combining, and joined back.
5. The ranges found repeated are joined to the texts.

Rows are told apart by their place in the table, so repeated rows and ids are
documents of their own.  The texts are shuffled once, by that number, and all
joins with them read the same exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, table_bytes, text_bytes
from .windows import BLOCK, Unit, gram_hashes, mixed, range_hashes, segments, spread

#: Segments of one anchor that may meet in one shard.
HOT = 100_000
#: Bytes of text for each shard of segments.
SHARD_BYTES = 2 << 20
#: Bytes of text cut at once in a task: texts together in one block, whose arrays stay in a core's cache.
CUT_BYTES = BLOCK

#: From the rows of a shard to a flag for each window of each row, row after row.
Shard = Callable[[pd.DataFrame, Unit], np.ndarray]


class _Cut:
    """Segments of some texts in arrays, and which repeat an earlier one of their text."""

    def __init__(self, texts: list[bytes], unit: Unit):
        self.texts, self.unit = texts, unit
        each = [unit.codes(t) for t in texts]
        self.sizes = np.array([len(c) for c in each], np.int64)
        self.codes = np.concatenate(each) if each else np.zeros(0, np.uint64)
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.text, self.start, self.count, self.anchor = segments(self.codes, self.sizes, unit)
        content = range_hashes(self.codes, self.offsets[self.text] + self.start, self.count + unit.window - 1)
        key = mixed(mixed(content ^ self.anchor) + self.text.astype(np.uint64))
        order = np.argsort(key, kind="stable")
        same = np.r_[False, key[order][1:] == key[order][:-1]] if len(key) else np.zeros(0, bool)
        group = np.cumsum(~same) - 1
        begins = np.flatnonzero(~same)
        self.nth, self.times = np.empty(len(key), np.int64), np.empty(len(key), np.int64)
        self.nth[order] = np.arange(len(key)) - begins[group]
        self.times[order] = np.diff(np.r_[begins, len(key)])[group]

    def content(self, i: int, words: list[list[bytes]] | None) -> bytes:
        a, n = int(self.start[i]), int(self.count[i]) + self.unit.window - 1
        t = int(self.text[i])
        return b" ".join(words[t][a:a + n]) if self.unit.words else self.texts[t][a:a + n]


def _cuts(batch: pa.RecordBatch, unit: Unit) -> Iterator[tuple[int, _Cut]]:
    texts = batch.column("text")
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for a, b in chunks(sizes, CUT_BYTES):
        yield a, _Cut([t or b"" for t in text_bytes(texts.slice(a, b - a))], unit)


def _places(unit: Unit):
    """Each text's anchors with their starts; a segment that repeats in its text is given twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row").to_numpy()
            for a, cut in _cuts(batch, unit):
                some = cut.nth < 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cut.anchor[some].view(np.int64)), pa.array(row[a + cut.text[some]]),
                     pa.array(cut.start[some].astype(np.int32))], names=["anchor", "row", "start"])

    return run


def _chosen(batch: pa.RecordBatch, a: int, cut: _Cut) -> np.ndarray:
    """Numbers of the segments whose starts are listed for their text."""
    lists = batch.column("starts").slice(a, len(cut.texts))
    wanted = np.sort((np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy()) << 32)
                     | lists.flatten().to_numpy())
    mine = (cut.text << 32) | cut.start
    at = np.minimum(np.searchsorted(wanted, mine), max(len(wanted) - 1, 0))
    return np.flatnonzero(wanted[at] == mine) if len(wanted) else np.zeros(0, np.int64)


SEGMENT = "shard long, anchor long, row long, doc_id {kind}, start int, count int, weight int, content binary"


def _contents(unit: Unit, shards: int):
    """Segments at the listed places, with content; those that repeat in their text come without any, as found."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, copies = batch.column("row").to_numpy(), pc.fill_null(batch.column("copies"), 1).to_numpy(zero_copy_only=False)
            for a, cut in _cuts(batch, unit):
                listed = _chosen(batch, a, cut)
                listed = listed[cut.nth[listed] == 0]
                repeats = np.flatnonzero(cut.nth > 0)
                words = [t.split() for t in cut.texts] if unit.words else None
                content = [cut.content(i, words) for i in listed.tolist()] + [None] * len(repeats)
                i = np.r_[listed, repeats]
                at = a + cut.text[i]
                route = mixed(np.where(np.arange(len(i)) < len(listed), cut.anchor[i], row[at].view(np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((route % np.uint64(shards)).astype(np.int64)), pa.array(cut.anchor[i].view(np.int64)),
                     pa.array(row[at]), batch.column("doc_id").take(pa.array(at)), pa.array(cut.start[i].astype(np.int32)),
                     pa.array(cut.count[i].astype(np.int32)),
                     pa.array(np.minimum(cut.times[i] * copies[at], 2).astype(np.int32)), pa.array(content, pa.binary())],
                    names=[f.split()[0] for f in SEGMENT.split(", ")])

    return run


def _single(unit: Unit):
    """The windows of all segments that have an anchor at a listed place: anchor, hash, row, doc_id, start, weight."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, copies = batch.column("row").to_numpy(), pc.fill_null(batch.column("copies"), 1).to_numpy(zero_copy_only=False)
            for a, cut in _cuts(batch, unit):
                listed = _chosen(batch, a, cut)
                i = np.flatnonzero(np.isin(cut.anchor, cut.anchor[listed]))
                if not len(i):
                    continue
                whole = gram_hashes(cut.codes, unit.window)
                start, i = spread(cut.start[i], cut.count[i]), np.repeat(i, cut.count[i])
                at = a + cut.text[i]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cut.anchor[i].view(np.int64)), pa.array(whole[cut.offsets[cut.text[i]] + start].view(np.int64)),
                     pa.array(row[at]), batch.column("doc_id").take(pa.array(at)), pa.array(start.astype(np.int32)),
                     pa.array(np.minimum(copies[at], 2).astype(np.int32))],
                    names=["anchor", "hash", "row", "doc_id", "start", "weight"])

    return run


def _searched(shard: Shard, unit: Unit):
    """Ranges of the windows that a shard's search finds, and of the segments that were found before."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        given = group["content"].isna().to_numpy()
        whole, rest = group[given], group[~given]
        rows, starts = [whole["row"].to_numpy()], [whole["start"].to_numpy()]
        ends = [starts[0] + whole["count"].to_numpy() + unit.window - 1]
        if len(rest):
            count, start, row = (rest[c].to_numpy().astype(np.int64) for c in ("count", "start", "row"))
            found = shard(rest, unit)
            owner = np.repeat(np.arange(len(rest)), count)
            at = spread(start, count)
            edge = np.r_[True, owner[1:] != owner[:-1]]
            first = found & (edge | np.r_[True, ~found[:-1]])  # neighbouring windows make one range
            last = found & np.r_[edge[1:] | ~found[1:], True]
            rows.append(row[owner[first]])
            starts.append(at[first])
            ends.append(at[last] + unit.window)
        return pd.DataFrame({"row": np.concatenate(rows).astype(np.int64), "a": np.concatenate(starts).astype(np.int32),
                             "b": np.concatenate(ends).astype(np.int32)})

    return run


def with_repeats(docs: DataFrame, unit: Unit, shard: Shard, keep_first: bool, doc_id: str = "doc_id", text: str = "text",
                 shard_bytes: int = SHARD_BYTES, hot: int = HOT, carry: Sequence[str] = ()) -> DataFrame:
    """``row, doc_id, text, copies, original, ranges``: every row with its ranges of units that lie in repeated windows.

    The columns ``carry`` of ``docs`` come along as one struct, ``carried``.

    With ``keep_first`` windows count as repeated from their second occurrence
    on (in order of id, row, start), else all of them do.  ``copies`` is the number of
    rows with exactly this text where there are several; ranges are given for
    the first of them (``original``), the others are repeated as a whole.
    """
    shards = max(1, table_bytes(docs, text) // shard_bytes)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"), *[F.struct(*carry).alias("carried")] * bool(carry))
    kind = rows.schema["doc_id"].dataType.simpleString()
    same = ["m1", "m2", "m3"]
    marks = rows.select("row", "doc_id", F.xxhash64("text").alias("m1"), F.crc32(F.col("text").cast("binary")).alias("m2"),
                        F.octet_length("text").alias("m3"))
    groups = (marks.groupBy(*same).agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "row")).alias("first"))
              .where("copies > 1"))
    copied = marks.select("row", *same).join(groups, same).select(
        "row", F.col("copies").cast("int").alias("copies"), (F.col("row") == F.col("first.row")).alias("original"))
    known = rows.join(copied.hint("shuffle_hash"), "row", "left").withColumn("original", F.coalesce("original", F.lit(True)))
    cut = known.where("original")

    # all readers of the texts take the same columns, so that one exchange serves them
    places = cut.select(*rows.columns).mapInArrow(_places(unit), "anchor long, row long, start int")
    counts = places.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")

    def listed(anchors: DataFrame) -> DataFrame:
        found = places.join(anchors.select("anchor"), "anchor").groupBy("row").agg(F.collect_list("start").alias("starts"))
        return cut.join(found.hint("shuffle_hash"), "row").select(*rows.columns, "copies", "starts")

    sent = listed(counts.where(F.col("n") <= hot)).mapInArrow(_contents(unit, shards), SEGMENT.format(kind=kind))
    ranges = sent.groupBy("shard").applyInPandas(_searched(shard, unit), "row long, a int, b int")

    single = listed(counts.where(F.col("n") > hot)).mapInArrow(
        _single(unit), f"anchor long, hash long, row long, doc_id {kind}, start int, weight int")
    met = single.groupBy("anchor", "hash").agg(F.sum("weight").alias("n"), F.min(F.struct("doc_id", "row", "start")).alias("first"))
    again = single.join(met, ["anchor", "hash"])
    if keep_first:
        again = again.where((F.col("row") != F.col("first.row")) | (F.col("start") != F.col("first.start")))
    else:
        again = again.where("n > 1")
    ranges = ranges.union(again.select("row", F.col("start").alias("a"), (F.col("start") + unit.window).cast("int").alias("b")))
    found = ranges.groupBy("row").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
    return known.join(found.hint("shuffle_hash"), "row", "left")


def covered(ranges: list[dict] | None, size: int) -> np.ndarray:
    """Which of ``size`` units lie in one of the ranges."""
    steps = np.zeros(size + 1, np.int64)
    for r in ranges or ():
        steps[r["a"]] += 1
        steps[r["b"]] -= 1
    return np.cumsum(steps[:-1]) > 0
