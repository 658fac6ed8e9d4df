"""SimHash near-duplicates by anchor-point covering.

Fingerprints that differ in at most ``max_bits`` bits are linked.  The anchors
are the codewords of a covering code: the binary Golay code on bits 0-22 and
again on bits 23-45, each with covering radius 3, so every fingerprint has one
home anchor within 3 bits in each block.  If u and v differ in i bits of the
first block and j of the second, v lies within 3 + i and 3 + j bits of u's home
anchor; so each distinct fingerprint is replicated to every anchor pair within
3 + i and 3 + j for all i + j <= ``max_bits``, and homes are compared with
replicas anchor by anchor.  No link can be missed, and all 64 bits decide.

Equal fingerprints collapse to one row before anything is replicated.  Links
join the home row of an anchor with its replicas (a sort-merge join, so AQE
splits an anchor that many fingerprints share), and the components come from
alternating star contractions whose rounds are checkpointed.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import chunks, text_bytes

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Fingerprints that one task replicates.
TASK_FINGERPRINTS = 1 << 14
#: Generator polynomial of the binary Golay code of length 23 (fixed value).
GOLAY = 0b101011100011
BLOCK = 23


def fingerprint(text: bytes, n: int = SHINGLE_WORDS) -> int:
    """SimHash of a text's word n-grams (A-Z lower-cased, repeats counted)."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1].tolist()
    ends = ends.tolist()
    m = max(1, len(words) - n + 1)
    hashed = xxhash.xxh64_intdigest
    h = np.array([hashed(line[a:b], SEED) for a, b in zip(starts[:m], ends[-m:], strict=True)], "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, m, 1 << 16):
        ones += np.unpackbits(h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > m, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long), one row per row of ``docs``."""
    frame = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"))
    kind = frame.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("__text")
            fps: list[int] = []
            for a, b in chunks(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
                fps += [fingerprint(t or b"", n) for t in text_bytes(texts.slice(a, b - a))]
            signed = np.array(fps, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(signed)], names=["doc_id", "fp"])

    return frame.mapInArrow(run, f"doc_id {kind}, fp long")


def _remainder(words: np.ndarray) -> np.ndarray:
    """Of the division by the generator, the syndrome: zero for codewords."""
    words = words.copy()
    for bit in range(BLOCK - 1, 10, -1):
        words ^= np.where(words >> bit & 1, GOLAY << (bit - 11), 0)
    return words


@functools.lru_cache(1)
def _offsets() -> tuple[np.ndarray, list[list[np.ndarray]]]:
    """The bit patterns that lead from a block to an anchor: ``[syndrome][d]`` holds those of weight up to 3 + d."""
    patterns = [np.array([sum(1 << b for b in c) for c in combinations(range(BLOCK), w)], np.int64) for w in range(6)]
    by_weight = []
    for p in patterns:
        s = _remainder(p)
        order = np.argsort(s, kind="stable")
        bounds = np.searchsorted(s[order], np.arange(2049))
        by_weight.append(np.split(p[order], bounds[1:-1]))
    return [[np.concatenate([by_weight[w][s] for w in range(4 + d)]) for d in range(3)] for s in range(2048)]


def home_anchors(fps: np.ndarray) -> np.ndarray:
    """The anchor (two 23-bit codewords in one integer) within 3 bits of each fingerprint in both blocks."""
    out = np.zeros(len(fps), np.int64)
    leaders = np.array([s[0][0] for s in _offsets()])
    for shift in (0, BLOCK):
        block = (fps >> np.uint64(shift) & np.uint64((1 << BLOCK) - 1)).astype(np.int64)
        out |= (block ^ leaders[_remainder(block)]) << shift
    return out


def near_anchors(fp: int, syndromes: tuple[int, int], max_bits: int = MAX_BITS) -> np.ndarray:
    """All anchors that a fingerprint is replicated to."""
    near = [[(fp >> shift & (1 << BLOCK) - 1) ^ p for p in _offsets()[s]] for shift, s in zip((0, BLOCK), syndromes, strict=True)]
    out, seen = [], 0
    for i in range(max_bits + 1):
        new = near[0][i][seen:]  # the lists are nested: those at this distance class only
        seen = len(near[0][i])
        out.append((new[:, None] | near[1][max_bits - i][None, :] << BLOCK).ravel())
    return np.concatenate(out)


def _homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column("fp")
        yield pa.RecordBatch.from_arrays([pa.array(home_anchors(fps.to_numpy().view(np.uint64))), fps], names=["anchor", "u"])


def _replicas(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy()
            for i in range(0, len(values), 4096):
                part = values[i:i + 4096].view(np.uint64)
                syndromes = [_remainder((part >> np.uint64(s) & np.uint64((1 << BLOCK) - 1)).astype(np.int64)).tolist()
                             for s in (0, BLOCK)]
                found = [near_anchors(fp, s, max_bits) for fp, s in
                         zip(part.tolist(), zip(*syndromes, strict=True), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found)), pa.array(np.repeat(values[i:i + 4096], [len(f) for f in found]))],
                    names=["anchor", "v"])

    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``a > b`` of fingerprints that differ in at most ``max_bits`` (0 to 2) bits.

    ``fps`` has a column fp (long) without repeats.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the code's tables serve 0 to 2 differing bits")
    one = fps.select("fp").repartition(max(1, fps.count() // TASK_FINGERPRINTS), "fp")
    home = one.mapInArrow(_homes, "anchor long, u long")
    near = one.mapInArrow(_replicas(max_bits), "anchor long, v long")
    return (near.join(home, "anchor")
            .where((F.col("u") != F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits))
            .select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")))


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a partition reduced to one per node: towards the least node joined with it."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.setdefault(top, top)) != top:
            top = up
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    pairs = [(x, find(x)) for x in root if root[x] != x]
    if pairs:
        a, b = zip(*pairs, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def components(pairs: DataFrame) -> DataFrame:
    """``node, root`` of every node in a link ``a > b``: root is the least node reachable.

    Each partition first reduces its links to a forest; then large-star and
    small-star rounds (minimum per node, joined back) run until the links no
    longer change.  Every round is written to the shared checkpoint folder.
    """
    edges = materialize(pairs.mapInArrow(_forest, "a long, b long").distinct(), "links")
    mark = None
    while True:
        sign = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sign == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = sign
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.where("b < a").join(least, "a")
        edges = materialize(small.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                            .union(small.select("a", F.col("m").alias("b"))).distinct(), "links")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    max_bits: int = MAX_BITS, n: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``.

    The component is named by the least doc_id in it.  Null or empty text has
    fingerprint zero and is linked like any other; a null id takes part but
    names no component unless all its members' ids are null; repeated rows
    stay repeated; further columns are ignored; an empty table gives no rows.
    """
    marked = materialize(fingerprints(docs, doc_id, text, n), "fingerprints")
    known = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-ids")
    roots = components(links(known, max_bits))
    named = (known.join(roots, known["fp"] == roots["node"], "left")
             .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = named.join(names, "root").select("fp", "component_id")
    return marked.join(by_fp, "fp").select("doc_id", "fp", "component_id")
