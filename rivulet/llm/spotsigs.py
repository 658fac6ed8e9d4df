"""Document fingerprints by SpotSigs.

Words that are common in running text (the anchors) mark spots; each spot's
signature is its anchor and the chain of the next content words, taken every
``DISTANCE`` words among those that are not anchors.  Where more than ``GAP`` words
pass without an anchor (other languages, code, tables), words chosen by their
hash mark spots as well; the rule is local, so what is cut out or put in
elsewhere moves no spot.  A document's fingerprint is the set of its signatures.  Two sets are compared by Jaccard similarity,
pruned by what their lengths alone allow, and copies and near copies share
most spots whatever surrounds them.

``with_next`` compares each document with its successor in id order and with an
edited text made of both.  Rows are range partitioned and sorted by id, each
partition is streamed once, and only the first and last text of each partition
are carried over its edge.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import table_bytes

#: Frequent function words, the anchors of texts in these languages.
COMMON_WORDS = {
    "en": "the of and to in that is was for on with be by at from or".split(),
    "de": "der die und den von zu das mit sich des auf ist dem nicht ein eine".split(),
    "fr": "de la le et les des en un une du que est dans qui par au".split(),
    "es": "de la que el en y los del se las por un para con una su".split(),
}
ANCHORS = frozenset(w for words in COMMON_WORDS.values() for w in words)
CHAIN = 2
DISTANCE = 1
#: Words without an anchor from which on a word in SHARE (by its hash) marks a spot too.
GAP = 12
SHARE = 4
#: Bytes of text in one partition of the sorted table.
PARTITION_BYTES = 8 << 20
WORD = re.compile(r"\w+")
FIELDS = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def signatures(text: str, chain: int = CHAIN, distance: int = DISTANCE, anchors: frozenset[str] = ANCHORS) -> np.ndarray:
    """Sorted distinct 64-bit signatures.  A text without any has one, of all its words."""
    words = WORD.findall(text.lower())
    content, spots, since = [], [], 0
    hashed, reach = xxhash.xxh64_intdigest, chain * distance
    for w in words:
        if w in anchors:
            spots.append((w, len(content)))
            since = 0
        else:
            content.append(w)
            since += 1
            if since > GAP and hashed(w) % SHARE == 0:
                spots.append((w, len(content)))
    last = len(content) - reach + distance  # spots from here on have no whole chain
    found = {hashed(" ".join((w, *content[i:i + reach:distance]))) for w, i in spots if i < last}
    if not found:
        found = {hashed("\n".join(words) if words else text, 1)}
    return np.sort(np.fromiter(found, np.uint64, len(found)))


def likeness(a: np.ndarray, b: np.ndarray, floor: float = 0.0) -> float:
    """Jaccard similarity of two signature sets; 0 without a comparison where their lengths keep it below ``floor``."""
    if min(len(a), len(b)) < floor * max(len(a), len(b)):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def digest(found: np.ndarray) -> str:
    return xxhash.xxh3_128_hexdigest(found.astype("<u8").tobytes())


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _compare(text: str, own: np.ndarray, following: str, other: np.ndarray) -> tuple:
    new = edited(text, following)
    changed = signatures(new)
    return (len(text), hashlib.sha256(new.encode()).hexdigest(), digest(own), digest(changed),
            likeness(own, changed), likeness(own, other))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, the sorted ``signatures`` (as signed longs) and their ``fingerprint``; null text counts as empty."""
    frame = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = frame.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signatures(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f.view(np.int64) for f in found], pa.list_(pa.int64())),
                 pa.array([digest(f) for f in found], pa.string())], names=["doc_id", "signatures", "fingerprint"])

    return frame.mapInArrow(run, f"doc_id {kind}, signatures array<long>, fingerprint string")


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
              partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document.

    The next document is the one with the next smaller id; after the last
    comes the first.  Null text counts as empty; null ids come last; rows of
    one id follow each other in order of a hash of their text; a document
    alone follows itself; further columns are ignored; an empty table gives no rows.
    """
    frame = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    frame = frame.withColumn("mark", F.xxhash64("text"))
    kind = frame.schema["doc_id"].dataType.simpleString()
    order = [F.col("doc_id").desc_nulls_last(), F.col("mark")]
    n = max(1, table_bytes(docs, text) // partition_bytes)
    dealt = frame.repartitionByRange(n, *order).sortWithinPartitions(*order)
    names = ["doc_id", *(f.split()[0] for f in FIELDS.split(", ")), "first", "last", "part"]
    arrow = [pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, key_type = TaskContext.get().partitionId(), None, None

        def block(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [key_type, *arrow], strict=True)], names=names)

        for batch in batches:
            key_type, rows = batch.schema.field("doc_id").type, []
            for key, value in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                now = (key.as_py(), value.as_py())
                now += (signatures(now[1]),)
                if before is None:  # the text before this partition's first row is in another one
                    rows.append((None, *[None] * 6, now[1], None, part))
                else:
                    rows.append((before[0], *_compare(before[1], before[2], now[1], now[2]), None, None, part))
                before = now
            yield block(rows)
        if before is not None:
            yield block([(before[0], *[None] * 6, None, before[1], part)])

    done = materialize(dealt.mapInArrow(run, f"doc_id {kind}, {FIELDS}, first string, last string, part long"), "spots")
    whole = done.where(F.col("first").isNull() & F.col("last").isNull()).drop("first", "last", "part")
    firsts = done.where(F.col("first").isNotNull()).select("part", "first")
    parts = sorted(r["part"] for r in firsts.select("part").collect())  # one number for each partition
    if not parts:
        return whole
    following = docs.sparkSession.createDataFrame(list(zip(parts, [*parts[1:], parts[0]], strict=True)), "own long, part long")
    edges = (done.where(F.col("last").isNotNull()).select("doc_id", "last", F.col("part").alias("own"))
             .join(following, "own").join(firsts, "part").select("doc_id", "last", "first"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("last").to_pylist(), batch.column("first").to_pylist(), strict=True)
            rows = [_compare(a, signatures(a), b, signatures(b)) for a, b in pairs]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), arrow, strict=False))],
                    names=names[:7])

    return whole.unionByName(edges.mapInArrow(close, f"doc_id {kind}, {FIELDS}"))


def length_part(size: Column, threshold: float) -> Column:
    """Number of the length partition: similar sets lie in one partition or in neighbouring ones.

    Partition k holds the sizes from threshold ** -k up to below threshold ** -(k + 1).
    """
    return F.floor(F.log(size.cast("double")) / F.lit(-math.log(threshold)) + 1e-9).cast("int")


def similar_pairs(prints: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs ``a < b`` of different fingerprints whose sets have a Jaccard similarity of ``threshold`` or more.

    ``prints`` has columns ``fingerprint`` and ``signatures`` (as ``fingerprints``
    gives them); rows of equal fingerprints count once.  Sets are compared
    within their length partition and with the next one, and only those that share one of
    the first few signatures that any similar set must share.  Signatures are
    taken in order of how many sets hold them, so that a spot which very many
    share is not among the first ones of any larger set.  Lengths prune the
    candidates before their sets are joined.
    """
    sets = prints.select("fingerprint", "signatures").dropDuplicates(["fingerprint"])
    cells = sets.select("fingerprint", F.size("signatures").alias("n"), F.explode("signatures").alias("s"))
    held = cells.groupBy("s").agg(F.count(F.lit(1)).alias("held")).where("held > 1")  # a spot of one set finds nothing
    rare = (cells.join(held, "s", "left").groupBy("fingerprint", "n")
            .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("held", F.lit(1)).alias("held"), "s"))).alias("s")))
    first = F.col("n") - F.ceil(F.col("n") * F.lit(threshold) - 1e-9).cast("int") + 1
    keys = rare.select("fingerprint", "n", length_part(F.col("n"), threshold).alias("part"),
                       F.explode(F.slice("s", F.lit(1), first)).alias("x")).where("x.held > 1")
    small = keys.select(F.col("fingerprint").alias("f"), F.col("n").alias("nf"), F.col("x.s").alias("s"),
                        F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    large = keys.select(F.col("fingerprint").alias("g"), F.col("n").alias("ng"), F.col("x.s").alias("s"), "part")
    found = (small.join(large, ["part", "s"])
             .where(((F.col("nf") < F.col("ng")) | ((F.col("nf") == F.col("ng")) & (F.col("f") < F.col("g"))))
                    & (F.col("nf") >= F.col("ng") * F.lit(threshold) - 1e-9)).select("f", "g").distinct())
    left, right = (sets.select(F.col("fingerprint").alias(k), F.col("signatures").alias(f"s{k}")) for k in "fg")
    both = F.size(F.array_intersect("sf", "sg"))
    alike = both / (F.size("sf") + F.size("sg") - both)
    return (found.join(left, "f").join(right, "g").withColumn("likeness", alike)
            .where(F.col("likeness") >= F.lit(threshold) - 1e-9)
            .select(F.least("f", "g").alias("a"), F.greatest("f", "g").alias("b"), "likeness"))
