"""Exact top-k inner products by norm buckets (LEMP-style).

Vectors are grouped by length: a bucket's lengths lie within ``RATIO`` of each
other, and a bucket of many rows is cut into blocks.  Each query first gets a
lower bound t of its k-th best product from the ``SEEDS`` longest vectors.  A
vector shorter than t / |q| cannot be among the results, so queries are
grouped by that length too and meet only buckets that can reach it.

Where a block of queries meets a bucket, each query has the bucket's local
cosine threshold t / (|q| * longest).  Above 1 the bucket is skipped.  The
bucket chooses, from the local thresholds and candidate counts of some of its
queries, the threshold from which coordinate pruning is cheaper (ranges that
the cosine leaves to the query's largest coordinates, looked up in sorted
lists); below it the prefix of vectors that are long enough is scanned.  What
is left is verified by exact products.

Each side is copied to the blocks that it meets, by Spark's shuffle; a block
holds a bounded number of rows of either side whatever their lengths, ids or
values, so one vector that fills a third of the table fills many blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from . import vectors as V

K = 20
SCALE = 64
#: Lengths of a bucket differ at most by this ratio.
RATIO = 0.9
#: Longest vectors (a fixed number, broadcast) that give the queries their first thresholds.
SEEDS = 1024
#: Most rows of a bucket's block, and of a block of queries.
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 4_096
#: Fewest rows of a block where the table is small and tasks would have nothing to do.
LEAST_ROWS = 256
#: Coordinates that coordinate pruning looks at, and its price for a candidate against a row of a dense product.
FOCUS = 4
GATHER = 8.0
#: Queries by which a bucket chooses its threshold, and rows of queries multiplied at once.
TUNED = 16
TILE = 256


def length_class(length: Column) -> Column:
    """0 for length zero, else 1 + floor(log(length) / log(1 / RATIO)); whole vectors are at least 1 long."""
    return F.when(length >= 1.0, 1 + F.floor(F.log(length) / F.lit(math.log(1 / RATIO)))).otherwise(F.lit(0)).cast("int")


# ------------------------------------------------------------------- one bucket


class Bucket:
    """A block of vectors of near equal length, longest first, with sorted coordinate lists made when asked for."""

    def __init__(self, rows: np.ndarray, names: np.ndarray):
        length = V.lengths(rows)
        order = np.argsort(-length, kind="stable")
        self.rows, self.names, self.length = rows[order], names[order], length[order]
        self.unit = self.rows / np.maximum(self.length, 1e-300)[:, None]
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted values of coordinate ``f`` of the unit vectors, and the rows in that order."""
        if f not in self._lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self._lists[f] = self.unit[order, f], order
        return self._lists[f]

    def ranges(self, unit: np.ndarray, cosine: float) -> list[tuple[int, float, float, int, int]]:
        """Per focus coordinate: its number, the values that vectors within ``cosine`` may have, and their places."""
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        reach = math.acos(min(1.0, max(-1.0, cosine - V.SLACK)))
        out = []
        for f in focus.tolist():
            angle = math.acos(min(1.0, max(-1.0, unit[f])))
            low = math.cos(min(math.pi, angle + reach)) - V.SLACK
            high = math.cos(max(0.0, angle - reach)) + V.SLACK
            values = self.coordinate(f)[0]
            out.append((f, low, high, int(np.searchsorted(values, low)), int(np.searchsorted(values, high, "right"))))
        return sorted(out, key=lambda x: x[4] - x[3])

    def by_coordinates(self, unit: np.ndarray, cosine: float) -> np.ndarray:
        """Rows inside the feasible ranges of all focus coordinates."""
        (f, _, _, a, b), *rest = self.ranges(unit, cosine)
        found = self.coordinate(f)[1][a:b]
        for f, low, high, _, _ in rest:
            x = self.unit[found, f]
            found = found[(x >= low) & (x <= high)]
        return found

    def switch(self, units: np.ndarray, cosines: np.ndarray, prefix: np.ndarray) -> float:
        """The local threshold from which coordinate pruning is cheaper than the length prefix, from some queries."""
        tuned = np.argsort(cosines, kind="stable")
        tuned = tuned[np.linspace(0, len(tuned) - 1, min(TUNED, len(tuned))).astype(int)] if len(tuned) else tuned
        at = math.inf
        for i in tuned[::-1].tolist():
            if cosines[i] <= 0:
                break
            _, _, _, a, b = self.ranges(units[i], cosines[i])[0]
            if GATHER * (b - a) >= prefix[i]:
                break
            at = cosines[i]
        return at


def search_bucket(bucket: Bucket, queries: np.ndarray, least: np.ndarray, k: int,
                  counted: dict[str, int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query number, row of the bucket and product of each query's ``k`` best that reach ``least``.

    ``counted`` gets the queries answered by either way and the products verified.
    """
    queries, rows = V.same_width(queries, bucket.rows)
    if rows is not bucket.rows:
        bucket = Bucket(rows, bucket.names)
    kind = V.exact_type(queries, bucket.rows)
    q, p = queries.astype(kind), bucket.rows.astype(kind)
    length = V.lengths(queries)
    units = queries / np.maximum(length, 1e-300)[:, None]
    t = least.astype(np.float64)
    needed = np.where((t > 0) & (length > 0), t / np.maximum(length, 1e-300), -math.inf) * (1 - V.SLACK)
    needed[(t > 0) & (length == 0)] = math.inf
    longest = bucket.length[0] if len(p) else 0.0
    local = needed / longest if longest > 0 else np.where(needed > 0, math.inf, -math.inf)
    prefix = np.searchsorted(-bucket.length, -needed, "right")
    live = np.flatnonzero((local <= 1) & (prefix > 0))
    at = bucket.switch(units[live], local[live], prefix[live])
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i in live[local[live] >= at].tolist():
        rows = bucket.by_coordinates(units[i], local[i])
        scores = p[rows] @ q[i]
        _, c = V.best(scores[None, :], bucket.names[rows], least[i:i + 1], k)
        found.append((np.full(len(c), i), rows[c], scores[c].astype(np.int64)))
        if counted is not None:
            counted["coordinate"] = counted.get("coordinate", 0) + 1
            counted["verified"] = counted.get("verified", 0) + len(rows)
    scanned = live[local[live] < at]
    scanned = scanned[np.argsort(prefix[scanned], kind="stable")]
    for s in range(0, len(scanned), TILE):
        some = scanned[s:s + TILE]
        m = int(prefix[some].max())
        scores = q[some] @ p[:m].T
        r, c = V.best(scores, bucket.names[:m], least[some], k)
        found.append((some[r], c, scores[r, c].astype(np.int64)))
        if counted is not None:
            counted["length"] = counted.get("length", 0) + len(some)
            counted["verified"] = counted.get("verified", 0) + m * len(some)
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


# ---------------------------------------------------------------- Spark's part


def _thresholds(seeds: np.ndarray, k: int):
    """Adds each query's lower bound of its ``k``-th best product: the ``k``-th best among the seeds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, p = V.same_width(V.matrix(batch.column("vec")), seeds)
            least = np.full(len(q), V.LEAST)
            kind = V.exact_type(q, p)
            q, p = q.astype(kind), p.astype(kind)
            for s in range(0, len(q) if len(p) >= k else 0, TILE):
                scores = q[s:s + TILE] @ p.T
                least[s:s + TILE] = np.partition(scores, -k, axis=1)[:, -k].astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least)], names=[*batch.schema.names, "least"])

    return run


def _meet(k: int):
    """Products of one block of queries with one block of a bucket."""
    names = ["vec_id", "digest", "own", "candidate", "score"]

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        q = V.matrix(queries.column("vec"))
        bucket = Bucket(V.matrix(rows.column("vec")), V.ids(rows.column("vec_id")))
        i, c, score = search_bucket(bucket, q, queries.column("least").to_numpy(), k)
        own = np.einsum("ij,ij->i", q, q)
        return pa.Table.from_arrays([queries.column("vec_id").take(pa.array(i)), queries.column("digest").take(pa.array(i)),
                                     pa.array(own[i]), V.id_array(bucket.names[c]), pa.array(score)], names=names)

    return run


def blocks(rows: int, most: int, least: int, tasks: int) -> int:
    """Blocks of ``rows`` rows: of at most ``most`` rows, and as many as there are tasks while they hold ``least``."""
    return max(1, -(-rows // most), min(tasks, rows // least))


def _row_blocks(counts: dict[int, int], tasks: int, top: int) -> tuple[list[int], list[int]]:
    """Per class 0 to ``top``: the number of its first block and its blocks; the last entry of the first is their sum."""
    total = max(1, sum(counts.values()))
    first, splits = [0], []
    for c in range(top + 1):
        n = counts.get(c, 0)
        splits.append(blocks(n, BLOCK_ROWS, LEAST_ROWS, max(1, round(tasks * n / total))) if n else 0)
        first.append(first[-1] + splits[-1])
    return first, splits


def _query_blocks(counts: dict[int, int], top: int) -> tuple[list[int], list[int], list[int]]:
    """Per class of needed length: its first block, its blocks, and the blocks that classes up to it begin.

    Neighbouring classes share a block while they fill no block of their own,
    so that rows are not copied to many small ones.
    """
    first, splits, begun, group = [0] * (top + 1), [0] * (top + 1), [], []
    used = size = 0
    for c in range(top + 1):
        n = counts.get(c, 0)
        if n and group and size + n > BLOCK_QUERIES:
            used, size, group = used + splits[group[0]], 0, []
        if n:
            group.append(c)
            size += n
            for g in group:
                first[g], splits[g] = used, -(-size // BLOCK_QUERIES)
        begun.append(used + (splits[group[0]] if group else 0))
    return first, splits, begun


def _pick(values: list[int], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), at + 1)


def top_products(frame: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest inner products of each query with every other row.

    ``is_query`` is a condition on ``vec_id``.  Each component x counts as
    floor(scale * x); ties go to the smaller vec_id, a null one last.  Vectors
    that are null or hold a null, NaN or infinite component take no part; a
    shorter vector is filled with zeros.  Repeated rows are candidates each;
    a query that is repeated with the same vector is answered once, and only
    one copy of it counts as its own row.  Products beyond a long are not
    defined.  Further columns are ignored; an empty table gives no rows.
    """
    spark = frame.sparkSession
    rows = materialize(V.whole_vectors(frame, scale, id_col, vector_col), "vectors")
    keep = k + 1  # its own row is among a query's best, and goes last of all
    seeds = [r["vec"] for r in rows.orderBy(F.desc("norm"), F.xxhash64("vec_id")).limit(SEEDS).select("vec").collect()]
    width = max(map(len, seeds), default=0)
    sample = np.array([v + [0] * (width - len(v)) for v in seeds], np.int64).reshape(len(seeds), width)
    asked = rows.where(F.coalesce(is_query, F.lit(False))).withColumn("digest", F.xxhash64("vec"))
    asked = asked.dropDuplicates(["vec_id", "digest", "vec"])
    asked = asked.mapInArrow(_thresholds(sample, keep), "vec_id long, vec array<long>, norm double, digest long, least long")
    needed = F.when((F.col("least") > 0) & (F.col("norm") > 0), F.col("least") / F.col("norm") * (1 - V.SLACK)).otherwise(F.lit(0.0))
    asked = materialize(asked.withColumn("class", length_class(needed)), "queries")
    rows = rows.withColumn("class", length_class(F.col("norm")))
    n_rows, n_asked = ({r["class"]: r["count"] for r in x.groupBy("class").count().collect()} for x in (rows, asked))
    top = max([0, *n_rows, *n_asked])
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first_row, row_splits = _row_blocks(n_rows, tasks, top)
    first_asked, asked_splits, begun = _query_blocks(n_asked, top)
    here = F.monotonically_increasing_id()  # of a written table: the same in every attempt
    left = (asked.withColumn("q_block", (_pick(first_asked, F.col("class")) + here % _pick(asked_splits, F.col("class"))).cast("int"))
            .withColumn("from", _pick(first_row, F.col("class"))).where(F.col("from") < first_row[-1])
            .withColumn("p_block", F.explode(F.sequence("from", F.lit(first_row[-1] - 1))))
            .select("q_block", "p_block", "vec_id", "digest", "vec", "least"))
    right = (rows.withColumn("p_block", (_pick(first_row, F.col("class")) + here % _pick(row_splits, F.col("class"))).cast("int"))
             .withColumn("to", _pick(begun, F.col("class"))).where(F.col("to") > 0)
             .withColumn("q_block", F.explode(F.sequence(F.lit(0), F.col("to") - 1)))
             .select("q_block", "p_block", "vec_id", "vec"))
    hits = left.groupBy("q_block", "p_block").cogroup(right.groupBy("q_block", "p_block")).applyInArrow(
        _meet(keep), "vec_id long, digest long, own long, candidate long, score long")
    return _without_itself(hits, k)


def _without_itself(hits: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each query's best ``k + 1``, without one entry that is the query's own row."""
    query = W.partitionBy("vec_id", "digest")
    place = F.row_number().over(query.orderBy(F.desc("score"), F.col("candidate").asc_nulls_last()))
    own = (F.col("candidate") == F.col("vec_id")) & (F.col("score") == F.col("own"))
    kept = hits.withColumn("place", place).where(F.col("place") <= k + 1)
    kept = kept.withColumn("self", F.coalesce(F.min(F.when(own, F.col("place"))).over(query), F.lit(k + 1)))
    return (kept.where(F.col("place") != F.col("self"))
            .select(F.col("vec_id").alias("query_id"),
                    (F.col("place") - (F.col("place") > F.col("self")).cast("int")).cast("int").alias("rank"),
                    F.col("candidate").alias("vec_id"), "score"))
