"""Hard negatives from anchor-clustered shared lists (MAXIMUS-style).

Anchors are clustered by angle; for each cluster every candidate has one upper
bound that holds for all members: its length times the cosine of its angle to
the centre less the cluster's widest angle.  The candidates are sorted by that
bound once, every member walks the list, and a member stops as soon as the
bound times its length is below the score that it still needs: what follows
cannot change its result.

The walk runs twice.  The first finds each anchor's best rows of the same label
(its positives).  They fix the windows of scores in which negatives may lie,
and the second finds the best rows of other labels in each window.  Before
either walk an anchor gets the score it needs from ``SEEDS`` rows, so that a
cluster's list holds only candidates that some member can use.

A list is cut into blocks of bounded size, dealt without regard to ids, labels
or values, and a cluster's members into blocks too; each block of a list is
sorted and walked on its own, and the blocks' winners are merged.
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

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: A negative's score lies between these hundredths of its positive's score.
LOW, HIGH = 50, 95
#: Rows (a fixed number, broadcast) that give anchors the first scores that they need.
SEEDS = 1024
#: Anchors that the clusters' centres are fitted on, most clusters, and anchors of that sample for each.
SAMPLE = 4096
CLUSTERS = 64
SAMPLE_OF_CLUSTER = 64
ROUNDS = 10
#: Most members and candidates of a block; fewest candidates where the table is small.
BLOCK_MEMBERS = 1024
BLOCK_ROWS = 16_384
LEAST_ROWS = 256
#: Candidates that all members of a block take from the list before they look at the next bound.
STRIDE = 2048


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(V.lengths(rows), 1e-300)[:, None]


def centres(sample: np.ndarray, most: int = CLUSTERS) -> np.ndarray:
    """Unit centres of the sample's vectors by spherical k-means; at least one row, whatever the sample."""
    unit = _unit(sample[V.lengths(sample) > 0])
    n = max(1, min(most, len(unit) // SAMPLE_OF_CLUSTER))
    if not len(unit):
        return np.eye(1, max(1, sample.shape[1]))
    at = unit[np.linspace(0, len(unit) - 1, n).astype(int)]
    for _ in range(ROUNDS):
        own = (unit @ at.T).argmax(axis=1)
        total = np.zeros_like(at)
        np.add.at(total, own, unit)
        size = V.lengths(total)
        at = np.where(size[:, None] > 1e-9, total / np.maximum(size, 1e-9)[:, None], at)
    return at


def angles(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Angle of each row to each centre; a row of zeros has angle zero (its products are zero anyhow)."""
    rows, at = V.same_width(rows, at)
    cosine = np.clip(_unit(rows) @ at.T, -1.0, 1.0)
    return np.where(V.lengths(rows)[:, None] > 0, np.arccos(cosine), 0.0)


def bounds(rows: np.ndarray, at: np.ndarray, widest: np.ndarray) -> np.ndarray:
    """Per row and cluster, what a product with a member of length one can be at most (with slack)."""
    length = V.lengths(rows)[:, None]
    return length * (np.cos(np.maximum(0.0, angles(rows, at) - widest[None, :] - V.SLACK)) + V.SLACK)


def need_per_length(needed: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bound below which no candidate helps an anchor; minus infinity where every candidate may."""
    out = np.full(len(needed), -math.inf)
    some = (needed > V.LEAST) & (length > 0)
    out[some] = needed[some].astype(np.float64) / length[some]
    out[(needed > 0) & (length == 0)] = math.inf
    return out - np.abs(np.where(np.isfinite(out), out, 0.0)) * V.SLACK


class Members:
    """A block of anchors while it walks a list: what each still accepts, and what it has found.

    Each anchor has ``slots`` windows [low, high] of scores; a candidate of
    the right label fits every window that holds its score, and a window keeps
    its ``k`` best.
    """

    def __init__(self, rows: np.ndarray, labels: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool):
        self.rows, self.labels, self.low, self.high, self.k, self.same = rows, labels, low.copy(), high, k, same
        self.length = V.lengths(rows)
        self.found: list[tuple[np.ndarray, ...]] = []

    def needed(self) -> np.ndarray:
        """The least score that still changes an anchor's result."""
        return self.low.min(axis=1) if self.low.shape[1] else np.full(len(self.low), V.LAST)

    def take(self, who: np.ndarray, rows: np.ndarray, names: np.ndarray, labels: np.ndarray) -> None:
        """Offer candidates to the anchors ``who`` and raise what they need."""
        kind = V.exact_type(self.rows[who], rows)
        scores = self.rows[who].astype(kind) @ rows.astype(kind).T
        fits = (self.labels[who][:, None] == labels[None, :]) == self.same
        for slot in range(self.low.shape[1]):
            low, high = self.low[who, slot], self.high[who, slot]
            inside = fits & (scores >= low[:, None].astype(kind)) & (scores <= high[:, None].astype(kind))
            r, c = V.best(np.where(inside, scores, np.asarray(V.LEAST, kind)), names, np.maximum(low, V.LEAST + 1025), self.k)
            self.found.append((who[r] * self.low.shape[1] + slot, scores[r, c].astype(np.int64), names[c]))
        self._settle()

    def _settle(self) -> None:
        """Keep each window's ``k`` best so far; a full window needs at least its last one's score."""
        group, score, name = (np.concatenate(x) for x in zip(*self.found, strict=True))
        group, score, name = V.ranked(group, score, name, self.k, score, name)
        self.found = [(group, score, name)]
        full, n = np.unique(group, return_counts=True)
        last = np.flatnonzero(np.r_[group[1:] != group[:-1], True]) if len(group) else np.zeros(0, np.int64)
        full, last = full[n == self.k], last[n == self.k]
        flat = self.low.reshape(-1)
        flat[full] = np.maximum(flat[full], score[last])

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, window, score and name of everything kept."""
        if not self.found:
            return (np.zeros(0, np.int64),) * 4
        group, score, name = self.found[0]
        slots = max(1, self.low.shape[1])
        return group // slots, group % slots, score, name


def walk(members: Members, rows: np.ndarray, names: np.ndarray, labels: np.ndarray, bound: np.ndarray,
         counted: dict[str, int] | None = None) -> None:
    """Every member walks the candidates in order of their bound until its termination is certain."""
    order = np.argsort(-bound, kind="stable")
    rows, names, labels, bound = rows[order], names[order], labels[order], bound[order]
    who = np.arange(len(members.rows))
    for s in range(0, len(rows), STRIDE):
        who = who[bound[s] >= need_per_length(members.needed()[who], members.length[who])]
        if not len(who):
            break
        members.take(who, rows[s:s + STRIDE], names[s:s + STRIDE], labels[s:s + STRIDE])
        if counted is not None:
            counted["products"] = counted.get("products", 0) + len(who) * len(rows[s:s + STRIDE])


def first_windows(members: Members, rows: np.ndarray, names: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The low ends of the windows once the seeds have been offered."""
    if len(rows) and len(members.rows):
        members.take(np.arange(len(members.rows)), rows, names, labels)
    return members.low


# ---------------------------------------------------------------- Spark's part

_ANCHOR = "vec_id long, digest long, label int, vec array<long>"
_PLACED = _ANCHOR + ", low array<long>, high array<long>, cluster int, widest double, unit_need double"


def _lists(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(values.reshape(-1), pa.int64()))


def _columns(table: pa.RecordBatch | pa.Table, names: list[str]) -> list[pa.Array | pa.ChunkedArray]:
    return [table.column(n) for n in names]


def _members(table: pa.RecordBatch | pa.Table, k: int, same: bool) -> Members:
    return Members(V.matrix(table.column("vec")), table.column("label").to_numpy(),
                   V.matrix(table.column("low")), V.matrix(table.column("high")), k, same)


def _place(at: np.ndarray, seeds: tuple[np.ndarray, np.ndarray, np.ndarray], k: int, same: bool):
    """Each anchor's cluster, its angle to the centre, and what it needs once it has seen the seeds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _members(batch, k, same)
            m.rows, rows, centre = V.same_width(m.rows, seeds[0], at)
            low = first_windows(m, rows, *seeds[1:])
            angle = angles(m.rows, centre)
            cluster = angle.argmin(axis=1)
            need = need_per_length(m.needed(), m.length)
            yield pa.RecordBatch.from_arrays(
                [*_columns(batch, ["vec_id", "digest", "label", "vec"]), _lists(low), batch.column("high"),
                 pa.array(cluster.astype(np.int32)), pa.array(angle[np.arange(len(cluster)), cluster]), pa.array(need)],
                names=["vec_id", "digest", "label", "vec", "low", "high", "cluster", "widest", "unit_need"])

    return run


def packs(sizes: dict[int, int]) -> tuple[dict[int, int], list[int]]:
    """The pack of each cluster, and the blocks of each pack: small clusters share one, a large one is cut.

    A candidate is copied once for each block, whatever clusters the block holds.
    """
    own, blocks, room = {}, [], 0
    for cluster, n in sorted(sizes.items()):
        if n > room:
            blocks.append(-(-n // BLOCK_MEMBERS))
            room = BLOCK_MEMBERS if n <= BLOCK_MEMBERS else 0
        own[cluster] = len(blocks) - 1
        room -= min(n, room)
    return own, blocks


def _usable(at: np.ndarray, widest: np.ndarray, need: np.ndarray, own: np.ndarray, n_packs: int):
    """Each candidate with the packs in which some cluster can use it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            usable = bounds(*V.same_width(V.matrix(batch.column("vec")), at), widest) >= need[None, :]
            some = np.zeros((batch.num_rows, n_packs), bool)
            for cluster, pack in enumerate(own.tolist()):
                some[:, pack] |= usable[:, cluster]
            r, c = np.nonzero(some)
            yield pa.RecordBatch.from_arrays(
                [*(x.take(pa.array(r)) for x in _columns(batch, ["vec_id", "label", "vec", "block"])), pa.array(c.astype(np.int32))],
                names=["vec_id", "label", "vec", "block", "pack"])

    return run


def _walk_block(at: np.ndarray, widest: dict[int, float], k: int, same: bool):
    """The clusters of one block of members walk one block of candidates, each in the order of its own bounds."""
    names = ["vec_id", "digest", "label", "own", "slot", "candidate", "score"]

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        listed, labels, ids = V.matrix(rows.column("vec")), rows.column("label").to_numpy(), V.ids(rows.column("vec_id"))
        clusters = anchors.column("cluster").to_numpy()
        out = []
        for cluster in np.unique(clusters).tolist():
            table = anchors.filter(pa.array(clusters == cluster))
            m = _members(table, k, same)
            m.rows, own_rows, centre = V.same_width(m.rows, listed, at[cluster:cluster + 1])
            walk(m, own_rows, ids, labels, bounds(own_rows, centre, np.array([widest[cluster]]))[:, 0])
            who, slot, score, name = m.result()
            own, place = np.einsum("ij,ij->i", m.rows, m.rows), pa.array(who)
            out.append(pa.Table.from_arrays(
                [*(table.column(n).take(place) for n in names[:3]), pa.array(own[who]), pa.array(slot.astype(np.int32)),
                 V.id_array(name), pa.array(score)], names=names))
        return pa.concat_tables(out) if out else _FOUND.empty_table()

    return run


_FOUND = pa.schema([("vec_id", pa.int64()), ("digest", pa.int64()), ("label", pa.int32()), ("own", pa.int64()),
                    ("slot", pa.int32()), ("candidate", pa.int64()), ("score", pa.int64())])


def _walked(rows: DataFrame, anchors: DataFrame, at: np.ndarray, seeds, k: int, same: bool) -> DataFrame:
    """What each window of each anchor keeps, block by block: ``vec_id, digest, label, own, slot, candidate, score``."""
    spark = rows.sparkSession
    placed = materialize(anchors.mapInArrow(_place(at, seeds, k, same), _PLACED), "anchors")
    found = placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max("widest").alias("widest"),
                                          F.min("unit_need").alias("need")).orderBy("cluster").collect()  # one row for each cluster
    own, blocks = packs({r["cluster"]: r["n"] for r in found})
    clusters = np.array([r["cluster"] for r in found], np.int64)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = rows.count()
    n_blocks = max(1, -(-n // BLOCK_ROWS), min(-(-tasks // max(1, sum(blocks))), n // LEAST_ROWS))
    here = F.monotonically_increasing_id()  # of written tables: the same in every attempt

    def pick(values: list[int], index: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values or [0]]), index + 1)

    left = (placed.withColumn("pack", pick([own.get(c, 0) for c in range(len(at))], F.col("cluster")))
            .withColumn("part", (here % pick(blocks, F.col("pack"))).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
            .select("pack", "part", "block", "vec_id", "digest", "label", "vec", "low", "high", "cluster"))
    usable = _usable(at[clusters], np.array([r["widest"] for r in found]), np.array([r["need"] for r in found]),
                     np.array([own[c] for c in clusters.tolist()], np.int64), len(blocks))
    right = (rows.withColumn("block", (here % n_blocks).cast("int")).select("vec_id", "label", "vec", "block")
             .mapInArrow(usable, "vec_id long, label int, vec array<long>, block int, pack int")
             .withColumn("part", F.explode(F.sequence(F.lit(0), pick(blocks, F.col("pack")) - 1))))
    key = ["pack", "part", "block"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        _walk_block(at, {r["cluster"]: r["widest"] for r in found}, k, same),
        "vec_id long, digest long, label int, own long, slot int, candidate long, score long")


def _padded(rows: list[list[int]]) -> np.ndarray:
    width = max(map(len, rows), default=0)
    return np.array([r + [0] * (width - len(r)) for r in rows], np.int64).reshape(len(rows), width)


def positives(rows: DataFrame, anchors: DataFrame, at: np.ndarray, seeds, n: int = POSITIVES) -> DataFrame:
    """``vec_id, digest, label, positives``: each anchor's best ``n`` other rows of its label, as an array in order."""
    open_ended = anchors.select("vec_id", "digest", "label", "vec", F.array(F.lit(V.LEAST)).alias("low"),
                                F.array(F.lit(V.LAST)).alias("high"))
    hits = _walked(rows, open_ended, at, seeds, n + 1, True)  # an anchor is among its own best, and goes last of all
    anchor = W.partitionBy("vec_id", "digest", "label")
    place = F.row_number().over(anchor.orderBy(F.desc("score"), F.col("candidate").asc_nulls_last()))
    own = (F.col("candidate") == F.col("vec_id")) & (F.col("score") == F.col("own"))
    kept = hits.withColumn("place", place).where(F.col("place") <= n + 1)
    kept = kept.withColumn("self", F.coalesce(F.min(F.when(own, F.col("place"))).over(anchor), F.lit(n + 1)))
    entry = F.struct(F.col("place").alias("place"), F.col("score").alias("score"), F.col("candidate").alias("id"))
    return (kept.where(F.col("place") != F.col("self")).groupBy("vec_id", "digest", "label")
            .agg(F.array_sort(F.collect_list(entry)).alias("positives")))


def hard_negatives(frame: DataFrame, is_anchor: Column, label: Column, scale: int = SCALE, id_col: str = "vec_id",
                   vector_col: str = "embedding", n_positives: int = POSITIVES, n_negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` is a condition on ``vec_id`` and ``label`` an expression over
    ``frame``.  Positives are an anchor's ``n_positives`` highest products with
    other rows of its label; the negatives of a positive are the
    ``n_negatives`` highest products with rows of other labels that lie between
    ``low`` and ``high`` hundredths of the positive's score.  Each component
    counts as floor(scale * x); ties go to the smaller vec_id, a null one last.

    Rows with a null label or vector, or with a null, NaN or infinite
    component take no part; a shorter vector is filled with zeros.  Repeated
    rows are candidates each; an anchor repeated with label and vector counts
    once, and only one copy is its own row.  A positive of negative score has
    no negatives (its window is empty).  Products beyond a long are not
    defined.  Further columns are ignored; an empty table gives no rows.
    """
    rows = V.whole_vectors(frame.where(label.isNotNull()), scale, id_col, vector_col, {"label": label.cast("int")})
    rows = materialize(rows, "vectors")
    anchors = (rows.where(F.coalesce(is_anchor, F.lit(False))).withColumn("digest", F.xxhash64("vec"))
               .dropDuplicates(["vec_id", "digest", "label", "vec"]).select("vec_id", "digest", "label", "vec"))
    anchors = materialize(anchors, "anchor-rows")
    sample = anchors.orderBy(F.xxhash64("vec_id"), "digest").limit(SAMPLE).select("vec").collect()
    at = centres(_padded([r["vec"] for r in sample]))
    seeds = rows.orderBy(F.xxhash64("vec_id"), F.xxhash64("vec")).limit(SEEDS).collect()
    # the seeds only tell what a window needs; the walks meet these rows again, so their names are not kept
    seed = (_padded([r["vec"] for r in seeds]), np.arange(len(seeds)), np.array([r["label"] for r in seeds], np.int64))

    chosen = materialize(positives(rows, anchors, at, seed, n_positives), "positives")
    usable = chosen.withColumn("positives", F.filter("positives", lambda p: p["score"] >= 0)).where(F.size("positives") > 0)
    # decimals, so that no product overflows; an anchor with fewer positives gets windows that nothing fits
    ends = {"low": (f"ceil(cast(p.score as decimal(20,0)) * {low} / 100)", V.LAST),
            "high": (f"floor(cast(p.score as decimal(20,0)) * {high} / 100)", V.LEAST)}
    windows = usable.join(anchors, ["vec_id", "digest", "label"]).select(
        "vec_id", "digest", "label", "vec",
        *[F.concat(F.expr(f"transform(positives, p -> cast({end} as bigint))"),
                   F.array_repeat(F.lit(none), F.lit(n_positives) - F.size("positives"))).alias(name)
          for name, (end, none) in ends.items()])
    hits = _walked(rows, windows, at, seed, n_negatives, False)
    slot = W.partitionBy("vec_id", "digest", "label", "slot")
    rank = F.row_number().over(slot.orderBy(F.desc("score"), F.col("candidate").asc_nulls_last()))
    best = hits.withColumn("rank", rank).where(F.col("rank") <= n_negatives)
    return (best.join(usable, ["vec_id", "digest", "label"])
            .withColumn("positive", F.element_at("positives", F.col("slot") + 1))
            .select(F.col("vec_id").alias("anchor_id"), F.col("positive.id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                    F.col("candidate").alias("negative_id"), F.col("positive.score").alias("positive_score"),
                    F.col("score").alias("negative_score")))
