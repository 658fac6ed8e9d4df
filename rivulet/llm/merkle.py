"""Merkle manifest of a dataset as a content-addressed DAG, and proofs by descent.

Every row of a table is a leaf, named by the digest of its fields.  Within a
group the leaves are numbered in order; while a group has more than one node,
every ``ARITY`` consecutive ones become one node, named by the digest of their
names.  What remains of a group is its subroot; the subroots, in order of
their groups, give the root in the same way.

The manifest is a store of records ``digest -> children``, one per digest.
Proofs descend through it from the root: the digits of a leaf's number, base
``ARITY``, select a child of each node, the children not selected are
collected, and the collected segments are reversed at the end.  Requests with
the same leading digits go down as one row until they part, so a descent joins
as many rows as the level has nodes, and a leaf meets its path only in the
last step, together with the other leaves of its run.

Ranks come from a range partitioning and one count per partition and group:
a group of any size is spread over the partitions, repeated rows included.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize

#: Children of a node (a power of two: BITS digits of a number select one).
ARITY = 8
BITS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Row numbers of a written table: partition and place in it (the layout of monotonically_increasing_id).
_PLACE_BITS = 33
#: More levels than any count that fits a long needs.
_MOST_LEVELS = 21


def digest(fields: Sequence[Column]) -> Column:
    """sha256, lowercase hex, of the fields: ``-`` if null, else UTF-8 byte count, colon, value."""
    named = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in named])
                  .cast("binary"), 256)


def node(children: Column) -> Column:
    """Digest of a node from the array of its children's digests."""
    return F.sha2(F.array_join(children, "").cast("binary"), 256)


def levels(total: Column) -> Column:
    """Levels above ``total`` leaves: the least d with ARITY ** d >= total."""
    return F.aggregate(F.array(*[F.lit(ARITY ** d) for d in range(_MOST_LEVELS)]), F.lit(0),
                       lambda n, size: n + (total > size).cast("int"))


def ranked(rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``pos`` (0, 1, ... in each group by ``order``) and ``total`` (rows of the group).

    ``rows`` is a written table, so that the number that spreads equal keys is the same in every attempt.
    """
    keys = [F.col(group), *map(F.col, order), F.col("spread")]
    placed = rows.withColumn("spread", F.monotonically_increasing_id())
    placed = placed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("spread")
    placed = materialize(placed.withColumn("place", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("part", F.shiftright("place", _PLACE_BITS))
    parts = placed.groupBy("part", group).agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("start"))
    earlier = W.partitionBy(group).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select(F.col("part").alias("in_part"), F.col(group).alias("in_group"), "start",
                         F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
                         F.sum("n").over(W.partitionBy(group)).alias("total"))
    return (placed.join(parts, (F.col("part") == F.col("in_part")) & F.col(group).eqNullSafe(F.col("in_group")))
            .withColumn("pos", F.col("place") - F.col("start") + F.col("before"))
            .drop("place", "part", "in_part", "in_group", "start", "before"))


@dataclass
class Tree:
    """Records of the trees of some groups, by their depth below the tops, and the top of each group."""

    records: list[DataFrame]  # digest, children; the first holds the records of the tops
    lowest: DataFrame | None  # digest, children of the nodes right above the leaves; None if there are none
    tops: DataFrame  # grp, total, digest


def build(nodes: DataFrame, name: str) -> Tree:
    """Trees over ``grp, pos, total, digest``, level by level; every level is written once."""
    nodes = nodes.select("grp", "pos", "total", "digest")
    most = nodes.agg(F.max("total")).first()[0] or 0
    tops = nodes.where("total = 1").select("grp", "total", "digest")
    runs, size = [], 1
    while size < most:
        grouped = nodes.where(F.col("total") > size).groupBy("grp", F.expr(f"pos div {ARITY}").alias("pos"), "total").agg(
            F.array_sort(F.collect_list(F.struct(F.col("pos").alias("at"), "digest"))).alias("run"))
        children = F.transform("run", lambda c: c["digest"])
        size *= ARITY
        nodes = materialize(grouped.select("grp", "pos", "total", node(children).alias("digest"), children.alias("children"),
                                           (levels(F.col("total")) - len(runs) - 1).alias("depth")), f"{name}-nodes")
        runs.append(nodes)
        tops = tops.unionByName(nodes.where(F.col("depth") == 0).select("grp", "total", "digest"))
    records = [materialize(_union([r.where(F.col("depth") == d).select("digest", "children") for r in runs[:len(runs) - d]])
                           .dropDuplicates(["digest"]), f"{name}-records") for d in range(len(runs))]
    return Tree(records, runs[0].select("digest", "children").dropDuplicates(["digest"]) if runs else None, tops)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@dataclass
class Manifest:
    """A dataset's leaves (``grp, pos, total, leaf`` and the columns carried), its records and its root."""

    leaves: DataFrame
    groups: Tree  # the trees of the groups
    top: Tree  # the tree over the subroots
    subroots: DataFrame  # grp, total, digest, rank
    root: str | None  # None for an empty dataset


def manifest(leaves: DataFrame, order: Sequence[str]) -> Manifest:
    """The manifest of ``leaves``: columns ``grp`` (null sorts first), ``leaf``, and those of ``order``.

    Leaves of a group ascend by ``order`` (null first), then by digest; equal rows are separate leaves.
    """
    leaves = ranked(materialize(leaves, "leaves"), "grp", [*order, "leaf"], "ranked-leaves")
    groups = build(leaves.withColumn("digest", F.col("leaf")), "groups")
    one = materialize(groups.tops.withColumn("all", F.lit(0)).withColumnRenamed("total", "rows"), "subroots")
    subroots = materialize(ranked(one, "all", ["grp"], "ranked-subroots"), "subroots")
    top = build(subroots.select(F.col("all").alias("grp"), "pos", "total", "digest"), "top")
    first = top.tops.first()
    subroots = subroots.select("grp", F.col("rows").alias("total"), "digest", F.col("pos").alias("rank"))
    return Manifest(leaves, groups, top, subroots, first["digest"] if first else None)


def _segment(digit: Column, children: Column) -> Column:
    """The digit chosen at a node and the children not chosen, left to right."""
    rest = F.concat(F.slice(children, F.lit(1), digit), F.slice(children, digit + 2, F.lit(ARITY)))
    return F.struct(digit.cast("int").alias("digit"), rest.alias("siblings"))


def _descend(frontier: DataFrame, records: DataFrame, stop: int, keep: Sequence[str]) -> DataFrame:
    """One level down: rows with more than ``stop`` levels left become a row for each child."""
    lower = F.col("left") > stop
    opened = frontier.join(records, "digest", "left").select(
        *keep, "prefix", "left", "path", "children",
        F.posexplode(F.when(lower, F.col("children")).otherwise(F.array("digest"))).alias("digit", "child"))
    return opened.select(
        *keep, F.col("child").alias("digest"),
        F.when(lower, F.col("prefix") * ARITY + F.col("digit")).otherwise(F.col("prefix")).alias("prefix"),
        (F.col("left") - lower.cast("int")).alias("left"),
        F.when(lower, F.concat("path", F.array(_segment(F.col("digit"), F.col("children"))))).otherwise(F.col("path")).alias("path"))


_PATH = "array<struct<digit:int,siblings:array<string>>>"


def descend(found: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """``requests`` (``grp, pos`` and any columns) with ``subroot`` and ``path``: the segments from leaf to root.

    Without requests every leaf asks.  Of a few requests only the prefixes that
    they have are opened; a request whose number its group lacks gets no row.
    """
    if found.root is None:
        raise ValueError("an empty dataset has no root")
    asked = found.leaves if requests is None else requests
    spark = asked.sparkSession
    entry = F.struct((F.col("pos") % ARITY).cast("int").alias("digit"), F.struct(*asked.columns).alias("row")).alias("entry")
    runs = (asked.select(F.col("grp").alias("in_grp"), F.expr(f"pos div {ARITY}").alias("run"), entry)
            .groupBy("in_grp", "run").agg(F.collect_list("entry").alias("entries")))
    if requests is not None:
        runs = materialize(runs, "requests")
    frontier = spark.createDataFrame([(found.root, 0, len(found.top.records), [])], f"digest string, prefix long, left int, path {_PATH}")
    for records in found.top.records:
        frontier = _descend(frontier, records, 0, ())
    frontier = frontier.withColumnRenamed("prefix", "rank").join(found.subroots.drop("digest"), "rank").select(
        "grp", F.col("digest").alias("subroot"), "digest", F.lit(0).cast("long").alias("prefix"),
        levels(F.col("total")).alias("left"), "path")
    for depth, records in enumerate(found.groups.records[:-1], 2):
        frontier = _descend(frontier, records, 1, ("grp", "subroot"))
        if requests is not None:
            frontier = _wanted(frontier, runs, len(found.groups.records) - depth)
    met = frontier.join(runs, F.col("grp").eqNullSafe(F.col("in_grp")) & (F.col("prefix") == F.col("run")))
    none = spark.createDataFrame([], "digest string, children array<string>")
    met = met.join(none if found.groups.lowest is None else found.groups.lowest, "digest", "left")
    met = met.withColumn("entry", F.explode("entries"))
    digit = F.col("entry.digit")
    inside = digit < F.when(F.col("left") > 0, F.size("children")).otherwise(F.lit(1))
    path = F.when(F.col("left") > 0, F.concat("path", F.array(_segment(digit, F.col("children"))))).otherwise(F.col("path"))
    return met.where(inside).select("entry.row.*", "subroot", F.reverse(path).alias("path"))


def _wanted(frontier: DataFrame, runs: DataFrame, most: int) -> DataFrame:
    """The rows of a frontier that lead to some run; ``most`` digits of a run's number lie below it in the tallest tree."""
    prefixes = runs.select("in_grp", "run", F.explode(F.sequence(F.lit(0), F.lit(most))).alias("at")).select(
        "in_grp", "at", F.expr(f"shiftright(run, cast({BITS} * at as int))").alias("in_prefix")).distinct()
    same = (F.col("grp").eqNullSafe(F.col("in_grp")) & (F.col("prefix") == F.col("in_prefix"))
            & (F.greatest(F.col("left") - 1, F.lit(0)) == F.col("at")))
    return frontier.join(prefixes, same, "left_semi")


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path give."""
    return F.aggregate(path, start, lambda name, s: F.sha2(F.concat(
        F.array_join(F.slice(s["siblings"], F.lit(1), s["digit"]), ""), name,
        F.array_join(F.slice(s["siblings"], s["digit"] + 1, F.lit(ARITY)), "")).cast("binary"), 256))


def siblings_digest(path: Column) -> Column:
    """Digest of all digests of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(path, lambda s: s["siblings"])), "").cast("binary"), 256)
