"""Sharding by fixed virtual slots, in DataFrame functions only.

A record is hashed into one of ``SLOTS`` virtual slots; the bytes of each slot
are summed over the whole table; a slot-to-shard map says where each slot
lives.  The map is a versioned table: version 0 deals the slots round robin,
and a rebalancing edits it, moving slots from the fullest shards to the
emptiest until no move or exchange of slots brings them closer.  Records never
change their slot; only the map, whose size is fixed, is edited.

Ordinals within a shard are the count of the shard's records in lower slots
plus the row number in the slot, so no window is larger than a slot.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

SLOTS = 1 << 14
SHARDS = 40
OVERHEAD = 16
#: Copies of a repeated row that are written out together.
COPIES = 1024


def records(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, slot`` of every row.

    The slot is a hash of id and text; further copies of a row that is
    repeated whole are hashed with their number, so that no record, however
    often it is repeated, fills a slot.  Equal rows are counted before they are
    shuffled and written out again copy by copy.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    kept = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(t).cast("long") + OVERHEAD).alias("size"),
                       F.crc32(t.cast("binary")).alias("text_crc32"))
    counted = kept.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    runs = counted.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPIES}"))))
    copies = runs.withColumn("copy", F.explode(F.sequence(F.col("run") * COPIES, F.least(F.col("n"), (F.col("run") + 1) * COPIES) - 1)))
    name = F.when(F.col("copy") == 0, F.xxhash64("doc_id", "text_crc32")).otherwise(F.xxhash64("doc_id", "text_crc32", "copy"))
    return copies.select("doc_id", "size", "text_crc32", F.pmod(name, F.lit(slots)).cast("int").alias("slot"))


def rebalance(places: list[int], sizes: list[int], shards: int) -> list[int]:
    """An edited map: slots move from the fullest to the emptiest shard while that narrows the gap.

    Takes the current shard and the bytes of each slot.  Each step moves the
    slot, or exchanges the pair of slots, whose difference comes closest to half the gap.
    """
    places, load = list(places), [0] * shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, (shard, size) in enumerate(zip(places, sizes, strict=True)):
        load[shard] += size
        if size:
            bisect.insort(held[shard], (size, slot))
    for _ in range(len(places)):
        high, low = load.index(max(load)), load.index(min(load))
        gap = load[high] - load[low]
        best = None  # (distance from half the gap, slot to move down, slot to move back or None)
        options = [(0, None), *held[low]]
        for size, slot in held[high]:
            at = bisect.bisect_left(options, size - gap / 2, key=lambda x: x[0])
            for back, other in options[max(0, at - 1):at + 1]:
                moved = size - back
                if 0 < moved < gap and (best is None or abs(2 * moved - gap) < best[0]):
                    best = (abs(2 * moved - gap), (size, slot), (back, other))
        if best is None:
            return places
        _, (size, slot), (back, other) = best
        held[high].remove((size, slot))
        bisect.insort(held[low], (size, slot))
        places[slot] = low
        if other is not None:
            held[low].remove((back, other))
            bisect.insort(held[high], (back, other))
            places[other] = high
        load[high] -= size - back
        load[low] += size - back
    return places


def write_map(spark: SparkSession, path: str, version: int, places: list[int]) -> None:
    """Append one version of the map: rows ``version, slot, shard``."""
    listed = F.split(F.lit(",".join(map(str, places))), ",").cast("array<int>")
    (spark.range(1).select(F.lit(version).alias("version"), F.posexplode(listed).alias("slot", "shard"))
     .write.mode("append").parquet(path))


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """``slot, shard`` of a version, the latest by default."""
    table = spark.read.parquet(path)
    wanted = table.agg(F.max("version")).first()[0] if version is None else version
    return table.where(F.col("version") == wanted).select("slot", "shard")


def shard(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, slots: int = SLOTS,
          map_path: str | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot, shard, ordinal`` of every row.

    ``ordinal`` counts each shard's rows from 0 without gaps.  If ``map_path``
    holds a map, its latest version is edited to fit this table and appended
    as the next one; otherwise version 0 is written first.  Null text has no bytes;
    null ids are hashed as null; the copies of a record repeated whole are
    spread over the slots; an empty table gives no rows and
    leaves the map as it was dealt; further columns are ignored.
    """
    spark = docs.sparkSession
    rows = records(docs, doc_id, text, slots)
    sums = rows.groupBy("slot").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()  # at most one row a slot
    sizes, counts = [0] * slots, [0] * slots
    for r in sums:
        sizes[r["slot"]], counts[r["slot"]] = r["size"], r["n"]
    if map_path is None:
        map_path, version = scratch_path(spark, "slot-map"), 0
        places = [s % shards for s in range(slots)]
        write_map(spark, map_path, 0, places)
    else:
        version = spark.read.parquet(map_path).agg(F.max("version")).first()[0]
        places = [r["shard"] for r in read_map(spark, map_path, version).orderBy("slot").collect()]
    write_map(spark, map_path, version + 1, rebalance(places, sizes, shards))
    found = read_map(spark, map_path, version + 1)
    listed = F.split(F.lit(",".join(map(str, counts))), ",").cast("array<long>")
    lower = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = found.withColumn("n", F.element_at(listed, F.col("slot") + 1)).withColumn(
        "before", F.coalesce(F.sum("n").over(lower), F.lit(0))).drop("n")
    within = Window.partitionBy("slot").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("__row", F.row_number().over(within) - 1)
            .join(F.broadcast(placed), "slot")  # as many rows as there are slots
            .select("doc_id", "size", "text_crc32", F.col("slot").alias("virtual_slot"), "shard",
                    (F.col("before") + F.col("__row")).alias("ordinal")))
