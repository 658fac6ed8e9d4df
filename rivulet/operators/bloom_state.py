"""A Bloom filter that persists between runs.

The bits are a table of bitmap blocks (``bucket``, 4 KB of ``bits``), built with
Spark's bitmap aggregates.  Every run reads the state that the run before it
has left, decides its rows as a sequential filter would, and writes the state
with its own bits; states of different filters of one geometry merge by OR.  A
run that is repeated starts from the same state and replaces its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import BLOOM_N_ITEMS, BLOOM_P
from ..functions.exprs import bloom_geometry
from ..session import path_exists
from .audit import bloom_bits, first_seen, matching

#: Bytes of a filter up to which its blocks are sent to all tasks; a larger one is joined by block.
MOST_BROADCAST = 64 << 20


def _is_set(bits: Column, position: Column) -> Column:
    """Whether the bit at ``position`` of a bitmap block is set."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), position % 8)).cast("int") % 2 == 1


def merge(*states: DataFrame) -> DataFrame:
    """The state of all rows that any of the filters has seen."""
    out = states[0]
    for s in states[1:]:
        out = out.unionByName(s)
    return out.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


@dataclass(frozen=True)
class BloomStore:
    """The states of a filter of ``n_items`` at rate ``p``: Parquet folders ``run=<n>`` under ``path``."""

    spark: SparkSession
    path: str
    n_items: int = BLOOM_N_ITEMS
    p: float = BLOOM_P

    def state(self, run: int) -> DataFrame:
        """The state that a run has left; an error if it is not complete."""
        if not path_exists(self.spark, f"{self.path}/run={run}/_SUCCESS"):
            raise ValueError(f"run {run} has left no state in {self.path}")
        return self.spark.read.parquet(f"{self.path}/run={run}")

    def dedup(self, df: DataFrame, key: str, seq: str, run: int, after: int | None = None) -> DataFrame:
        """The rows of ``df`` that the filter keeps after run ``after`` (None: an empty filter); writes the state of ``run``.

        ``seq`` is unique and orders the rows.  A row is dropped if each of its
        bits is set by the state or by an earlier row, false positives
        included.  The work runs over distinct keys, and over the bits that
        the state does not have yet.
        """
        m, k = bloom_geometry(self.n_items, self.p)
        bits = bloom_bits(first_seen(df, key, seq), key, m, k).withColumns(
            {"_bucket": F.bitmap_bucket_number(F.col("_bit") + 1), "_place": F.bitmap_bit_position(F.col("_bit") + 1)})
        before = None if after is None else self.state(after)
        if before is not None:
            blocks = before.select(F.col("bucket").alias("_bucket"), "bits")
            blocks = F.broadcast(blocks) if m // 8 <= MOST_BROADCAST else blocks
            known = F.coalesce(_is_set(F.col("bits"), F.col("_place")), F.lit(False))
            bits = bits.join(blocks, "_bucket", "left").where(~known).drop("bits")
        first = bits.groupBy("_bit").agg(F.min(seq).alias("_first"))
        last = bits.join(first, "_bit").groupBy(key, seq).agg(F.max("_first").alias("_last"))
        own = bits.groupBy(F.col("_bucket").alias("bucket")).agg(F.bitmap_construct_agg("_place").alias("bits"))
        after_run = own if before is None else merge(before, own)
        after_run.write.mode("overwrite").parquet(f"{self.path}/run={run}")
        return matching(df, last.where(F.col("_last") >= F.col(seq)).select(key, seq), key, seq)

    def fill(self, run: int) -> DataFrame:
        """``bits_set, bits``: how full the filter is after a run."""
        m, _ = bloom_geometry(self.n_items, self.p)
        return self.state(run).agg(F.sum(F.bitmap_count("bits")).alias("bits_set")).withColumn("bits", F.lit(m))
