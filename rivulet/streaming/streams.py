"""Structured Streaming forms of ingestion, dedup, audit, histograms, moments,
quarantine and scoring (T1-T5, T7, T8); online fitting (T6) is
``operators.incremental.online_batches``.

Streams read a file source (``maxFilesPerTrigger`` = micro-batch size,
``pathGlobFilter`` to pick files), run with ``trigger(availableNow=True)``
and write to sinks + checkpoints under the shared checkpoint folder, so a
restarted query resumes exactly where it stopped.  ``foreachBatch`` sinks
write each micro-batch under ``batch_id=<n>`` with overwrite, so a replayed
batch replaces its own output instead of duplicating it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import contract as C
from ..operators.audit import nan_to_null
from ..session import path_exists, scratch_path


def file_stream(spark: SparkSession, directory: str, glob: str = "*.parquet", max_files: int = 1,
                fmt: str = "parquet") -> DataFrame:
    """A file-source stream over ``directory`` and the folders in it, restricted to files matching ``glob``."""
    options = {"pathGlobFilter": glob, "recursiveFileLookup": True}
    schema = spark.read.format(fmt).options(**options).load(directory).schema
    return (spark.readStream.format(fmt).schema(schema).options(**options)
            .option("maxFilesPerTrigger", max_files).load(directory))


def run_available_now(stream: DataFrame, sink: str, checkpoint: str | None = None,
                      output_mode: str = "append", fmt: str = "parquet",
                      foreach_batch: Callable | None = None, name: str = "stream") -> str:
    """Process everything available, then stop; returns the sink path."""
    spark = stream.sparkSession
    ckpt = checkpoint or scratch_path(spark, f"{name}-ckpt")
    w = stream.writeStream.outputMode(output_mode).option("checkpointLocation", ckpt).trigger(availableNow=True)
    if foreach_batch is not None:
        q = w.foreachBatch(foreach_batch).start()
    else:
        q = w.format(fmt).option("path", sink).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    return sink


def overwrite_sink(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer for complete-mode results: the latest batch wins."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)
    return write


def per_batch_sink(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: each micro-batch under its own ``batch_id`` folder."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def split_table(df: DataFrame, order: str, parts: int, name: str) -> str:
    """Write a table once, in folders ``part=0, 1, ...`` for equal ranges of ``order``: a source of several micro-batches.

    Each range keeps Spark's own partitions; null keys are in the first one; an
    empty table gives an empty source.  The files hold the columns of ``df``.
    """
    if "part" in df.columns:
        raise ValueError("a column named part would be replaced")
    path = scratch_path(df.sparkSession, name)
    low, high = df.agg(F.min(order), F.max(order)).first()
    part = F.lit(0)
    if low is not None:
        width = (high - low) // parts + 1
        part = F.coalesce(F.least(F.floor((F.col(order) - low) / width), F.lit(parts - 1)), F.lit(0)).cast("int")
    df.withColumn("part", part).write.partitionBy("part").parquet(path)
    if not path_exists(df.sparkSession, f"{path}/part=0"):  # an empty table has written no folder
        df.limit(0).write.parquet(f"{path}/part=0")
    return path


class Arrivals:
    """A table whose ranges of ``order`` arrive one after the other in a folder that a stream watches.

    The ranges are written once and then moved into the folder, one before
    each run of the stream; a run goes on from its checkpoint and finds one new
    micro-batch, as if it were started anew whenever files have arrived.
    """

    def __init__(self, df: DataFrame, order: str, parts: int, name: str):
        self.spark, self.schema, self.parts = df.sparkSession, df.schema, parts
        self.staged = split_table(df, order, parts, f"{name}-staged")
        self.folder = scratch_path(self.spark, f"{name}-source")
        jvm = self.spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(self.folder))

    def stream(self) -> DataFrame:
        return (self.spark.readStream.schema(self.schema).option("recursiveFileLookup", True)
                .option("maxFilesPerTrigger", 1 << 20).parquet(self.folder))

    def run(self, start: Callable[[DataFrame], object]) -> None:
        """Move in the ranges that hold rows, one by one, and ``start`` a run of the stream for each."""
        for i in range(self.parts):
            if path_exists(self.spark, f"{self.staged}/part={i}"):
                self._fs.rename(self._path(f"{self.staged}/part={i}"), self._path(f"{self.folder}/range-{i}"))
                start(self.stream())


def files_per_batch(spark: SparkSession, path: str, parts: int) -> int:
    """Files of each micro-batch with which a source is read in at most ``parts`` of them."""
    return max(1, -(-len(spark.read.parquet(path).inputFiles()) // parts))


# ------------------------------------------------------------------ operators


def stream_dedup(stream: DataFrame, key: str, event_time: str | None = None,
                 delay: str | None = None) -> DataFrame:
    """Streaming first-seen dedup on ``key``.

    Without a watermark the state holds every key ever seen (exact, unbounded,
    as the reference); with ``event_time``/``delay`` it is bounded by
    ``dropDuplicatesWithinWatermark``.
    """
    if event_time and delay:
        return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])


def stream_histogram(stream: DataFrame, target: str) -> DataFrame:
    return stream.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n"))


def stream_moments(stream: DataFrame, group: str, features: Sequence[str]) -> DataFrame:
    aggs = []
    for f in features:
        aggs += [F.avg(f).alias(f"{f}_mean"), F.stddev_pop(f).alias(f"{f}_std"), F.count(f).alias(f"{f}_n")]
    return stream.groupBy(group).agg(*aggs)


#: What a record of an audited stream stands for.
ROW, NULL_ROW, KEPT = "row", "null row", "kept"


def audited(stream: DataFrame, key: str) -> DataFrame:
    """One record for each row of the stream (``row`` or ``null row``) and one ``kept`` for each key seen first.

    Seen keys live in the state store, so a micro-batch costs its own rows and
    the keys that it holds, however many came before.  The keys of an Arrow
    batch are made distinct before the shuffle, so that a hot key does not
    fill one task.
    """
    clean = nan_to_null(stream)
    any_null = F.lit(False)
    for c in clean.columns:
        any_null = any_null | F.col(c).isNull()
    flagged = clean.select(F.col(key).alias("key"), any_null.alias("bad"))
    rows = flagged.select(F.when(F.col("bad"), F.lit(NULL_ROW)).otherwise(F.lit(ROW)).alias("record"))
    keys = flagged.where(~F.col("bad")).select("key")
    first = keys.mapInArrow(_distinct_keys, keys.schema).dropDuplicates(["key"])
    return rows.unionByName(first.select(F.lit(KEPT).alias("record")))


def _distinct_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0).unique()], schema=batch.schema)


def audit_counters(counters_path: str) -> Callable:
    """foreachBatch writer: the counts of an audited micro-batch (P7, W2) under its ``batch_id``."""
    def count(batch: DataFrame, batch_id: int) -> None:
        kinds = {k: F.count_if(F.col("record") == k) for k in (ROW, NULL_ROW, KEPT)}
        batch.agg((kinds[ROW] + kinds[NULL_ROW]).alias("total_rows"), kinds[NULL_ROW].alias("null_rows"),
                  (kinds[ROW] - kinds[KEPT]).alias("duplicates_dropped")).write.mode("overwrite").parquet(
            f"{counters_path}/batch_id={batch_id}")

    return count


def quarantine_batches(rules_fn: Callable[[], Mapping[str, Column]], valid_path: str,
                       dlq_path: str) -> Callable:
    """foreachBatch router: valid rows and dead-letter rows to two sinks per batch."""
    def route(batch: DataFrame, batch_id: int) -> None:
        routed = C.quarantine_rows(batch, rules_fn()).persist()
        C.valid_branch(routed).write.mode("overwrite").parquet(f"{valid_path}/batch_id={batch_id}")
        C.quarantine_branch(routed).write.mode("overwrite").parquet(f"{dlq_path}/batch_id={batch_id}")
        routed.unpersist()
    return route
