"""Streaming == batch over several micro-batches (one file per trigger)."""

from pyspark.sql import functions as F

from rivulet.operators import audit as A
from rivulet.session import scratch_path
from rivulet.streaming import streams as ST

SF = "/root/testdata/sf0.001"


def _split_files(spark, n=3):
    ev = spark.read.parquet(f"{SF}/events.parquet").select(
        "event_id", "user_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"), "value")
    d = scratch_path(spark, "t-stream-src")
    for i in range(n):
        ev.where(F.pmod("event_id", F.lit(n)) == i).coalesce(1).write.parquet(f"{d}/part{i}")
    return d, ev


def _stream(spark, d):
    schema = spark.read.parquet(f"{d}/part0").schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(d))


def test_stream_audit_across_batches_equals_batch(spark):
    d, ev = _split_files(spark)
    s = _stream(spark, d)
    counters = scratch_path(spark, "t-ct")
    ST.run_available_now(ST.audited(s, "user_id"), counters, foreach_batch=ST.audit_counters(counters))
    c = spark.read.parquet(counters)
    assert c.select("batch_id").distinct().count() == 3
    got = c.agg(F.sum("total_rows"), F.sum("null_rows"), F.sum("duplicates_dropped")).collect()[0]
    exp = A.audit_summary(ev, "user_id", "event_id").collect()[0]
    assert tuple(got) == (exp["total_rows"], exp["null_rows"], exp["duplicates_dropped"])


def test_stream_dedup_and_histogram_equal_batch(spark):
    d, ev = _split_files(spark)
    sink = scratch_path(spark, "t-dd")
    ST.run_available_now(ST.stream_dedup(_stream(spark, d).select("user_id"), "user_id"), sink)
    assert spark.read.parquet(sink).count() == ev.select("user_id").distinct().count()
    hist = scratch_path(spark, "t-h")
    ST.run_available_now(ST.stream_histogram(_stream(spark, d), "event_type"), hist, output_mode="complete",
                         foreach_batch=ST.overwrite_sink(hist))
    got = {r["event_type"]: r["n"] for r in spark.read.parquet(hist).collect()}
    exp = {r["event_type"]: r["count"] for r in ev.where("event_type IS NOT NULL").groupBy("event_type").count().collect()}
    assert got == exp


def test_stream_quarantine_replay_is_idempotent(spark):
    d, ev = _split_files(spark)
    valid, dlq = scratch_path(spark, "t-v"), scratch_path(spark, "t-q")
    ckpt = scratch_path(spark, "t-ck")
    rules = lambda: {"null_type": F.col("event_type").isNull()}
    sink = ST.quarantine_batches(rules, valid, dlq)
    ST.run_available_now(_stream(spark, d), valid, checkpoint=ckpt, foreach_batch=sink)
    # replay batch 1 by hand (as a restart after a crash mid-batch would)
    sink(spark.read.parquet(f"{d}/part1"), 1)
    assert spark.read.parquet(valid).count() == ev.where("event_type IS NOT NULL").count()
    assert spark.read.parquet(dlq).count() == ev.where("event_type IS NULL").count()


def test_stream_dedup_within_watermark_bounds_state(spark):
    d, ev = _split_files(spark)
    s = _stream(spark, d)
    sink = scratch_path(spark, "t-wm")
    ST.run_available_now(ST.stream_dedup(s.select("user_id", "event_id", F.col("event_id").cast("timestamp")
                                                  .alias("ts")), "user_id", "ts", "1 hour"), sink)
    out = spark.read.parquet(sink)
    # within-watermark dedup never emits a key twice inside the delay window
    assert out.count() >= ev.select("user_id").distinct().count()


def test_weights_that_cannot_be_read_fail_the_batch(spark, tmp_path):
    import pytest
    from rivulet.operators import incremental as IN
    for n, mark in ((0, True), (1, False)):
        (tmp_path / f"version={n}").mkdir()
        (tmp_path / f"version={n}" / "part-0.parquet").write_bytes(b"not a table")
        if mark:
            (tmp_path / f"version={n}" / "_SUCCESS").touch()
    batch = spark.createDataFrame([(0.5, 1.0)], "x double, label double")
    learner = IN.Learner("log", ("x",))
    assert IN.Versions(spark, str(tmp_path), learner).latest() == 0  # an unfinished version does not count
    with pytest.raises(Exception):
        IN.online_batches(learner, str(tmp_path), lambda b: IN.dense_rows(b, ["x"], [F.col("label")]))(batch, 2)


def test_nan_counts_as_null_and_null_keys_are_null_rows(spark):
    counters = scratch_path(spark, "t-nan")
    batch = spark.createDataFrame([(1, float("nan")), (2, 1.0), (2, 2.0), (None, 3.0)], "k int, x double")
    ST.audit_counters(counters)(ST.audited(batch, "k"), 0)
    assert tuple(spark.read.parquet(counters).select("total_rows", "null_rows", "duplicates_dropped").first()) == (4, 2, 1)


def test_audit_of_a_batch_reads_no_earlier_batch_and_goes_on_after_a_restart(spark):
    """Five arrivals, each with a run of its own: the state store remembers the keys, the input stays the batch."""
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "user_id", "value")
    counters, ckpt = scratch_path(spark, "t-arr"), scratch_path(spark, "t-arr-ck")
    read = []

    def start(stream):
        q = (ST.audited(stream, "user_id").writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True)
             .foreachBatch(ST.audit_counters(counters)).start())
        q.awaitTermination()
        read.append(sum(p["numInputRows"] for p in q.recentProgress))

    ST.Arrivals(ev, "event_id", 5, "t-arr").run(start)
    rows = spark.read.parquet(counters).orderBy("batch_id").collect()
    assert len(rows) == 5 and len(set(read)) <= 3 and max(read) <= 2 * max(r["total_rows"] for r in rows)
    assert sum(r["total_rows"] for r in rows) == ev.count()
    assert sum(r["total_rows"] - r["duplicates_dropped"] for r in rows) == ev.select("user_id").distinct().count()


def test_split_table_keeps_null_keys_and_partitions(spark):
    keys = [None, None, *range(0, 300, 7)]
    table = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, v int").repartition(4)
    path = ST.split_table(table, "k", 3, "t-split")
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == list(range(len(keys)))
    n = ST.files_per_batch(spark, path, 3)
    assert n > 1  # no range is written by one task
    sink = scratch_path(spark, "t-split-out")
    ST.run_available_now(ST.file_stream(spark, path, "*.parquet", n), sink, foreach_batch=ST.per_batch_sink(sink))
    got = spark.read.parquet(sink)
    assert got.count() == len(keys) and got.select("batch_id").distinct().count() == 3
    wide = spark.createDataFrame([(0, 0), (2**62, 1)], "k long, v int")
    assert spark.read.parquet(ST.split_table(wide, "k", 3, "t-split-w")).count() == 2
    for rows in (table.limit(0), table.where("k IS NULL")):
        path = ST.split_table(rows, "k", 3, "t-split-0")
        assert ST.file_stream(spark, path, "*.parquet").columns == ["k", "v"]
        assert spark.read.parquet(path).count() == rows.count()
