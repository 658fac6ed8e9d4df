"""Audit and dedup: exact first-seen, Bloom (parallel == sequential), summary."""

import hashlib
import math

from pyspark.sql import functions as F

from rivulet.functions.exprs import bloom_geometry
from rivulet.operators import audit as A


def sequential_bloom(keys, n_items, p):
    """Reference semantics written as the plain loop: keep iff some bit unset."""
    m = int(-(n_items * math.log(p)) / (math.log(2) ** 2))
    k = int((m / n_items) * math.log(2))
    bits = bytearray(m // 8 + 1)
    kept = []
    for i, key in enumerate(keys):
        s = str(key).encode()
        h1, h2 = int(hashlib.md5(s).hexdigest(), 16), int(hashlib.sha1(s).hexdigest(), 16)
        pos = [(h1 + j * h2) % m for j in range(k)]
        if all(bits[b // 8] & (1 << (b % 8)) for b in pos):
            continue
        for b in pos:
            bits[b // 8] |= 1 << (b % 8)
        kept.append(i)
    return kept


def _frame(spark, keys):
    return spark.createDataFrame([(i, int(k)) for i, k in enumerate(keys)], "seq long, key long")


def test_bloom_geometry_matches_formula():
    assert bloom_geometry(10_000_000, 0.01) == (95850583, 6)
    assert bloom_geometry(100, 0.01) == (958, 6)


def test_bloom_equals_sequential_undersized(spark):
    keys = [(i * 7919) % 3242 for i in range(4000)]          # repeats + an undersized filter
    expected = sequential_bloom(keys, 300, 0.01)
    got = sorted(r["seq"] for r in A.bloom_dedup(_frame(spark, keys), "key", "seq", 300, 0.01).collect())
    assert got == expected
    assert len(got) < len(set(keys))                          # false positives really happen


def test_bloom_equals_sequential_saturated_single_hash(spark):
    keys = [(i * 31) % 364 for i in range(900)]
    expected = sequential_bloom(keys, 300, 0.4)                # k = 1, saturated
    got = sorted(r["seq"] for r in A.bloom_dedup(_frame(spark, keys), "key", "seq", 300, 0.4).collect())
    assert got == expected


def test_bloom_partition_invariant(spark):
    keys = [(i * 13) % 500 for i in range(2000)]
    df = _frame(spark, keys)
    a = sorted(r["seq"] for r in A.bloom_dedup(df.repartition(1), "key", "seq", 200, 0.01).collect())
    b = sorted(r["seq"] for r in A.bloom_dedup(df.repartition(7), "key", "seq", 200, 0.01).collect())
    assert a == b


def test_exact_dedup_keeps_first(spark):
    df = spark.createDataFrame([(1, 10, "a"), (2, 10, "b"), (3, 11, "c"), (0, 11, "d")], "seq long, key long, v string")
    got = {(r["key"], r["v"]) for r in A.first_seen_dedup(df, "key", "seq").collect()}
    assert got == {(10, "a"), (11, "d")}


def test_audit_summary_nulls_nan_and_duplicates(spark):
    rows = [(0, 1, 1.0), (1, 1, 2.0), (2, 2, float("nan")), (3, 3, None), (4, 4, 5.0), (5, 4, 6.0)]
    df = spark.createDataFrame(rows, "seq long, key long, x double")
    r = A.audit_summary(df, "key", "seq").collect()[0]
    assert (r["total_rows"], r["null_rows"], r["duplicates_dropped"], r["total_dropped"]) == (6, 2, 2, 4)
    assert abs(r["retention_pct"] - 100 * 2 / 6) < 1e-6


def test_audit_summary_empty(spark):
    df = spark.createDataFrame([], "seq long, key long, x double")
    r = A.audit_summary(df, "key", "seq").collect()[0]
    assert r["total_rows"] == 0 and r["retention_pct"] == 0.0


def test_drop_null_any_treats_nan_as_missing(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0), (None, 2.0)], "a long, b double")
    assert A.drop_null_any(df).count() == 1


def test_duplicate_count(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    got = {r["k"]: r["n_duplicates"] for r in A.duplicate_count(df, "k").collect()}
    assert got == {1: 1, 2: 0}


def test_dedup_skew_plan_has_no_window(spark):
    """The hot-key-safe form aggregates and semi-joins; no per-key sort window."""
    df = spark.range(1000).select(F.col("id").alias("seq"), (F.col("id") % 3).alias("key"))
    plan = A.first_seen_dedup(df, "key", "seq")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_bloom_capacity_flags_undersized(spark):
    df = spark.range(5000).withColumnRenamed("id", "key")
    assert A.bloom_capacity(df, "key", 300).collect()[0]["undersized"]
    assert not A.bloom_capacity(df, "key", 10_000_000).collect()[0]["undersized"]


def test_text_reports_written(spark):
    from rivulet.plans import flows
    from rivulet.session import scratch_path
    rep = flows.text_flow(spark, "/root/testdata/sf0.001", epochs=1)
    paths = flows.write_reports({"drivers": rep["drivers"], "alerts": rep["alerts"]}, scratch_path(spark, "rep"))
    assert spark.read.option("header", True).csv(paths["drivers"]).count() == rep["drivers"].count()


def test_bloom_property_random_streams(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    @settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
    @given(keys=st.lists(st.integers(0, 400), min_size=1, max_size=300),
           n_items=st.integers(5, 400), p=st.sampled_from([0.01, 0.05, 0.2]))
    def check(keys, n_items, p):
        expected = sequential_bloom(keys, n_items, p)
        got = sorted(r["seq"] for r in A.bloom_dedup(_frame(spark, keys), "key", "seq", n_items, p).collect())
        assert got == expected

    check()


def test_audit_summary_bloom_mode_counts_survivors(spark):
    keys = [(i * 7919) % 3242 for i in range(4000)]
    df = _frame(spark, keys).withColumn("x", F.lit(1.0))
    r = A.audit_summary(df, "key", "seq", mode="bloom", n_items=300, p=0.01).collect()[0]
    kept = len(sequential_bloom(keys, 300, 0.01))
    assert (r["total_rows"], r["null_rows"], r["duplicates_dropped"]) == (4000, 0, 4000 - kept)


def test_flows_report_auc(spark):
    from rivulet.plans import flows
    auc = flows.text_flow(spark, "/root/testdata/sf0.001", epochs=1)["auc"].first()["auc"]
    assert 0.0 <= auc <= 1.0
    middle = spark.read.parquet("/root/testdata/sf0.001/part.parquet").agg(F.median("p_retailprice")).first()[0]
    rows = flows.admissions_flow(spark, "/root/testdata/sf0.001", threshold=middle).collect()
    assert any(r["auc"] is not None and 0.0 <= r["auc"] <= 1.0 for r in rows)
    one_class = flows.admissions_flow(spark, "/root/testdata/sf0.001", threshold=1e9).collect()
    assert all(r["auc"] is None for r in one_class)
