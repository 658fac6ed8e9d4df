"""Partition-count invariance: results must not depend on shuffle partitioning."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
QUERIES = ["chunk_numbering", "running_moments", "roc_auc", "bloom_dedup", "audit_summary", "phrase_drivers",
           "priority_alerts", "hashed_bow", "holdout_per_chunk", "dry_run_chunks", "confusion_matrix",
           "row_identity", "weighted_metrics_binary"]


def _rows(spark, name):
    df = E.queries()[name](spark, SF)
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", QUERIES)
def test_same_result_for_1_and_13_shuffle_partitions(spark, name):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = _rows(spark, name)
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        b = _rows(spark, name)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b
