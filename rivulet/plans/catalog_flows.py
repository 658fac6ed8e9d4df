"""Registered queries: whole flows over a frame and a contract or a stored model."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import r6
from ..operators import contract as C
from ..operators import metrics as M
from ..session import scratch_path
from ..sources import csv as CSV
from ..sources import models as MS
from .catalog_clean import CONTRACT, DIRTY_CUSTOMER_SQL, dirty_customer
from .fixtures import BINARY_FEATURES, binary_members, linear_sql, lit_sql, load, r6_sql, sigmoid_sql
from .flows import etl_flow, score_stored
from .registry import query

#: The scaler of the stored test model, and its members over scaled features.
MOMENTS = {"l_quantity": (25.5, 14.4), "l_extendedprice": (38000.0, 23000.0), "l_discount": (0.05, 0.03), "l_tax": (0.04, 0.026)}
MEMBERS = [{"features": BINARY_FEATURES, "coef": [0.4 + 0.02 * i, -0.3 - 0.01 * i, 0.2 - 0.03 * i, 0.1 * i], "intercept": 0.1 * i - 0.2}
           for i in range(5)]


def _stored_sql() -> str:
    scaled = ", ".join(f"(CAST({f} AS DOUBLE) - {lit_sql(m)}) / {lit_sql(s)} AS {f}" for f, (m, s) in MOMENTS.items())
    total = " + ".join(sigmoid_sql(linear_sql(m)) for m in MEMBERS)
    return (f"WITH z AS (SELECT l_orderkey, l_linenumber, {scaled} FROM lineitem) "
            f"SELECT l_orderkey, l_linenumber, {r6_sql(f'({total}) / {lit_sql(len(MEMBERS))}')} AS probability FROM z")


@query("score_from_store", "M11,S10,S11", _stored_sql)
def q_score_from_store(spark, d):
    """An older run and the model itself are stored; the latest run scores, with its scaler."""
    path = scratch_path(spark, "store")
    MS.write_params(spark, path, "run-0", "2024-01-01 00:00:00", MS.param_rows(binary_members()))
    MS.write_params(spark, path, "run-1", "2024-02-01 00:00:00", MS.param_rows(MEMBERS, MOMENTS))
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *BINARY_FEATURES)
    return score_stored(li, path).select("l_orderkey", "l_linenumber", r6("probability").alias("probability"))


_CAST_SQL = ("(c_acctbal IS NOT NULL AND TRY_CAST(c_acctbal AS DOUBLE) IS NULL) OR "
             "(c_nationkey IS NOT NULL AND TRY_CAST(c_nationkey AS BIGINT) IS NULL)")


@query("etl_flow", "S6,S8,P1,P3,P5,P6,P9,G16", f"""
SELECT c_custkey, CASE WHEN {_CAST_SQL} OR coalesce(TRY_CAST(c_acctbal AS DOUBLE) > 5000, false) THEN 'dead_letter' ELSE 'valid' END AS sink,
       CASE WHEN {_CAST_SQL} THEN 'cast' ELSE '' END
       || CASE WHEN ({_CAST_SQL}) AND coalesce(TRY_CAST(c_acctbal AS DOUBLE) > 5000, false) THEN ';' ELSE '' END
       || CASE WHEN coalesce(TRY_CAST(c_acctbal AS DOUBLE) > 5000, false) THEN 'large' ELSE '' END AS reason
FROM {DIRTY_CUSTOMER_SQL}
""")
def q_etl_flow(spark, d):
    out = etl_flow(dirty_customer(spark, d), CONTRACT, {"large": F.col("c_acctbal") > 5000}, scratch_path(spark, "etl-flow"),
                   target="c_mktsegment")
    valid = CSV.read_csv(spark, out["valid"]).select("c_custkey", F.lit("valid").alias("sink"), F.lit("").alias("reason"))
    dead = CSV.read_csv(spark, out["dead_letter"]).select("c_custkey", F.lit("dead_letter").alias("sink"), "reason")
    return valid.unionByName(dead).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("cast_whole_columns", "P6", f"""
SELECT c_custkey, c_acctbal, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM {DIRTY_CUSTOMER_SQL}
""")
def q_cast_whole_columns(spark, d):
    """A contracted column with any bad cell stays as it was read (the balance); one without is cast (the nation)."""
    return C.cast_whole_columns(dirty_customer(spark, d), CONTRACT).select("c_custkey", "c_acctbal", "c_nationkey")


@query("metrics_append", "S12", """
SELECT 'run-' || CAST(r AS VARCHAR) AS run_id, metric, value FROM range(2) t(r),
  (SELECT 'n' AS metric, CAST(count(*) AS DOUBLE) AS value FROM events
   UNION ALL SELECT 'users', CAST(count(DISTINCT user_id) AS DOUBLE) FROM events)
""")
def q_metrics_append(spark, d):
    """Two runs appended to one table."""
    wide = load(spark, d, "events").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))
    path = scratch_path(spark, "metrics")
    for run in ("run-0", "run-1"):
        M.append_metrics(wide, path, run)
    return spark.read.parquet(path)
