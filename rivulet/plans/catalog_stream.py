"""Registered queries: Structured Streaming over the driver tables.

A table is cut into ranges that reach the stream as several micro-batches
(``availableNow``); sinks and checkpoints lie under the shared checkpoint
folder, and a query returns its sink read back.  The ``lineitem`` ranges
arrive one by one, each followed by a run that goes on from the checkpoint.
The oracle is the batch answer over the same rows, or the chain of all
versions.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.constants import ALPHA
from ..functions.exprs import r6
from ..operators import batch_runner as BR
from ..operators import incremental as IN
from ..operators import scoring as S
from ..session import scratch_path
from ..streaming import streams as ST
from .catalog_model import soft_vote_sql
from .fixtures import BINARY_FEATURES, BINARY_LABEL_SQL, binary_label, binary_members, lit_sql, load, r6_sql
from .registry import query

#: Micro-batches of the audited events, and ranges in which the line items arrive.
AUDITED, RANGES = 6, 4


def _events(spark, d):
    """The events as three files, so that state crosses micro-batches."""
    path = ST.split_table(load(spark, d, "events"), "event_id", 3, "events")
    return ST.file_stream(spark, path, max_files=ST.files_per_batch(spark, path, 3))


@query("stream_ingest", "T1", "SELECT event_id, user_id, event_type, value FROM events")
def q_stream_ingest(spark, d):
    sink = scratch_path(spark, "t1")
    ST.run_available_now(_events(spark, d).select("event_id", "user_id", "event_type", "value"), sink,
                         name="t1")
    return spark.read.parquet(sink)


@query("stream_dedup", "T2", "SELECT DISTINCT user_id FROM events")
def q_stream_dedup(spark, d):
    sink = scratch_path(spark, "t2")
    ST.run_available_now(ST.stream_dedup(_events(spark, d).select("user_id"), "user_id"), sink, name="t2")
    return spark.read.parquet(sink)


@query("stream_audit", "T3", """
WITH e AS (SELECT event_id, user_id, nullif(event_type, 'error') AS event_type, value FROM events),
     c AS (SELECT * FROM e WHERE event_type IS NOT NULL)
SELECT (SELECT count(*) FROM e) AS total_rows, (SELECT count(*) FROM e) - (SELECT count(*) FROM c) AS null_rows,
       (SELECT count(*) FROM c) - (SELECT count(DISTINCT user_id) FROM c) AS duplicates_dropped
""")
def q_stream_audit(spark, d):
    source = ST.split_table(load(spark, d, "events").select(
        "event_id", "user_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"), "value"), "event_id", AUDITED, "t3")
    stream = ST.file_stream(spark, source, max_files=ST.files_per_batch(spark, source, AUDITED))
    counters = scratch_path(spark, "t3-counters")
    ST.run_available_now(ST.audited(stream, "user_id"), counters, foreach_batch=ST.audit_counters(counters), name="t3")
    c = spark.read.parquet(counters)
    return c.agg(F.sum("total_rows").alias("total_rows"), F.sum("null_rows").alias("null_rows"),
                 F.sum("duplicates_dropped").alias("duplicates_dropped"))


@query("stream_histogram", "T4", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def q_stream_histogram(spark, d):
    sink = scratch_path(spark, "t4")
    ST.run_available_now(ST.stream_histogram(_events(spark, d), "event_type"), sink, output_mode="complete",
                         foreach_batch=ST.overwrite_sink(sink), name="t4")
    return spark.read.parquet(sink)


@query("stream_moments", "T5", f"""
SELECT event_type, {r6_sql('avg(value)')} AS value_mean, {r6_sql('stddev_pop(value)')} AS value_std,
       count(value) AS value_n FROM events GROUP BY event_type
""")
def q_stream_moments(spark, d):
    sink = scratch_path(spark, "t5")
    ST.run_available_now(ST.stream_moments(_events(spark, d), "event_type", ["value"]), sink,
                         output_mode="complete", foreach_batch=ST.overwrite_sink(sink), name="t5")
    out = spark.read.parquet(sink)
    return out.select("event_type", r6("value_mean").alias("value_mean"), r6("value_std").alias("value_std"),
                      "value_n")


def _discount_rules():
    c = F.col("l_discount")
    return {"null:l_discount": c.isNull() | F.isnan(c)}


def _line_items(spark, d, *columns):
    """The line items in ranges of their order that arrive one after the other."""
    return ST.Arrivals(load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *columns), "l_orderkey", RANGES, "lineitem")


def _discount_rules():
    c = F.col("l_discount")
    return {"null:l_discount": c.isNull() | F.isnan(c)}


@query("stream_quarantine", "T7", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0.0 THEN 'quarantine' ELSE 'valid' END AS route
FROM lineitem
""")
def q_stream_quarantine(spark, d):
    valid, dlq, ckpt = (scratch_path(spark, f"t7-{x}") for x in ("valid", "dlq", "ckpt"))
    sink = ST.quarantine_batches(_discount_rules, valid, dlq)
    nulled = F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount")
    _line_items(spark, d, nulled).run(lambda s: ST.run_available_now(s, valid, ckpt, foreach_batch=sink))
    v = spark.read.parquet(valid).select("l_orderkey", "l_linenumber", F.lit("valid").alias("route"))
    q = spark.read.parquet(dlq).select("l_orderkey", "l_linenumber", F.lit("quarantine").alias("route"))
    return v.unionByName(q)


@query("stream_score", "T8", f"""
SELECT l_orderkey, l_linenumber, {r6_sql(soft_vote_sql(binary_members()))} AS probability FROM lineitem
""")
def q_stream_score(spark, d):
    items = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *BINARY_FEATURES)
    source = ST.split_table(items, "l_orderkey", RANGES, "t8-source")
    stream = ST.file_stream(spark, source, max_files=ST.files_per_batch(spark, source, RANGES))
    scored = S.score_binary(stream, binary_members(), out_col="probability").select("l_orderkey", "l_linenumber", "probability")
    sink = scratch_path(spark, "t8")
    ST.run_available_now(scored, sink, name="t8")
    return spark.read.parquet(sink).select("l_orderkey", "l_linenumber", r6("probability").alias("probability"))


_RATIO_SQL = f"""
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_discount + l_tax <> 0 THEN {r6_sql('l_extendedprice / (l_discount + l_tax)')} END AS ratio,
       CASE WHEN l_discount + l_tax = 0 THEN 'FloatingPointError: divide by zero encountered in divide' END AS error FROM lineitem
"""


def price_ratio(rows):
    """A scorer that raises on the rows whose discount and tax are both zero."""
    import numpy as np
    import pandas as pd

    with np.errstate(divide="raise", invalid="raise"):
        return pd.DataFrame({"ratio": rows["l_extendedprice"].to_numpy() / (rows["l_discount"].to_numpy() + rows["l_tax"].to_numpy())})


def _both_sinks(spark, valid, dead):
    """What a scoring run has put into its two sinks, side by side."""
    v = spark.read.parquet(valid).select("l_orderkey", "l_linenumber", r6("ratio").alias("ratio"), F.lit(None).cast("string").alias("error"))
    q = spark.read.parquet(dead).select("l_orderkey", "l_linenumber", F.lit(None).cast("double").alias("ratio"), BR.ERROR)
    return v.unionByName(q)


@query("score_continue", "M15", _RATIO_SQL)
def q_score_continue(spark, d):
    """A scoring run over rows on which the scorer raises: they reach the dead-letter sink, all others are scored."""
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax")
    valid, dead = scratch_path(spark, "m15-valid"), scratch_path(spark, "m15-dead")
    BR.write_sinks(BR.score_batches(li, price_ratio, "ratio double"), li.columns, valid, dead)
    return _both_sinks(spark, valid, dead)


@query("stream_score_continue", "M15,T7", _RATIO_SQL)
def q_stream_score_continue(spark, d):
    """The same over a stream whose every micro-batch holds rows on which the scorer raises."""
    valid, dead, ckpt = (scratch_path(spark, f"t7-{x}") for x in ("scored", "dead", "score-ckpt"))
    sink = BR.score_stream_batches(price_ratio, "ratio double", valid, dead)
    items = _line_items(spark, d, "l_extendedprice", "l_discount", "l_tax")
    items.run(lambda s: ST.run_available_now(s, valid, ckpt, foreach_batch=sink))
    return _both_sinks(spark, valid, dead)


FIT_FEATURES = {"l_quantity": "l_quantity / CAST(50 AS DOUBLE)", "l_discount": "l_discount", "l_tax": "l_tax"}
FIT_RATE = 0.1


def _stream_fit_sql() -> str:
    """Each version from the one before, by the exact gradient over its own range of orders."""
    names = [*FIT_FEATURES, "_intercept"]
    span = "(max(l_orderkey) OVER () - min(l_orderkey) OVER ())"
    ctes = [f"""r AS (SELECT {', '.join(f'{e} AS x_{f}' for f, e in FIT_FEATURES.items())}, {BINARY_LABEL_SQL} AS y,
      least((l_orderkey - min(l_orderkey) OVER ()) // ({span} // {RANGES} + 1), {RANGES - 1}) AS part FROM lineitem)""",
            "v0 AS (SELECT " + ", ".join(f"CAST(0 AS DOUBLE) AS w_{f}" for f in names) + ")"]
    z = " + ".join([f"w_{f} * x_{f}" for f in FIT_FEATURES] + ["w__intercept"])
    for b in range(1, RANGES + 1):
        step = [f"any_value(w_{f}) * {lit_sql(1 - FIT_RATE * ALPHA)} - {lit_sql(FIT_RATE)} * avg(d * x_{f}) AS w_{f}" for f in FIT_FEATURES]
        step.append(f"any_value(w__intercept) - {lit_sql(FIT_RATE)} * avg(d) AS w__intercept")
        ctes.append(f"d{b} AS (SELECT r.*, p.*, 1.0 / (1.0 + exp(-({z}))) - y AS d FROM r, v{b - 1} p WHERE part = {b - 1})")
        ctes.append(f"v{b} AS (SELECT {', '.join(step)} FROM d{b})")
    out = [f"SELECT CAST({b - 1} AS INTEGER) AS batch_id, '{f}' AS feature, {r6_sql(f'w_{f}')} AS coef FROM v{b}"
           for b in range(1, RANGES + 1) for f in names]
    return "WITH " + ",\n".join(ctes) + "\n" + " UNION ALL ".join(out)


@query("stream_fit", "T6", _stream_fit_sql)
def q_stream_fit(spark, d):
    """Every version of a model that is updated by each micro-batch."""
    learner = IN.Learner("log", tuple(FIT_FEATURES), lr=FIT_RATE)
    path, ckpt = scratch_path(spark, "t6"), scratch_path(spark, "t6-ckpt")
    features = [(F.col("l_quantity") / F.lit(50.0)).alias("l_quantity"), "l_discount", "l_tax", binary_label().alias("label")]
    update = IN.online_batches(learner, path, lambda batch: IN.dense_rows(batch, learner.features, [F.col("label")]))
    _line_items(spark, d, *features).run(lambda s: ST.run_available_now(s, path, ckpt, foreach_batch=update))
    rows = IN.Versions(spark, path, learner).table()
    return rows.select(F.col("version").alias("batch_id"), "feature", r6("coef").alias("coef"))
