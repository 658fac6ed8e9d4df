"""Registered queries: labels, contract, quarantine, audit, dedup, splits.

Each query reads whole driver tables; null cases are injected with
``nullif`` on both the Spark side and the oracle side (the fixtures have no
nulls).  Derived doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import r6
from ..operators import audit as A
from ..operators import contract as C
from ..operators import labels as L
from .fixtures import BINARY_LABEL_SQL, SEED, TEST_RATIO, binary_label, load
from ..session import scratch_path
from .registry import query

# --------------------------------------------------------------------- labels


@query("class_histogram", "G1", """
SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY event_type
""")
def q_class_histogram(spark, d):
    return L.class_histogram(load(spark, d, "events"), "event_type")


@query("class_weights", "G2", f"""
WITH h AS (SELECT {BINARY_LABEL_SQL} AS label, count(*) AS n FROM lineitem GROUP BY 1)
SELECT label, n, (round(CAST(sum(n) OVER () AS DOUBLE) / ((count(*) OVER ()) * n), 6) + 0.0) AS weight
FROM h
""")
def q_class_weights(spark, d):
    li = load(spark, d, "lineitem").select(binary_label().alias("label"))
    return L.class_weights(li, "label").withColumn("weight", r6("weight"))


@query("class_domain", "G3", """
SELECT l_returnflag, CAST(dense_rank() OVER (ORDER BY l_returnflag) - 1 AS INTEGER) AS class_index
FROM (SELECT DISTINCT l_returnflag FROM lineitem WHERE l_returnflag IS NOT NULL)
""")
def q_class_domain(spark, d):
    return L.class_domain(load(spark, d, "lineitem"), "l_returnflag")


@query("binarise_label", "P12", """
SELECT p_partkey, p_retailprice, CAST(p_retailprice > 1500.0 AS INTEGER) AS label FROM part
""")
def q_binarise_label(spark, d):
    p = load(spark, d, "part")
    return p.select("p_partkey", "p_retailprice", L.binarise("p_retailprice", 1500.0).alias("label"))


@query("holdout_hash", "W5", f"""
SELECT o_orderkey,
       (('0x' || substr(md5('{SEED}|' || CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT / CAST(4294967296 AS DOUBLE))
         < CAST({TEST_RATIO} AS DOUBLE) AS is_test
FROM orders
""")
def q_holdout_hash(spark, d):
    return L.holdout_hash(load(spark, d, "orders").select("o_orderkey"), "o_orderkey", TEST_RATIO, SEED)


@query("holdout_per_chunk", "W5", f"""
WITH c AS (SELECT o_orderkey, CAST(floor(o_orderkey / 500) AS BIGINT) AS chunk_id FROM orders)
SELECT o_orderkey, chunk_id,
       row_number() OVER (PARTITION BY chunk_id ORDER BY md5('{SEED}|' || CAST(o_orderkey AS VARCHAR)), o_orderkey)
         <= ceil(CAST({TEST_RATIO} AS DOUBLE) * count(*) OVER (PARTITION BY chunk_id)) AS is_test
FROM c
""")
def q_holdout_per_chunk(spark, d):
    o = load(spark, d, "orders").select("o_orderkey",
                                        F.floor(F.col("o_orderkey") / 500).cast("long").alias("chunk_id"))
    return L.holdout_per_chunk(o, "o_orderkey", "chunk_id", TEST_RATIO, SEED)


# ------------------------------------------------------------------- contract

# Dirty view of ``customer``: balances as text with a bad token on negative
# balances, nation codes as text, and a null segment for AUTOMOBILE.
CONTRACT = {"required_columns": ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"],
            "dtypes": {"c_acctbal": "float64", "c_nationkey": "int64"}}

DIRTY_CUSTOMER_SQL = """
(SELECT c_custkey, c_name,
        CASE WHEN c_acctbal < 0 THEN 'bad:' || CAST(c_custkey AS VARCHAR) ELSE CAST(c_acctbal AS VARCHAR) END
          AS c_acctbal,
        CAST(c_nationkey AS VARCHAR) AS c_nationkey,
        nullif(c_mktsegment, 'AUTOMOBILE') AS c_mktsegment
 FROM customer)
"""


def dirty_customer(spark, d):
    c = load(spark, d, "customer")
    return c.select(
        "c_custkey", "c_name",
        F.when(F.col("c_acctbal") < 0, F.concat(F.lit("bad:"), F.col("c_custkey").cast("string")))
        .otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        F.col("c_nationkey").cast("string").alias("c_nationkey"),
        F.nullif(F.col("c_mktsegment"), F.lit("AUTOMOBILE")).alias("c_mktsegment"))


def customer_rules():
    return {
        "acctbal_not_numeric": C.cast_failed(F.col("c_acctbal"), F.col("c_acctbal").try_cast("double")),
        "nation_out_of_range": ~F.col("c_nationkey").try_cast("bigint").between(0, 24),
        "segment_missing": F.col("c_mktsegment").isNull(),
    }


RULES_SQL = """concat_ws(';',
  CASE WHEN c_acctbal IS NOT NULL AND TRY_CAST(c_acctbal AS DOUBLE) IS NULL THEN 'acctbal_not_numeric' END,
  CASE WHEN NOT (TRY_CAST(c_nationkey AS BIGINT) BETWEEN 0 AND 24) THEN 'nation_out_of_range' END,
  CASE WHEN c_mktsegment IS NULL THEN 'segment_missing' END)"""


@query("normalise_headers", "P1", """
SELECT p_partkey, p_name, p_brand AS p_brands, p_type AS " p type ", p_size, p_retailprice FROM part
""")
def q_normalise_headers(spark, d):
    p = load(spark, d, "part")
    dirty = p.toDF(" p_partkey ", '"p_name"', "p_brand's", "' p type '", "p_size\t", "p_retailprice")
    return C.normalise_headers(dirty)


@query("drop_surrogate", "P2", """
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part
""")
def q_drop_surrogate(spark, d):
    p = load(spark, d, "part")
    return C.drop_surrogate(p.withColumn("Serial No.", F.col("p_partkey") + 1))


@query("blind_projection", "P3", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_linestatus FROM lineitem
""")
def q_blind_projection(spark, d):
    li = load(spark, d, "lineitem").drop("l_shipdate")
    return C.blind_projection(li, "l_returnflag")


@query("contract_required", "P5", """
SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer
""")
def q_contract_required(spark, d):
    c = C.require_columns(load(spark, d, "customer"), CONTRACT)
    return c.select(*CONTRACT["required_columns"])


@query("contract_cast", "P6", f"""
SELECT c_custkey, TRY_CAST(c_acctbal AS DOUBLE) AS c_acctbal, TRY_CAST(c_nationkey AS BIGINT) AS c_nationkey,
       CAST(CAST(c_acctbal IS NOT NULL AND TRY_CAST(c_acctbal AS DOUBLE) IS NULL AS INTEGER)
          + CAST(c_nationkey IS NOT NULL AND TRY_CAST(c_nationkey AS BIGINT) IS NULL AS INTEGER)
          AS INTEGER) AS n_cast_errors
FROM {DIRTY_CUSTOMER_SQL}
""")
def q_contract_cast(spark, d):
    out = C.validate(dirty_customer(spark, d), CONTRACT)
    return out.select("c_custkey", "c_acctbal", "c_nationkey", F.size("_cast_errors").alias("n_cast_errors"))


@query("contract_violations", "P6", f"""
SELECT 'c_acctbal' AS col_name, 'double' AS dtype,
       count(*) FILTER (WHERE c_acctbal IS NOT NULL AND TRY_CAST(c_acctbal AS DOUBLE) IS NULL) AS n_violations
FROM {DIRTY_CUSTOMER_SQL}
UNION ALL
SELECT 'c_nationkey', 'bigint',
       count(*) FILTER (WHERE c_nationkey IS NOT NULL AND TRY_CAST(c_nationkey AS BIGINT) IS NULL)
FROM {DIRTY_CUSTOMER_SQL}
""")
def q_contract_violations(spark, d):
    return C.contract_violations(dirty_customer(spark, d), CONTRACT).withColumnRenamed("column", "col_name")


@query("quarantine_rows", "P9", f"""
SELECT c_custkey, CASE WHEN r = '' THEN 'valid' ELSE 'quarantine' END AS route, r AS reason
FROM (SELECT c_custkey, {RULES_SQL} AS r FROM {DIRTY_CUSTOMER_SQL})
""")
def q_quarantine_rows(spark, d):
    routed = C.quarantine_rows(dirty_customer(spark, d), customer_rules())
    return routed.select("c_custkey", F.col(C.ROUTE_COL).alias("route"),
                         F.array_join(F.array_sort(C.REASONS_COL), ";").alias("reason"))


@query("quarantine_chunks", "P9", f"""
WITH r AS (SELECT c_custkey, CAST(floor(c_custkey / 100) AS BIGINT) AS chunk_id, {RULES_SQL} <> '' AS bad
           FROM {DIRTY_CUSTOMER_SQL})
SELECT c_custkey, chunk_id,
       CASE WHEN bool_or(bad) OVER (PARTITION BY chunk_id) THEN 'quarantine' ELSE 'valid' END AS route
FROM r
""")
def q_quarantine_chunks(spark, d):
    dc = dirty_customer(spark, d).withColumn("chunk_id", F.floor(F.col("c_custkey") / 100).cast("long"))
    routed = C.quarantine_chunks(dc, customer_rules(), "chunk_id")
    return routed.select("c_custkey", "chunk_id", F.col(C.ROUTE_COL).alias("route"))


@query("etl_counts", "P9,G16", f"""
SELECT count(*) FILTER (WHERE r = '') AS processed, count(*) FILTER (WHERE r <> '') AS quarantined
FROM (SELECT {RULES_SQL} AS r FROM {DIRTY_CUSTOMER_SQL})
""")
def q_etl_counts(spark, d):
    return C.etl_counts(C.quarantine_rows(dirty_customer(spark, d), customer_rules()))


@query("dry_run_chunks", "P10,P11", f"""
WITH r AS (SELECT c_custkey, CAST(floor(c_custkey / 100) AS BIGINT) AS chunk_id, {RULES_SQL} AS rs
           FROM {DIRTY_CUSTOMER_SQL}),
     v AS (SELECT * FROM r WHERE rs = ''),
     per AS (SELECT chunk_id, count(*) AS n FROM v GROUP BY chunk_id),
     cum AS (SELECT chunk_id, coalesce(sum(n) OVER (ORDER BY chunk_id ROWS BETWEEN UNBOUNDED PRECEDING
                                                     AND 1 PRECEDING), 0) AS before FROM per)
SELECT c_custkey, chunk_id FROM v WHERE chunk_id IN (SELECT chunk_id FROM cum WHERE before < 300)
""")
def q_dry_run_chunks(spark, d):
    dc = dirty_customer(spark, d).withColumn("chunk_id", F.floor(F.col("c_custkey") / 100).cast("long"))
    routed = C.quarantine_rows(dc, customer_rules())
    return C.dry_run_chunks(routed, "chunk_id", 300).select("c_custkey", "chunk_id")


@query("text_coerce", "P14", """
SELECT doc_id, CAST(length(t) AS INTEGER) AS text_chars, CASE WHEN t IS NULL THEN 'quarantine' ELSE 'valid' END AS route
FROM (SELECT doc_id, CAST(CASE WHEN lang = 'de' THEN NULL ELSE text END AS VARCHAR) AS t FROM documents)
""")
def q_text_coerce(spark, d):
    from ..operators.text import coerce_text
    docs = load(spark, d, "documents").select(
        "doc_id", F.when(F.col("lang") == "de", F.lit(None)).otherwise(F.col("text")).alias("text"))
    routed = C.quarantine_rows(coerce_text(docs, "text"), {"text_missing": F.col("text").isNull()})
    return routed.select("doc_id", F.length("text").alias("text_chars"), F.col(C.ROUTE_COL).alias("route"))


# ---------------------------------------------------------------- audit/dedup

@query("drop_null_any", "P7", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
FROM (SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice,
             nullif(o_orderpriority, '1-URGENT') AS o_orderpriority FROM orders)
WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL
""")
def q_drop_null_any(spark, d):
    o = load(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"),
        "o_totalprice", F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("o_orderpriority"))
    return A.drop_null_any(o)


@query("drop_null_subset", "P8", """
SELECT d.doc_id, d.n_chars, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE d.text IS NOT NULL AND l.quality IS NOT NULL
""")
def q_drop_null_subset(spark, d):
    docs = load(spark, d, "documents").join(load(spark, d, "labels").select("doc_id", "quality"),
                                            "doc_id", "left")
    return A.drop_null_subset(docs, ["text", "quality"]).select("doc_id", "n_chars", "quality")


@query("first_seen_dedup", "W2", """
SELECT event_id, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events) WHERE rn = 1
""")
def q_first_seen_dedup(spark, d):
    ev = load(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    return A.first_seen_dedup(ev, "user_id", "event_id")


@query("first_seen_dedup_nulls", "W2", """
WITH e AS (SELECT event_id, CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_id END AS user_id FROM events)
SELECT min(event_id) AS event_id, user_id FROM e GROUP BY user_id
""")
def q_first_seen_dedup_nulls(spark, d):
    """A null key is a key like any other: its first row stays."""
    ev = load(spark, d, "events").select(
        "event_id", F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("user_id"))
    return A.first_seen_dedup(ev, "user_id", "event_id")


@query("duplicate_count", "W2,G5", """
SELECT user_id, count(*) AS n_rows, count(*) - 1 AS n_duplicates FROM events GROUP BY user_id
""")
def q_duplicate_count(spark, d):
    return A.duplicate_count(load(spark, d, "events"), "user_id")


BLOOM_N, BLOOM_P = 100, 0.01  # the saturated case: fewer bits than keys need
BLOOM_DESIGN = 10_000_000     # the reference's design size


def _bloom_sql(n_items: int = BLOOM_N) -> str:
    from ..functions.exprs import bloom_geometry, hex_mod_sql
    m, k = bloom_geometry(n_items, BLOOM_P)
    h1 = hex_mod_sql("md5(CAST(user_id AS VARCHAR))", m, 32)
    h2 = hex_mod_sql("sha1(CAST(user_id AS VARCHAR))", m, 40)
    return f"""
WITH firsts AS (SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id),
     h AS (SELECT user_id, event_id, {h1} AS h1, {h2} AS h2 FROM firsts),
     bits AS (SELECT DISTINCT user_id, event_id, (h1 + t.i * h2) % {m} AS bit FROM h, range({k}) t(i)),
     bf AS (SELECT bit, min(event_id) AS f FROM bits GROUP BY bit),
     w AS (SELECT b.user_id, b.event_id, max(bf.f) AS lf FROM bits b JOIN bf ON b.bit = bf.bit
           GROUP BY b.user_id, b.event_id),
     surv AS (SELECT user_id, event_id FROM w WHERE lf >= event_id)
SELECT e.event_id, e.user_id FROM events e JOIN surv s ON e.user_id = s.user_id AND e.event_id = s.event_id
"""


@query("bloom_dedup", "W1", _bloom_sql)
def q_bloom_dedup(spark, d):
    ev = load(spark, d, "events").select("event_id", "user_id")
    return A.bloom_dedup(ev, "user_id", "event_id", BLOOM_N, BLOOM_P)


@query("bloom_dedup_design", "W1", lambda: _bloom_sql(BLOOM_DESIGN))
def q_bloom_dedup_design(spark, d):
    """The filter at its design size, where it keeps the first row of nearly every key."""
    ev = load(spark, d, "events").select("event_id", "user_id")
    return A.bloom_dedup(ev, "user_id", "event_id", BLOOM_DESIGN, BLOOM_P)


@query("bloom_resume", "W1", _bloom_sql)
def q_bloom_resume(spark, d):
    """Two runs over the halves of the events, the second from the bits that the first has left."""
    from ..operators.bloom_state import BloomStore

    ev = load(spark, d, "events").select("event_id", "user_id")
    low, high = ev.agg(F.min("event_id"), F.max("event_id")).first()
    middle = 0 if low is None else (low + high) // 2
    store = BloomStore(spark, scratch_path(spark, "bloom"), BLOOM_N, BLOOM_P)
    first = store.dedup(ev.where(F.col("event_id") <= middle), "user_id", "event_id", run=1)
    second = store.dedup(ev.where(F.col("event_id") > middle), "user_id", "event_id", run=2, after=1)
    return first.unionByName(second)


@query("audit_summary", "G5", """
WITH e AS (SELECT event_id, user_id, nullif(event_type, 'error') AS event_type, value FROM events),
     c AS (SELECT * FROM e WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL
                               AND value IS NOT NULL),
     k AS (SELECT user_id, min(event_id) AS event_id FROM c GROUP BY user_id),
     n AS (SELECT (SELECT count(*) FROM e) AS t, (SELECT count(*) FROM c) AS nn, (SELECT count(*) FROM k) AS nk)
SELECT t AS total_rows, t - nn AS null_rows, nn - nk AS duplicates_dropped, t - nk AS total_dropped,
       CASE WHEN t > 0 THEN round(CAST(100 AS DOUBLE) * nk / t, 6) ELSE 0.0 END AS retention_pct
FROM n
""")
def q_audit_summary(spark, d):
    ev = load(spark, d, "events").select(
        "event_id", "user_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"), "value")
    return A.audit_summary(ev, "user_id", "event_id")


@query("chunk_numbering", "W3", """
SELECT event_id, CAST(floor((row_number() OVER (ORDER BY event_id) - 1) / 1000) AS BIGINT) AS chunk_id
FROM events
""")
def q_chunk_numbering(spark, d):
    from ..operators.ordering import chunk_numbers
    ev = load(spark, d, "events").select("event_id")
    return chunk_numbers(ev, "event_id", 1000)


@query("chunk_numbering_ties", "W3", """
SELECT event_id, CAST(floor((row_number() OVER (ORDER BY nullif(event_type, 'error') NULLS FIRST, event_id) - 1) / 700)
                      AS BIGINT) AS chunk_id
FROM events
""")
def q_chunk_numbering_ties(spark, d):
    """A text key with nulls and many ties, split over tasks."""
    from ..operators.ordering import chunk_numbers
    ev = load(spark, d, "events").select("event_id", F.nullif(F.col("event_type"), F.lit("error")).alias("kind"))
    return chunk_numbers(ev, "kind", 700, tiebreak=["event_id"]).select("event_id", "chunk_id")


@query("running_moments", "W4", """
WITH e AS (SELECT event_id, value,
                  CAST(floor((row_number() OVER (ORDER BY event_id) - 1) / 1000) AS BIGINT) AS chunk_id
           FROM events),
     mom AS (SELECT event_id, chunk_id, value, avg(value) OVER w AS mean, stddev_pop(value) OVER w AS sd
             FROM e WINDOW w AS (ORDER BY chunk_id RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT event_id, chunk_id,
       (round((value - mean) / CASE WHEN sd = 0 THEN 1.0 ELSE sd END, 6) + 0.0) AS value_scaled
FROM mom
""")
def q_running_moments(spark, d):
    from ..operators.features import scale_as_of_chunk
    from ..operators.ordering import chunk_numbers
    ev = chunk_numbers(load(spark, d, "events").select("event_id", "value"), "event_id", 1000)
    out = scale_as_of_chunk(ev, ["value"], "chunk_id")
    return out.select("event_id", "chunk_id", r6("value_scaled").alias("value_scaled"))
