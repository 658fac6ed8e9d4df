"""Registered queries: CSV sources and sinks, inventory, manifests, model store.

CSV inputs are produced by the query itself from a driver table, written
under the shared checkpoint folder and read back, so the oracle is the table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import NULL_TOKENS, r6
from ..operators import contract as C
from ..operators import features as FE
from ..sources import csv as CSV
from ..sources import inventory as INV
from ..sources import models as MS
from ..session import scratch_path
from .catalog_clean import DIRTY_CUSTOMER_SQL, RULES_SQL, customer_rules, dirty_customer
from .fixtures import BINARY_FEATURES, binary_members, lit_sql, load, r6_sql
from .registry import query


def _cast(df, types: dict):
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


@query("scan_csv_roundtrip", "S1", """
SELECT c_custkey, c_name || ', "' || c_mktsegment || '"' || chr(10) || 'second line' AS c_note,
       c_nationkey, c_acctbal, c_mktsegment FROM customer
""")
def q_scan_csv_roundtrip(spark, d):
    c = load(spark, d, "customer")
    note = F.concat(F.col("c_name"), F.lit(', "'), F.col("c_mktsegment"), F.lit('"\nsecond line'))
    src = c.select("c_custkey", note.alias("c_note"), "c_nationkey", "c_acctbal", "c_mktsegment")
    path = CSV.write_csv(src, scratch_path(spark, "s1"))
    back = CSV.read_csv(spark, path, multiline=True)
    return _cast(back, {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double"})


@query("scan_csv_preamble", "S2", """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
""")
def q_scan_csv_preamble(spark, d):
    s = load(spark, d, "supplier")
    path = CSV.write_csv_with_preamble(s, scratch_path(spark, "s2"), "Exported supplier ledger, page 1")
    back = CSV.read_csv_preamble(spark, path)
    return _cast(back, {"s_suppkey": "bigint", "s_nationkey": "int", "s_acctbal": "double"})


@query("row_identity", "S3", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_index FROM orders
""")
def q_row_identity(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    path = CSV.write_csv(o, scratch_path(spark, "s3"), order_by=["o_orderkey"])
    back = CSV.with_file_row_index(CSV.read_csv(spark, path, multiline=False))
    return back.select(F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"), "row_index")


FILES, BATCH, CAP, IN_FLIGHT = 24, 50, 300, 6


def _dry_run_sql(in_flight: int) -> str:
    return f"""
WITH r AS (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // {BATCH} AS chunk_id,
                  o_orderstatus <> 'P' AS ok FROM orders),
     per AS (SELECT chunk_id, count(*) FILTER (ok) AS n FROM r GROUP BY chunk_id),
     cum AS (SELECT chunk_id, sum(n) OVER (ORDER BY chunk_id) AS upto FROM per),
     met AS (SELECT min(chunk_id) AS c FROM cum WHERE upto >= {CAP})
SELECT o_orderkey, chunk_id FROM r, met WHERE ok AND (c IS NULL OR chunk_id <= c + {in_flight})
"""


def _dry_run(spark, d, in_flight):
    """A dry run over order files, of which only the first ones are read."""
    from ..operators.dry_run import dry_run_files

    orders = load(spark, d, "orders").select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"))
    path = scratch_path(spark, "p10")
    orders.repartitionByRange(FILES, "o_orderkey").sortWithinPartitions("o_orderkey").write.option("header", True).csv(path)
    files = spark.read.csv(path).inputFiles()

    def read(some):
        return CSV.read_csv(spark, some, orders.columns)

    run = dry_run_files(read, files, {"no status": F.col("o_orderstatus").isNull()}, BATCH, CAP, in_flight)
    return run.rows.select(F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"), "chunk_id")


@query("dry_run_early", "P10", _dry_run_sql(0))
def q_dry_run_early(spark, d):
    return _dry_run(spark, d, 0)


@query("dry_run_in_flight", "P11", _dry_run_sql(IN_FLIGHT))
def q_dry_run_in_flight(spark, d):
    return _dry_run(spark, d, IN_FLIGHT)


GUARDED = 6


@query("files_without_target", "P4", f"""
WITH o AS (SELECT *, CAST(least((o_orderkey - lo) // ((hi - lo) // {GUARDED} + 1), {GUARDED - 1}) AS BIGINT) AS part
           FROM orders, (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders))
SELECT 'row' AS kind, o_orderkey AS id, o_orderstatus AS target, o_totalprice AS price FROM o WHERE part NOT IN (1, 4)
UNION ALL SELECT 'skipped', part, 'o_orderstatus', NULL FROM o WHERE part IN (1, 4) GROUP BY part
""")
def q_files_without_target(spark, d):
    """Order files of which two lack the target column, and one has its columns in another order."""
    orders = load(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    low, high = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    part = F.least(F.floor((F.col("o_orderkey") - low) / ((high - low) // GUARDED + 1)), F.lit(GUARDED - 1)).cast("int")
    path = scratch_path(spark, "p4")
    for i in range(GUARDED):
        columns = ["o_totalprice", " o_orderkey "] if i in (1, 4) else ["o_totalprice", "o_orderstatus", "o_orderkey"] if i == 2 else orders.columns
        rows = orders.where(part == i).withColumn(" o_orderkey ", F.col("o_orderkey")).select(*columns)
        rows.write.option("header", True).csv(f"{path}/part-{i}")
    kept, skipped = CSV.read_csv_with(spark, f"{path}/*", ["o_orderkey", "o_orderstatus"])
    rows = kept.select(F.lit("row").alias("kind"), F.col("o_orderkey").try_cast("bigint").alias("id"),
                       F.col("o_orderstatus").alias("target"), F.col("o_totalprice").try_cast("double").alias("price"))
    gone = skipped.groupBy(F.regexp_extract("file", r"/part-(\d)/", 1).cast("bigint").alias("id"), F.array_join("missing", ",").alias("target")).agg(
        F.lit("skipped").alias("kind"), F.lit(None).cast("double").alias("price"))
    return rows.unionByName(gone)


@query("csv_bad_line_skip", "S4", """
SELECT p_partkey, p_name, CASE WHEN p_size < 5 THEN NULL ELSE p_size END AS p_size FROM part WHERE p_size <= 45
""")
def q_csv_bad_line_skip(spark, d):
    p = load(spark, d, "part")
    line = (F.when(F.col("p_size") > 45, F.concat_ws(",", "p_partkey", "p_name", "p_size", F.lit("surplus")))
            .when(F.col("p_size") < 5, F.concat_ws(",", "p_partkey", "p_name"))
            .otherwise(F.concat_ws(",", "p_partkey", "p_name", "p_size")))
    lines = p.select(line.alias("value"))
    path = scratch_path(spark, "s4")

    def add_head(batches):
        import pandas as pd
        yield pd.DataFrame({"value": ["p_partkey,p_name,p_size"]})
        yield from batches

    lines.mapInPandas(add_head, "value string").write.mode("overwrite").text(path)
    back = CSV.read_csv_skip_bad_lines(spark, path)
    return _cast(back, {"p_partkey": "bigint", "p_size": "int"})


@query("null_tokens", "S5", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer
""")
def q_null_tokens(spark, d):
    c = load(spark, d, "customer")
    toks = F.array(*[F.lit(t) for t in NULL_TOKENS])
    tok = F.element_at(toks, (F.pmod(F.col("c_custkey"), F.lit(len(NULL_TOKENS))) + 1).cast("int"))
    src = c.select("c_custkey", F.when(F.col("c_acctbal") < 0, tok).otherwise(F.col("c_mktsegment"))
                   .alias("c_mktsegment"))
    path = CSV.write_csv(src, scratch_path(spark, "s5"))
    back = CSV.normalise_null_tokens(CSV.read_csv(spark, path))
    return _cast(back, {"c_custkey": "bigint"})


@query("etl_sink_roundtrip", "S6,S9,P3,O5", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
""")
def q_etl_sink_roundtrip(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                        "o_orderpriority")
    etl = C.blind_projection(o, "o_orderstatus")
    contract = {"required_columns": ["o_orderkey", "o_totalprice"], "dtypes": {"o_totalprice": "float64"}}
    etl = C.validate(etl, contract).drop("_cast_errors")
    path = scratch_path(spark, "s6")
    CSV.write_csv(etl, path, order_by=["o_orderkey"])
    CSV.write_csv(etl, path, order_by=["o_orderkey"])  # rerun: overwrite purges, no duplicates
    back = CSV.read_csv(spark, path)
    return _cast(back, {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"})


@query("float_format_sink", "S7", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber IN (2, 3) THEN NULL ELSE printf('%.8f', l_extendedprice * (1 - l_discount)) END AS revenue
FROM lineitem
""")
def q_float_format_sink(spark, d):
    li = load(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",  # null and NaN are both written as an empty field
        F.when(F.col("l_linenumber") == 2, F.lit(float("nan"))).when(
            F.col("l_linenumber") != 3, F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    path = CSV.write_csv(li, scratch_path(spark, "s7"), float_format="%.8f")
    back = CSV.read_csv(spark, path)
    return _cast(back, {"l_orderkey": "bigint", "l_linenumber": "int"})


@query("dlq_rows", "S8,P9", f"""
SELECT c_custkey, r AS reason FROM (SELECT c_custkey, {RULES_SQL} AS r FROM {DIRTY_CUSTOMER_SQL}) WHERE r <> ''
""")
def q_dlq_rows(spark, d):
    routed = C.quarantine_rows(dirty_customer(spark, d), customer_rules())
    path = CSV.write_csv(C.quarantine_branch(routed), scratch_path(spark, "s8"))
    back = CSV.read_csv(spark, path)
    return back.select(F.col("c_custkey").try_cast("bigint").alias("c_custkey"), "reason")


# ---------------------------------------------------------------- inventory

LISTING_SQL = """
(SELECT source AS job_id, lang || '/part-' || source || '.txt' AS path, CAST(sum(n_chars) AS BIGINT) AS size_bytes
 FROM documents GROUP BY source, lang
 UNION ALL
 SELECT DISTINCT source AS job_id, '_SUCCESS' AS path, CAST(0 AS BIGINT) AS size_bytes FROM documents)
"""


def doc_listing(spark, d):
    """A job-output listing derived from ``documents``: one shard file per
    (source, lang) with the summed size, plus each job's empty _SUCCESS marker."""
    docs = load(spark, d, "documents")
    shards = docs.groupBy("source", "lang").agg(F.sum("n_chars").alias("size_bytes")).select(
        F.col("source").alias("job_id"),
        F.concat(F.col("lang"), F.lit("/part-"), F.col("source"), F.lit(".txt")).alias("path"), "size_bytes")
    markers = docs.select(F.col("source").alias("job_id")).distinct().select(
        "job_id", F.lit("_SUCCESS").alias("path"), F.lit(0).cast("long").alias("size_bytes"))
    return shards.unionByName(markers)


@query("file_status", "P17,O4", f"""
SELECT job_id, path, size_bytes, CASE WHEN size_bytes = 0 THEN 'CORRUPT (0 Bytes)' ELSE 'VALID' END AS status
FROM {LISTING_SQL}
""")
def q_file_status(spark, d):
    return INV.file_status(doc_listing(spark, d))


@query("manifest_json", "S16", f"""
WITH st AS (SELECT job_id, path, size_bytes,
                   CASE WHEN size_bytes = 0 THEN 'CORRUPT (0 Bytes)' ELSE 'VALID' END AS status FROM {LISTING_SQL}),
     per AS (SELECT job_id,
                    list({{'path': path, 'size_bytes': size_bytes, 'status': status}} ORDER BY path) AS files,
                    coalesce(list(CASE WHEN size_bytes = 0 THEN split_part(path, '/', -1) END ORDER BY path)
                             FILTER (WHERE size_bytes = 0), []) AS integrity_warnings
             FROM st GROUP BY job_id)
SELECT job_id, CAST(to_json({{'job_id': job_id, 'files': files, 'integrity_warnings': integrity_warnings}})
                    AS VARCHAR) AS manifest
FROM per
""")
def q_manifest_json(spark, d):
    return INV.manifest(doc_listing(spark, d))


REQUIRED_ASSETS = ["_SUCCESS", "forensic_audit.log", "part-src0.txt"]


@query("missing_assets", "U2", f"""
WITH l AS {LISTING_SQL},
     jobs AS (SELECT DISTINCT job_id FROM l),
     req AS (SELECT job_id, unnest({REQUIRED_ASSETS!r}) AS name FROM jobs),
     found AS (SELECT DISTINCT job_id, split_part(path, '/', -1) AS name FROM l)
SELECT job_id, name FROM req WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.job_id = req.job_id AND f.name = req.name)
""")
def q_missing_assets(spark, d):
    return INV.missing_assets(doc_listing(spark, d), REQUIRED_ASSETS)


@query("union_chunks", "U1", """
SELECT c_custkey, c_name, c_acctbal, CAST(NULL AS INTEGER) AS c_nationkey FROM customer
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
UNION ALL
SELECT c_custkey, c_name, NULL, c_nationkey FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
""")
def q_union_chunks(spark, d):
    c = load(spark, d, "customer")
    first = c.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", "c_name", "c_acctbal")
    rest = c.where(~F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", "c_name",
                                                                                   "c_nationkey")
    return first.unionByName(rest, allowMissingColumns=True)


@query("file_inventory", "S15", """
SELECT 'source=' || source || '/lang=' || lang || '/group=' || CAST(doc_id // 50 AS VARCHAR) AS folder,
       CAST(sum(coalesce(octet_length(encode(text)), 0) + 1) AS BIGINT) AS size_bytes, 'VALID' AS status
FROM documents GROUP BY source, lang, doc_id // 50
UNION ALL SELECT '', 0, 'CORRUPT (0 Bytes)'
""")
def q_file_inventory(spark, d):
    """Every file of a tree that is four levels deep, with its size; the mark of success is empty."""
    docs = load(spark, d, "documents").select("source", "lang", F.expr("doc_id div 50").alias("group"), "text")
    root = INV.write_tree(docs, scratch_path(spark, "s15"), ["source", "lang", "group"], "text")
    files = INV.file_status(INV.list_files(spark, [root])).where(~F.col("path").rlike(r"(^|/)\.[^/]*$"))  # hidden: checksums of some stores, what a lost attempt left
    return files.select(F.regexp_replace("path", "/?[^/]*$", "").alias("folder"), "size_bytes", "status")


@query("inventory_counts", "S15,P17", """
SELECT source, 'VALID' AS status, count(DISTINCT lang) AS n_files FROM documents GROUP BY source
""")
def q_inventory_counts(spark, d):
    """One file per source and language, counted by folder and status."""
    docs = load(spark, d, "documents").select("source", "lang", "text")
    root = scratch_path(spark, "s15-counts")
    docs.repartition("source", "lang").write.mode("overwrite").partitionBy("source", "lang").text(root)
    files = INV.file_status(INV.list_files(spark, [root])).where(F.col("path").rlike(r"part-[^/]*\.txt$"))
    return files.groupBy(F.regexp_extract("path", "source=([^/]*)/", 1).alias("source"), "status").agg(
        F.count(F.lit(1)).alias("n_files"))


@query("manifest_rows", "S16", """
SELECT source AS job_id, 'doc-' || CAST(doc_id AS VARCHAR) AS path, n_chars AS size_bytes,
       CASE WHEN n_chars = 0 THEN 'CORRUPT (0 Bytes)' ELSE 'VALID' END AS status,
       CASE WHEN n_chars = 0 THEN 'doc-' || CAST(doc_id AS VARCHAR) END AS warning
FROM (SELECT source, doc_id, CASE WHEN doc_id % 9 = 0 THEN 0 ELSE n_chars END AS n_chars FROM documents)
""")
def q_manifest_rows(spark, d):
    """A written manifest read back, its files as rows."""
    listing = load(spark, d, "documents").select(
        F.col("source").alias("job_id"), F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("path"),
        F.when(F.col("doc_id") % 9 == 0, F.lit(0)).otherwise(F.col("n_chars")).alias("size_bytes"))
    return spark.read.parquet(INV.write_manifest(listing, scratch_path(spark, "s16-rows")))


# ---------------------------------------------------------------- model store


@query("latest_model", "S11,S10", "SELECT member, feature, " + r6_sql("mean") + " AS mean, " + r6_sql("scale")
       + " AS scale, " + r6_sql("coef") + " AS coef FROM (" + " UNION ALL ".join(
           f"SELECT '0' AS member, '{f}' AS feature, avg({f}) AS mean, "
           f"CASE WHEN stddev_pop({f}) = 0 THEN 1.0 ELSE stddev_pop({f}) END AS scale, {lit_sql(c)} AS coef "
           f"FROM lineitem" for f, c in zip(BINARY_FEATURES, binary_members()[1]["coef"], strict=True))
       + f" UNION ALL SELECT '0', '_intercept', NULL, NULL, {lit_sql(binary_members()[1]['intercept'])})")
def q_latest_model(spark, d):
    li = load(spark, d, "lineitem")
    path = scratch_path(spark, "s10")
    train = li.where(F.col("l_returnflag") != "R")
    for run, ts, frame, member in (("r1", "2024-01-01 00:00:00", train, 0),
                                   ("r2", "2024-06-01 00:00:00", li, 1)):
        mom = FE.collect_moments(FE.feature_moments(frame, BINARY_FEATURES))
        MS.write_params(spark, path, run, ts, MS.param_rows(binary_members()[member], mom))
    latest = MS.latest_params(spark, path)
    MS.check_engine_version(latest)
    return latest.select("member", "feature", r6("mean").alias("mean"), r6("scale").alias("scale"),
                         r6("coef").alias("coef"))
