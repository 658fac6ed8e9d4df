"""Registered queries: hashed bag of words, text scoring, PA step, drivers, alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import hex_mod_sql, r6, unit_hash_sql
from ..functions.text import TOKEN_PATTERN, default_stop_words
from ..llm.common import small_batches
from ..operators import labels as L
from ..operators import learners as LR
from ..operators import text as TX
from .fixtures import SEED, TEST_RATIO, TEXT_INTERCEPT, TEXT_WEIGHTS, lit_sql, load, r6_sql
from .registry import query

NF = TX.N_FEATURES


def _weights_values_sql() -> str:
    per: dict[int, float] = {}
    for w, v in TEXT_WEIGHTS.items():
        b = TX.bucket_of_py(w, NF)
        per[b] = per.get(b, 0.0) + float(v)
    rows = ", ".join(f"({b}, {lit_sql(v)})" for b, v in sorted(per.items()))
    return f"(SELECT * FROM (VALUES {rows}) v(bucket, w))"


BOW_CTE = f"""
WITH toks AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{TOKEN_PATTERN}')) AS tok FROM documents),
     cnt AS (SELECT doc_id, {hex_mod_sql('md5(tok)', NF, 32)} AS bucket, count(*) AS c FROM toks GROUP BY ALL),
     bow AS (SELECT doc_id, bucket, c / sqrt(sum(c * c) OVER (PARTITION BY doc_id)) AS value FROM cnt)"""

DECISION_CTE = BOW_CTE + f""",
     dots AS (SELECT doc_id, sum(value * w) AS dot FROM bow JOIN {_weights_values_sql()} wt USING (bucket)
              GROUP BY doc_id),
     dec AS (SELECT d.doc_id, {lit_sql(TEXT_INTERCEPT)} + coalesce(dots.dot, 0.0) AS decision
             FROM documents d LEFT JOIN dots ON d.doc_id = dots.doc_id)"""


def decisions(spark, d):
    small_batches(spark)
    docs = load(spark, d, "documents").select("doc_id", "text")
    return TX.linear_text_decision(docs, "text", TEXT_WEIGHTS, TEXT_INTERCEPT).drop("text")


TEST_DOC_SQL = f"{unit_hash_sql('doc_id', SEED)} < CAST({TEST_RATIO} AS DOUBLE)"


@query("hashed_bow", "M8", BOW_CTE + f"""
SELECT doc_id, bucket, {r6_sql('value')} AS value FROM bow
""")
def q_hashed_bow(spark, d):
    small_batches(spark)
    bow = TX.hashed_bow(load(spark, d, "documents"), "doc_id", "text")
    return bow.select("doc_id", "bucket", r6("value").alias("value"))


@query("score_text", "M12", DECISION_CTE + f"""
SELECT doc_id, CAST(decision > 0 AS INTEGER) AS predicted_sentiment, {r6_sql('abs(decision)')} AS confidence_score
FROM dec
""")
def q_score_text(spark, d):
    dec = decisions(spark, d)
    return dec.select("doc_id", (F.col("decision") > 0).cast("int").alias("predicted_sentiment"),
                      r6(F.abs("decision")).alias("confidence_score"))


@query("pa_update", "M9", DECISION_CTE + f""",
     sq AS (SELECT doc_id, sum(value * value) AS sq FROM bow GROUP BY doc_id),
     j AS (SELECT dec.doc_id, CAST(2 * l.quality - 1 AS DOUBLE) AS y, dec.decision, coalesce(sq.sq, 0.0) AS sq
           FROM dec JOIN labels l ON dec.doc_id = l.doc_id LEFT JOIN sq ON sq.doc_id = dec.doc_id)
SELECT doc_id, {r6_sql("CASE WHEN sq > 0 THEN least(1.0, greatest(0.0, 1.0 - y * decision) / sq) ELSE 0.0 END")} AS tau
FROM j
""")
def q_pa_update(spark, d):
    small_batches(spark)
    docs = load(spark, d, "documents").select("doc_id", "text")
    sq = F.aggregate(F.col("bow.value"), F.lit(0.0), lambda a, v: a + v * v)
    bags = TX.with_bow(docs, "text").select("doc_id", "bow")
    dec = TX.linear_bow_decision(bags, TEXT_WEIGHTS, TEXT_INTERCEPT).select("doc_id", "decision", sq.alias("sq"))
    lab = load(spark, d, "labels").select("doc_id", (F.col("quality") * 2 - 1).cast("double").alias("y"))
    j = dec.join(lab, "doc_id")
    tau = LR.pa_step_size(F.col("y"), F.col("decision"), F.col("sq"), 1.0)
    return j.select("doc_id", r6(tau).alias("tau"))


@query("priority_alerts", "O1,P16,S14", DECISION_CTE + f"""
SELECT doc_id, {r6_sql('abs(decision)')} AS conf FROM dec WHERE decision <= 0
ORDER BY abs(decision) DESC, doc_id LIMIT 200
""")
def q_priority_alerts(spark, d):
    dec = decisions(spark, d).withColumn("pred", (F.col("decision") > 0).cast("int")) \
        .withColumn("conf", F.abs("decision"))
    return TX.priority_alerts(dec, "pred", "conf", "doc_id", 200).select("doc_id", r6("conf").alias("conf"))


@query("text_eval_audit", "S13", DECISION_CTE + f"""
SELECT d.doc_id, d.text, l.quality AS true_label, CAST(dec.decision > 0 AS INTEGER) AS pred,
       {r6_sql('abs(dec.decision)')} AS conf
FROM documents d JOIN labels l ON d.doc_id = l.doc_id JOIN dec ON dec.doc_id = d.doc_id
WHERE {TEST_DOC_SQL.replace('doc_id', 'd.doc_id')}
""")
def q_text_eval_audit(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "text").where(L.holdout_flag("doc_id", TEST_RATIO, SEED))
    lab = load(spark, d, "labels").select("doc_id", F.col("quality").alias("true_label"))
    return TX.linear_text_decision(docs.join(lab, "doc_id"), "text", TEXT_WEIGHTS, TEXT_INTERCEPT).select(
        "doc_id", "text", "true_label", (F.col("decision") > 0).cast("int").alias("pred"),
        r6(F.abs("decision")).alias("conf"))


def _drivers_sql() -> str:
    stop = ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(set(default_stop_words())))
    return f"""
WITH d AS (SELECT d.doc_id, d.text, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id
           WHERE {TEST_DOC_SQL.replace('doc_id', 'd.doc_id')}),
     t AS (SELECT quality, list_filter(regexp_extract_all(lower(text), '{TOKEN_PATTERN}'),
                                       lambda x: NOT list_contains([{stop}], x)) AS toks FROM d),
     g AS (SELECT CASE quality WHEN 1 THEN 'Positive_Drivers' WHEN 0 THEN 'Negative_Drivers' END AS Segment,
                  unnest(toks || list_transform(range(1, len(toks)), lambda i: toks[i] || ' ' || toks[i + 1])) AS Phrase
           FROM t),
     c AS (SELECT Segment, Phrase, count(*) AS Frequency FROM g WHERE Segment IS NOT NULL GROUP BY ALL)
SELECT Segment, Phrase, Frequency FROM (
  SELECT *, row_number() OVER (PARTITION BY Segment ORDER BY Frequency DESC, Phrase) AS r FROM c) WHERE r <= 20
"""


@query("phrase_drivers", "G13,O2,P18", _drivers_sql)
def q_phrase_drivers(spark, d):
    docs = load(spark, d, "documents").join(load(spark, d, "labels").select("doc_id", "quality"), "doc_id")
    test = docs.where(L.holdout_flag("doc_id", TEST_RATIO, SEED))
    return TX.phrase_drivers(test, "text", "quality", top_n=20)
