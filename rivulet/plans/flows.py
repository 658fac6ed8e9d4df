"""The four end-to-end flows of the reference, wired from the operators.

Each flow: read -> audit once (null drop + first-seen dedup) -> key-hash
holdout -> (scale / kernel / hash) -> fit (batch solver, or incremental
passes) -> score the held-out rows -> metrics.  Cleaning happens once and the
cleaned split is persisted before any iterative work (the reference re-parsed
and re-audited per epoch).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import N_HASH_FEATURES
from ..functions.exprs import linear, sigmoid
from ..operators import audit as A
from ..operators import contract as C
from ..operators import features as FE
from ..operators import labels as L
from ..operators import learners as LR
from ..operators import metrics as M
from ..operators import scoring as S
from ..operators import text as TX
from ..session import materialize
from ..sources import models as MS
from ..sources.csv import with_file_row_index, write_csv
from .fixtures import BINARY_FEATURES, SEED, TEST_RATIO, binary_label, lineitem_key, load


def credit_flow(spark: SparkSession, sf_dir: str, n_components: int = 16, n_members: int = 7,
                gamma: float = 0.1, max_iter: int = 100) -> tuple[DataFrame, list[dict]]:
    """Binary, class-weighted: scaler -> RBF Nystroem map -> soft-voting ensemble.

    Returns the scored held-out rows ``(label, probability)`` and the members.
    """
    raw = load(spark, sf_dir, "lineitem").select(
        lineitem_key().alias("key"), binary_label().alias("label"), *BINARY_FEATURES)
    seq = with_file_row_index(raw, "seq")                       # file order = the reference's stream order
    clean = A.audit(seq, "key", "seq")                          # nulls, then first-seen dedup by key
    weighted = L.weight_column(clean, "label", "cw")
    split = L.holdout_hash(weighted, "key", TEST_RATIO, SEED).persist()
    try:
        train = split.where(~F.col("is_test"))
        mom = FE.collect_moments(FE.feature_moments(train, BINARY_FEATURES))
        scaled = FE.standard_scale(split, mom)
        basis = FE.select_basis(scaled.where(~F.col("is_test")), "key", BINARY_FEATURES, n_components, SEED)
        mapped = FE.nystroem_map(scaled, BINARY_FEATURES, basis, gamma)
        comps = [f"phi{j}" for j in range(len(basis))]
        mapped = mapped.select("key", "label", "cw", "is_test",
                               *[F.col("phi")[j].alias(c) for j, c in enumerate(comps)])
        members = LR.fit_ensemble(mapped.where(~F.col("is_test")), comps, "label", "key",
                                  n_members=n_members, weight_col="cw", seed=SEED, max_iter=max_iter)
        test = mapped.where(F.col("is_test"))
        probs = [sigmoid(linear(m["features"], m["coef"], m["intercept"])) for m in members]
        # written while the split is cached, so that evaluating the scores recomputes nothing
        scored = materialize(test.select("key", "label", S.soft_vote(probs).alias("probability")), "scored")
        return scored, members
    finally:
        split.unpersist()


def credit_flow_metrics(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """``(metric, value)`` rows of the credit flow's held-out evaluation:
    n_test, accuracy, weighted precision/recall/F1 and ROC AUC.

    Training runs eagerly (it must); the evaluation is returned lazily as a
    union of one-row aggregates, so the caller's action computes it.
    """
    scored, _ = credit_flow(spark, sf_dir, **kw)
    scored = scored.withColumn("pred", L.decide("probability"))
    weighted = M.metrics_long(M.weighted_metrics_rows(scored, "label", "pred"))
    auc = M.metrics_long(M.roc_auc(scored, "label", "probability").withColumnRenamed("auc", "auc_roc"))
    n = M.metrics_long(scored.agg(F.count(F.lit(1)).alias("n_test")))
    return n.unionByName(weighted).unionByName(auc)


def score_stored(df: DataFrame, path: str, out_col: str = "probability") -> DataFrame:
    """Score with the latest stored run: its scaler, then the mean of its members' probabilities."""
    params = MS.latest_params(df.sparkSession, path)
    MS.check_engine_version(params)
    members = list(MS.to_models(params).values())
    return S.score_binary(df, members, out_col, scaler=members[0]["scaler"] or None)


def etl_flow(df: DataFrame, contract: dict, rules: dict, out_dir: str, surrogate: str | None = None,
             target: str | None = None) -> dict[str, str | DataFrame]:
    """Generate scoring input: headers, surrogate and label dropped, contract, routing, two sinks, counts.

    ``contract`` names the required columns and types, ``rules`` the failure
    predicates of a row after the cast.  Returns the paths of the valid and of
    the dead-letter rows and the ``(processed, quarantined)`` counts.
    """
    cleaned = C.normalise_headers(df)
    if surrogate:
        cleaned = C.drop_surrogate(cleaned, surrogate)
    if target:
        cleaned = C.blind_projection(cleaned, target)
    checked = C.validate(cleaned, contract, tolerate=[target] if target else [])
    rules = {"cast": F.size("_cast_errors") > 0, **rules}
    routed = materialize(C.quarantine_rows(checked, rules).drop("_cast_errors"), "etl")
    valid = write_csv(C.valid_branch(routed), f"{out_dir.rstrip('/')}/valid")
    dead = write_csv(C.quarantine_branch(routed), f"{out_dir.rstrip('/')}/dead_letter")
    return {"valid": valid, "dead_letter": dead, "counts": C.etl_counts(routed)}


def write_reports(reports: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    """Report sinks: each report DataFrame to ``out_dir/<name>`` as CSV (overwrite)."""
    return {name: write_csv(df, f"{out_dir.rstrip('/')}/{name}") for name, df in reports.items()}


def text_flow(spark: SparkSession, sf_dir: str, epochs: int = 5) -> dict[str, DataFrame]:
    """Text sentiment: hashed bag of words -> Passive-Aggressive (incremental) ->
    audit report, metrics, priority alerts and phrase drivers."""
    docs = A.drop_null_subset(load(spark, sf_dir, "documents").join(
        load(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id"), ["text", "quality"])
    docs = L.holdout_hash(docs, "doc_id", TEST_RATIO, SEED)
    train = TX.with_bow(docs.where(~F.col("is_test")), "text").select("doc_id", "bow", "quality")
    weights = LR.fit_passive_aggressive(train, None, "doc_id", "quality", epochs=epochs).toPandas()  # the model
    dense = np.zeros(N_HASH_FEATURES)
    words = weights[weights["bucket"] >= 0]
    dense[words["bucket"]] = words["weight"]
    intercept = float(weights.loc[weights["bucket"] == -1, "weight"].sum())
    test = docs.where(F.col("is_test")).select("doc_id", "text", F.col("quality").alias("true"))
    test = TX.linear_text_decision(test, "text", dense, intercept)
    test = test.withColumn("pred", (F.col("decision") > 0).cast("int")).withColumn("conf", F.abs("decision"))
    metrics = M.weighted_metrics_rows(test, "true", "pred")
    auc = M.roc_auc(test, "true", "decision").select(F.coalesce("auc", F.lit(0.0)).alias("auc"))  # one class: 0
    return {"auc": auc, "audit": test.select("text", "true", "pred", "conf"),
            "metrics": metrics,
            "alerts": TX.priority_alerts(test, "pred", "conf", "doc_id"),
            "drivers": TX.phrase_drivers(test, "text", "true")}


def admissions_flow(spark: SparkSession, sf_dir: str, threshold: float = 1500.0) -> DataFrame:
    """Regression + thresholded classification metrics (part price on size)."""
    p = load(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"),
                                           "p_retailprice")
    p = L.holdout_hash(A.drop_null_any(p), "p_partkey", TEST_RATIO, SEED)
    model = LR.fit_linear(p.where(~F.col("is_test")), ["p_size"], "p_retailprice")
    test = S.score_regression(p.where(F.col("is_test")), model, "pred")
    reg = M.regression_metrics(test, "p_retailprice", "pred")
    cls = M.binary_metrics(test.select(L.binarise("p_retailprice", threshold).alias("t"),
                                       L.binarise("pred", threshold).alias("p")), "t", "p")
    auc = M.roc_auc(test.withColumn("t", L.binarise("p_retailprice", threshold)), "t", "pred")  # one class: null
    return reg.unionByName(cls, allowMissingColumns=True).unionByName(auc, allowMissingColumns=True)


def student_flow(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Multi-class one-vs-rest: class domain -> scaler -> OvR fits -> confusion,
    weighted metrics and log loss on held-out rows."""
    li = load(spark, sf_dir, "lineitem").select(lineitem_key().alias("key"), "l_returnflag", *BINARY_FEATURES)
    li = L.holdout_hash(A.drop_null_any(li), "key", TEST_RATIO, SEED)
    classes = L.collect_classes(li, "l_returnflag")
    mom = FE.collect_moments(FE.feature_moments(li.where(~F.col("is_test")), BINARY_FEATURES))
    scaled = FE.standard_scale(li, mom)
    models = LR.fit_ovr(scaled.where(~F.col("is_test")), BINARY_FEATURES, "l_returnflag", classes)
    test = S.ovr_probabilities(scaled.where(F.col("is_test")), classes, models)
    pt = None
    for c in classes:
        pt = F.when(F.col("l_returnflag") == c, F.col(f"p_{c}")) if pt is None else \
            pt.when(F.col("l_returnflag") == c, F.col(f"p_{c}"))
    test = test.withColumn("p_true", pt)
    cm = M.confusion_matrix(test, "l_returnflag", "predicted", classes)
    return {"confusion": cm, "metrics": M.weighted_metrics(cm), "log_loss": M.log_loss(test, "p_true")}
