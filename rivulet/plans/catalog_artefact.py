"""Registered queries: whole model artefacts, stored, found again and scored.

Each model is stored twice, an older run with other weights first; the queries
load the latest run and score with what the row holds.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions.constants import ALPHA
from ..functions.exprs import r6
from ..operators import features as FE
from ..operators import incremental as IN
from ..session import scratch_path
from ..sources import artefacts as AR
from .catalog_learn import scaled_train
from .catalog_model import OVR_CONF_SQL, OVR_PRED_SQL, moments_sql, ovr_base_sql, scaled_select_sql, train_rows
from .catalog_train import EPOCHS, RATE, SCALED_ROWS_SQL, resumed, trace_sql
from .fixtures import (BINARY_FEATURES, MULTI_CLASSES, REGRESSION, lit_sql, load, ovr_models, r6_sql, sigmoid_sql)
from .registry import query

GAMMA = 0.1
# A kernel of our own: basis rows, normaliser and members follow a rule, so that SQL can repeat them.
BASIS = [[0.5 * ((3 * i + 2 * j) % 5) - 1.0 for j in range(len(BINARY_FEATURES))] for i in range(6)]
NORMALISER = [[(1.5 if i == j else 0.0) - 0.1 * ((i * j + i) % 3) for j in range(6)] for i in range(6)]
COMPONENTS = [f"phi{i}" for i in range(6)]
STORED = "2024-06-01 08:30:00"


def credit_members(shift: float = 0.0) -> list[dict]:
    return [{"features": COMPONENTS, "coef": [0.4 - 0.1 * i + 0.05 * m + shift for i in range(6)], "intercept": 0.2 * m - 0.3}
            for m in range(3)]


def _store(spark, name: str, artefact) -> str:
    """A folder with two runs of a model, the later one being the model asked for."""
    path = scratch_path(spark, name)
    AR.save(spark, f"{path}/runs", artefact(True), "run-2", STORED)
    AR.save(spark, f"{path}/runs", artefact(False), "run-1", "2024-01-01 00:00:00")
    return path


def _credit_sql() -> str:
    rows = f"SELECT l.l_orderkey, l.l_linenumber, {scaled_select_sql()} FROM lineitem l, {moments_sql()} m"
    members = [sigmoid_sql(" + ".join([lit_sql(m["intercept"])] + [f"{lit_sql(c)} * {f}" for f, c in zip(m["features"], m["coef"], strict=True)]))
               for m in credit_members()]
    return f"""
WITH f AS ({_phi_sql(rows, ['l_orderkey', 'l_linenumber'])}),
     p AS (SELECT l_orderkey, l_linenumber, ({' + '.join(members)}) / {lit_sql(len(members))} AS p FROM f)
SELECT l_orderkey, l_linenumber, {r6_sql('p')} AS probability, CAST(p >= 0.45 AS INTEGER) AS predicted FROM p
"""


@query("artefact_credit", "S10,S11,M11", _credit_sql)
def q_artefact_credit(spark, d):
    """Scaler, kernel and soft-voting members from one stored row."""
    mom = FE.collect_moments(FE.feature_moments(train_rows(spark, d), BINARY_FEATURES))
    kernel = {"gamma": GAMMA, "features": BINARY_FEATURES, "basis": BASIS, "normaliser": NORMALISER}
    path = _store(spark, "credit", lambda right: AR.Artefact(
        "credit", AR.ENSEMBLE, credit_members(0.0 if right else 0.7), mom, kernel, threshold=0.45))
    out = AR.score(load(spark, d, "lineitem"), AR.load(spark, path, "credit"))
    return out.select("l_orderkey", "l_linenumber", r6("probability").alias("probability"), "predicted")


@query("artefact_student", "S10,S11,M14", ovr_base_sql() + f"""
SELECT l_orderkey, l_linenumber, {OVR_PRED_SQL} AS predicted, {r6_sql(OVR_CONF_SQL)} AS confidence FROM p
""")
def q_artefact_student(spark, d):
    """A one-vs-rest model with its class list."""
    models = ovr_models()

    def artefact(right):
        order = MULTI_CLASSES if right else MULTI_CLASSES[::-1]
        return AR.Artefact("student", AR.ONE_VS_REST, [models[c] for c in MULTI_CLASSES], classes=order)

    out = AR.score(load(spark, d, "lineitem"), AR.load(spark, _store(spark, "student", artefact), "student"))
    return out.select("l_orderkey", "l_linenumber", "predicted", r6("confidence").alias("confidence"))


@query("artefact_admissions", "S10,S11,M13", f"""
SELECT p_partkey, {r6_sql(f"{lit_sql(REGRESSION['intercept'])} + {lit_sql(REGRESSION['coef'][0])} * p_size")} AS predicted,
       CAST({lit_sql(REGRESSION['intercept'])} + {lit_sql(REGRESSION['coef'][0])} * p_size > 1500 AS INTEGER) AS above FROM part
""")
def q_artefact_admissions(spark, d):
    """A regression with the threshold of its decision."""
    path = _store(spark, "admissions", lambda right: AR.Artefact(
        "admissions", AR.REGRESSION, [REGRESSION if right else REGRESSION | {"intercept": 0.0}], threshold=1500.0))
    out = AR.score(load(spark, d, "part"), AR.load(spark, path, "admissions"))
    return out.select("p_partkey", r6("predicted").alias("predicted"), "above")


@query("artefact_stamp", "S10,S11", "SELECT feature, " + r6_sql("mean") + " AS mean, " + r6_sql("scale") + f""" AS scale,
       'run-2' AS run_id, '{STORED}' AS created_at, 'ensemble' AS mode, true AS same_engine, true AS later_than_stored FROM ("""
       + " UNION ALL ".join(f"SELECT '{f}' AS feature, {f}_mean AS mean, {f}_scale AS scale FROM {moments_sql()}" for f in BINARY_FEATURES) + ")")
def q_artefact_stamp(spark, d):
    """The stored scaler and stamp of the latest run; a run stamped by the clock is later still."""
    mom = FE.collect_moments(FE.feature_moments(train_rows(spark, d), BINARY_FEATURES))

    def artefact(right):
        return AR.Artefact("credit", AR.ENSEMBLE, [{"features": BINARY_FEATURES, "coef": [0.0] * 4, "intercept": 0.0}],
                           mom if right else {f: (0.0, 1.0) for f in mom})

    path = _store(spark, "stamp", artefact)
    found = AR.load(spark, path, "credit")
    AR.save(spark, f"{path}/clock", artefact(True), "run-3")
    later = AR.load(spark, path, "credit")
    rows = [(f, m, s, found.run_id, found.mode, found.engine_version == spark.version,
             later.run_id == "run-3" and later.created_at > found.created_at) for f, (m, s) in found.scaler.items()]
    table = spark.createDataFrame(rows, "feature string, mean double, scale double, run_id string, mode string, same_engine boolean, later_than_stored boolean")
    stamp = spark.read.schema(AR.SCHEMA).parquet(f"{path}/runs").agg(F.date_format(F.max("created_at"), "yyyy-MM-dd HH:mm:ss")).first()[0]
    return table.withColumn("created_at", F.lit(stamp)).withColumns({"mean": r6("mean"), "scale": r6("scale")})


KERNEL = {"gamma": GAMMA, "features": BINARY_FEATURES, "basis": np.array(BASIS), "normaliser": np.array(NORMALISER)}


def _phi_sql(rows: str, keep: list[str]) -> str:
    """The kernel's components of scaled rows, beside the columns ``keep``."""
    kernel = [f"exp({lit_sql(-GAMMA)} * (" + " + ".join(
        f"({f} - {lit_sql(v)}) * ({f} - {lit_sql(v)})" for f, v in zip(BINARY_FEATURES, b, strict=True)) + f")) AS k{j}" for j, b in enumerate(BASIS)]
    phi = [" + ".join(f"{lit_sql(n)} * k{j}" for j, n in enumerate(row)) + f" AS phi{i}" for i, row in enumerate(NORMALISER)]
    return f"SELECT {', '.join(keep + phi)} FROM (SELECT {', '.join(keep + kernel)} FROM ({rows}))"


@query("train_kernel_epochs", "M2,M3,M10", lambda: trace_sql(
    _phi_sql(SCALED_ROWS_SQL, ["y", "cw"]), COMPONENTS, {"0": ("y", "cw")}, "log", RATE, ALPHA))
def q_train_kernel_epochs(spark, d):
    """Training over kernel components that are made block by block inside the pass and never stored."""
    tr, _ = scaled_train(spark, d)
    rows = IN.dense_rows(tr, BINARY_FEATURES, [F.col("label")], [F.col("cw")])
    learner = IN.Learner("log", tuple(COMPONENTS), lr=RATE, feature_map=IN.mapped_features(KERNEL))
    return resumed(spark, rows, learner, "m2")


def _trained_score_sql() -> str:
    trace = trace_sql(_phi_sql(SCALED_ROWS_SQL, ["y", "cw"]), COMPONENTS, {"0": ("y", "cw")}, "log", RATE, ALPHA, rounded=False)
    last = f"SELECT feature, coef FROM ({trace}) WHERE version = {EPOCHS}"
    wide = ", ".join(f"max(CASE WHEN feature = '{c}' THEN coef END) AS w_{c}" for c in [*COMPONENTS, "_intercept"])
    z = " + ".join([f"w_{c} * {c}" for c in COMPONENTS] + ["w__intercept"])
    rows = f"SELECT l.l_orderkey, l.l_linenumber, {scaled_select_sql()} FROM lineitem l, {moments_sql()} m"
    return f"""
WITH w AS (SELECT {wide} FROM ({last})), p AS ({_phi_sql(rows, ['l_orderkey', 'l_linenumber'])})
SELECT l_orderkey, l_linenumber, {r6_sql(sigmoid_sql(z))} AS probability FROM p, w
"""


@query("train_store_score", "M2,M3,M10,M11,S10,S11", _trained_score_sql)
def q_train_store_score(spark, d):
    """The whole way: trained by epochs over kernel components, stored with scaler and kernel, loaded and scored."""
    tr, mom = scaled_train(spark, d)
    learner = IN.Learner("log", tuple(COMPONENTS), lr=RATE, feature_map=IN.mapped_features(KERNEL))
    done = IN.train(IN.dense_rows(tr, BINARY_FEATURES, [F.col("label")], [F.col("cw")]), learner, scratch_path(spark, "m3"), EPOCHS)
    path = scratch_path(spark, "trained")
    AR.save(spark, path, AR.Artefact("credit", AR.ENSEMBLE, list(done.models().values()), mom, KERNEL, threshold=0.5), "run-1")
    out = AR.score(load(spark, d, "lineitem"), AR.load(spark, path, "credit"))
    return out.select("l_orderkey", "l_linenumber", r6("probability").alias("probability"))
