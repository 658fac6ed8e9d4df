"""Registered queries: training.

Iterative fits (logistic, ensemble, one-vs-rest, Passive-Aggressive), the
Nystroem map and the parameter store are rows-only checks: their weights are
solver-specific.  Their correctness is checked in the tests instead (Newton
== Spark ML L-BFGS, recovery of planted coefficients, gradient zero at the
optimum).  The closed-form ridge fit has an exact oracle.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from ..functions.constants import N_COMPONENTS, RBF_GAMMA
from ..operators import features as FE
from ..operators import labels as L
from ..operators import learners as LR
from ..operators import text as TX
from ..sources import models as MS
from ..session import materialize, scratch_path
from .catalog_model import train_rows
from ..functions.exprs import r6, unit_hash_sql
from .fixtures import BINARY_FEATURES, SEED, TEST_RATIO, binary_label, lineitem_key, lit_sql, load, r6_sql
from .registry import query


def scaled_train(spark, d):
    """Train split of the binary task, standard-scaled with train moments, with
    balanced class weights attached (credit-module preprocessing)."""
    tr = train_rows(spark, d).select("l_orderkey", "l_linenumber", "l_returnflag", *BINARY_FEATURES,
                                     binary_label().alias("label"))
    mom = FE.collect_moments(FE.feature_moments(tr, BINARY_FEATURES))
    return L.weight_column(FE.standard_scale(tr, mom), "label", "cw"), mom


@query("fit_logistic", "M3,M10")
def q_fit_logistic(spark, d):
    tr, _ = scaled_train(spark, d)
    model = LR.fit_logistic(tr, BINARY_FEATURES, "label", "cw")
    return LR.model_table(spark, model, "logistic")


@query("fit_ensemble", "M4")
def q_fit_ensemble(spark, d):
    tr, _ = scaled_train(spark, d)
    tr = tr.withColumn("_key", lineitem_key())
    members = LR.fit_ensemble(tr, BINARY_FEATURES, "label", "_key", n_members=7, weight_col="cw", seed=SEED)
    return LR.model_table(spark, members, "ensemble")


@query("fit_linear", "M5,M10", f"""
WITH m AS (SELECT avg(p_retailprice) AS my, avg(CAST(p_size AS DOUBLE)) AS mx,
                  covar_pop(CAST(p_size AS DOUBLE), CAST(p_size AS DOUBLE)) AS cxx,
                  covar_pop(CAST(p_size AS DOUBLE), p_retailprice) AS cxy FROM part),
     w AS (SELECT my, mx, cxy / (cxx + {lit_sql(LR.ALPHA)}) AS slope FROM m)
SELECT 'linear' AS model_id, '0' AS member, 'p_size' AS feature, {r6_sql('slope')} AS coef FROM w
UNION ALL
SELECT 'linear', '0', '_intercept', {r6_sql('my - mx * slope')} FROM w
""")
def q_fit_linear(spark, d):
    p = load(spark, d, "part").select(F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    table = LR.model_table(spark, LR.fit_linear(p, ["p_size"], "p_retailprice"), "linear")
    return table.withColumn("coef", r6("coef"))


@query("fit_ovr", "M6")
def q_fit_ovr(spark, d):
    tr, _ = scaled_train(spark, d)
    classes = L.collect_classes(tr, "l_returnflag")
    return LR.model_table(spark, LR.fit_ovr(tr, BINARY_FEATURES, "l_returnflag", classes), "ovr")


@query("fit_passive_aggressive", "M9,M10")
def q_fit_passive_aggressive(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "text").where(~L.holdout_flag("doc_id", TEST_RATIO, SEED))
    train = docs.join(load(spark, d, "labels").select("doc_id", "quality"), "doc_id")
    bow = TX.with_bow(train, "text").select("doc_id", "bow", "quality")
    return LR.fit_passive_aggressive(bow, None, "doc_id", "quality", epochs=5, c=1.0)


@query("nystroem_map", "M2")
def q_nystroem_map(spark, d):
    tr, mom = scaled_train(spark, d)
    basis = FE.select_basis(tr.withColumn("_key", lineitem_key()), "_key", BINARY_FEATURES, 32, SEED)
    li = FE.standard_scale(load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *BINARY_FEATURES), mom)
    return FE.nystroem_map(li, BINARY_FEATURES, basis, gamma=0.1).select("l_orderkey", "l_linenumber", "phi")


KERNEL_CHUNK, KERNEL_BASIS = 5_000, N_COMPONENTS


def _gram_sql() -> str:
    key = f"md5('{SEED}|' || CAST(o_orderkey AS VARCHAR))"
    return f"""
WITH x AS (SELECT o_orderkey, o_totalprice / CAST(100000 AS DOUBLE) AS x1, o_custkey / CAST(1000 AS DOUBLE) AS x2 FROM orders),
     c AS (SELECT * FROM x ORDER BY o_orderkey LIMIT {KERNEL_CHUNK}),
     b AS (SELECT x1 AS b1, x2 AS b2 FROM c WHERE NOT ({unit_hash_sql('o_orderkey', SEED)} < CAST({TEST_RATIO} AS DOUBLE))
           ORDER BY {key}, o_orderkey LIMIT {KERNEL_BASIS})
SELECT o_orderkey, round(avg(exp({lit_sql(-RBF_GAMMA)} * ((x1 - b1) * (x1 - b1) + (x2 - b2) * (x2 - b2)))), 3) AS gram
FROM x, b GROUP BY o_orderkey
"""


@query("nystroem_gram", "M2", _gram_sql)
def q_nystroem_gram(spark, d):
    """The map at its full width, from a basis of the first chunk's train rows: the products of
    each row's components with those of the basis rows are the kernel itself (their mean here; at 1,200
    nearly dependent basis rows the map is exact to about 1e-9, so the mean is compared to 3 places)."""
    x = load(spark, d, "orders").select("o_orderkey", (F.col("o_totalprice") / F.lit(100000.0)).alias("x1"),
                                        (F.col("o_custkey") / F.lit(1000.0)).alias("x2"))
    chunk = x.orderBy("o_orderkey").limit(KERNEL_CHUNK)
    basis = FE.select_basis(chunk.where(~L.holdout_flag("o_orderkey", TEST_RATIO, SEED)), "o_orderkey", ["x1", "x2"], KERNEL_BASIS, SEED)
    total = (FE.rbf(basis, basis, RBF_GAMMA) @ FE.nystroem_normalisation(basis, RBF_GAMMA).T).mean(axis=0)
    shared = spark.sparkContext.broadcast(total)

    @F.arrow_udf("double")
    def with_basis(phi: pa.Array) -> pa.Array:
        return pa.array(phi.flatten().to_numpy().reshape(len(phi), -1) @ shared.value)

    mapped = FE.nystroem_map(x, ["x1", "x2"], basis, RBF_GAMMA)
    return mapped.select("o_orderkey", F.round(with_basis("phi"), 3).alias("gram"))


@query("model_params", "S10")
def q_model_params(spark, d):
    tr, mom = scaled_train(spark, d)
    model = LR.fit_logistic(tr, BINARY_FEATURES, "label", "cw")
    path = scratch_path(spark, "s10-params")
    MS.write_params(spark, path, "run-1", "2024-01-01 00:00:00", MS.param_rows(model, mom))
    return MS.latest_params(spark, path)


def _gradient_rows(spark, df, models: dict, label: str, weight: str | None = None):
    """``(member, feature, grad)`` of each model's objective at its fitted weights, to 6 places.

    What the models read of the rows is written once: each gradient is a pass of its own.
    """
    weights = {name: weight or m.get("weight") for name, m in models.items()}
    read = {c for m in models.values() for c in [*m["features"], m.get("label", label)]} | {w for w in weights.values() if w}
    df = materialize(df.select(*sorted(read)), "gradient-rows")
    used = sorted({w for w in weights.values() if w})
    means = dict(zip(used, df.agg(*[F.avg(w) for w in used]).first(), strict=True)) if used else {}
    out = None
    for name, m in models.items():
        w = weights[name]
        if w:  # the objective is the weighted mean: scale the weights to mean one
            g = LR.logistic_gradient(df.withColumn("_w1", F.col(w) / F.lit(means[w])), m, m.get("label", label), "_w1")
        else:
            g = LR.logistic_gradient(df, m, m.get("label", label))
        rows = g.select(F.lit(str(name)).alias("member"), "feature", r6("grad").alias("grad"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _zero_sql(members: list[str]) -> str:
    names = ", ".join(f"('{f}')" for f in [*BINARY_FEATURES, "_intercept"])
    which = ", ".join(f"('{m}')" for m in members)
    return f"SELECT member, feature, CAST(0 AS DOUBLE) AS grad FROM (VALUES {which}) m(member), (VALUES {names}) f(feature)"


@query("fit_logistic_gradient", "M3", lambda: _zero_sql(["0"]))
def q_fit_logistic_gradient(spark, d):
    """The fitted weights are the optimum: the exact gradient vanishes there."""
    tr, _ = scaled_train(spark, d)
    return _gradient_rows(spark, tr, {"0": LR.fit_logistic(tr, BINARY_FEATURES, "label", "cw", tol=LR.EXACT)}, "label", "cw")


@query("fit_ensemble_gradient", "M4", lambda: _zero_sql([str(i) for i in range(7)]))
def q_fit_ensemble_gradient(spark, d):
    tr, _ = scaled_train(spark, d)
    tr = tr.withColumn("_key", lineitem_key())
    members = LR.fit_ensemble(tr, BINARY_FEATURES, "label", "_key", n_members=7, weight_col="cw", seed=SEED, tol=LR.EXACT)
    for i in range(7):
        tr = tr.withColumn(f"_w_{i}", LR.poisson_weight("_key", SEED + i) * F.col("cw"))
    return _gradient_rows(spark, tr, {i: m | {"weight": f"_w_{i}"} for i, m in enumerate(members)}, "label")


@query("fit_ovr_gradient", "M6", lambda: _zero_sql(["A", "N", "R"]))
def q_fit_ovr_gradient(spark, d):
    tr, _ = scaled_train(spark, d)
    classes = L.collect_classes(tr, "l_returnflag")
    models = LR.fit_ovr(tr, BINARY_FEATURES, "l_returnflag", classes, tol=LR.EXACT)
    for c in classes:
        tr = tr.withColumn(f"_is_{c}", (F.col("l_returnflag") == c).cast("double"))
    return _gradient_rows(spark, tr, {c: m | {"label": f"_is_{c}"} for c, m in models.items()}, "")
