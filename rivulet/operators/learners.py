"""Learners (M3-M6, M9, M10).

Two execution modes:

* **batch** (default): Spark ML solvers (L-BFGS / normal equations) on the
  whole cleaned frame -- the same objective the reference's SGD learners
  minimise (log loss or squared loss + L2 with ``alpha``), solved exactly.
* **incremental** (:mod:`incremental`): passes that mix the weights of the
  tasks; every epoch is a stored version, so training can be resumed.

A model is a dict ``{"features": [...], "coef": [...], "intercept": b}``
(multi-class: one per class), convertible to a parameter table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import ALPHA, N_HASH_FEATURES, N_MEMBERS, PA_C, SEED
from ..functions.exprs import linear, sigmoid, unit_hash
from ..session import scratch_path
from . import incremental as IN


# --------------------------------------------------------------- exact pieces


def logistic_gradient(df: DataFrame, model: dict, label: str, weight_col: str | None = None,
                      alpha: float = ALPHA) -> DataFrame:
    """One exact full-batch gradient of weighted mean log loss + (alpha/2)||w||^2.

    ``(feature, grad)`` rows, ``_intercept`` unpenalised; a single aggregate.
    """
    sg = sigmoid(linear(model["features"], model["coef"], model["intercept"]))
    w = F.col(weight_col) if weight_col else F.lit(1.0)
    resid = w * (sg - F.col(label))
    aggs = [(F.avg(resid * F.col(f)) + F.lit(alpha) * F.lit(float(c))).alias(f"g{i}")
            for i, (f, c) in enumerate(zip(model["features"], model["coef"], strict=True))]
    aggs.append(F.avg(resid).alias("gb"))
    wide = df.agg(*aggs)
    names = list(model["features"]) + ["_intercept"]
    cols = [f"g{i}" for i in range(len(model["features"]))] + ["gb"]
    pairs = ", ".join(f"'{n}', {c}" for n, c in zip(names, cols, strict=True))
    return wide.selectExpr(f"stack({len(names)}, {pairs}) AS (feature, grad)")


def least_squares_1d(df: DataFrame, y: str, x: str) -> DataFrame:
    """Closed-form single-feature least squares: ``(slope, intercept)``."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def pa_step_size(y_pm: F.Column, decision: F.Column, sqnorm: F.Column, c: float = 1.0) -> F.Column:
    """Passive-Aggressive I step ``tau = min(C, max(0, 1 - y f) / ||x||^2)`` (0 if x = 0)."""
    loss = F.greatest(F.lit(0.0), F.lit(1.0) - y_pm * decision)
    return F.when(sqnorm > 0, F.least(F.lit(float(c)), loss / sqnorm)).otherwise(F.lit(0.0))


# ------------------------------------------------------------ batch learners

TOLERANCE = 1e-6
EXACT = 1e-12  # the solver runs on until the gradient vanishes at the fitted weights


def _assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="error").transform(df)


def fit_logistic(df: DataFrame, features: Sequence[str], label: str, weight_col: str | None = None,
                 alpha: float = ALPHA, max_iter: int = 100, tol: float = TOLERANCE) -> dict:
    """Weighted L2 logistic regression; ``standardization=False`` keeps alpha's meaning.

    Spark ML's L-BFGS at any width (gradients are summed by tree aggregation,
    so a partition sends one model-sized vector).  ``regParam`` multiplies
    ``0.5 * ||w||^2`` of the *mean* loss, the scaling of the reference objective.
    """
    from pyspark.ml.classification import LogisticRegression
    lr = LogisticRegression(featuresCol="_x", labelCol=label, regParam=alpha, elasticNetParam=0.0,
                            standardization=False, maxIter=max_iter, tol=tol, family="binomial")
    if weight_col:
        lr = lr.setWeightCol(weight_col)
    cols = [c for c in df.columns if c in {*features, "_x", label, weight_col}]
    frame = df.select(*cols)
    m = lr.fit(frame if "_x" in cols else _assemble(frame, features))
    return {"features": list(features), "coef": [float(v) for v in m.coefficients],
            "intercept": float(m.intercept)}


def fit_linear(df: DataFrame, features: Sequence[str], label: str, alpha: float = ALPHA) -> dict:
    """L2 least squares: minimise (1/2n)||y - Xw - b||^2 + (alpha/2)||w||^2 (Spark ML)."""
    from pyspark.ml.regression import LinearRegression
    lr = LinearRegression(featuresCol="_x", labelCol=label, regParam=alpha, elasticNetParam=0.0,
                          standardization=False, tol=EXACT)
    m = lr.fit(_assemble(df.select(*features, label), features))
    return {"features": list(features), "coef": [float(v) for v in m.coefficients],
            "intercept": float(m.intercept)}


def fit_ovr(df: DataFrame, features: Sequence[str], label: str, classes: Sequence,
            alpha: float = ALPHA, tol: float = TOLERANCE) -> dict:
    """One-vs-rest: one binary logistic model per class over a frame cached once."""
    base = _assemble(df.select(*features, label), features).select("_x", label).persist()
    try:
        return {c: fit_logistic(base.select("_x", (F.col(label) == F.lit(c)).cast("double").alias("_y")),
                                features, "_y", alpha=alpha, tol=tol) for c in classes}
    finally:
        base.unpersist()


def poisson_weight(key: str | F.Column, seed: int) -> F.Column:
    """Poisson(1) bootstrap multiplicity from a seeded key hash (inverse CDF)."""
    import math
    u = unit_hash(key, seed)
    expr = None
    cdf, term = 0.0, math.exp(-1.0)
    for k in range(0, 12):
        cdf += term
        cond = u < F.lit(cdf)
        expr = F.when(cond, F.lit(float(k))) if expr is None else expr.when(cond, F.lit(float(k)))
        term = term / (k + 1)
    return expr.otherwise(F.lit(12.0))


def fit_ensemble(df: DataFrame, features: Sequence[str], label: str, key: str, n_members: int = N_MEMBERS,
                 weight_col: str | None = None, seed: int = SEED, alpha: float = ALPHA,
                 max_iter: int = 100, tol: float = TOLERANCE) -> list[dict]:
    """``n_members`` logistic fits that differ by a Poisson(1) bootstrap weight.

    (A convex solver on identical data would return identical members; the
    key-hash bootstrap gives diversity that is reproducible and
    partition-independent.)  One fit per member over a frame cached once, which
    holds the members' weights: a key is hashed once for each of them.
    """
    weights = {}
    for i in range(n_members):
        w = poisson_weight(key, seed + i)
        weights[f"_bw{i}"] = w * F.col(weight_col) if weight_col else w
    base = _assemble(df.select(*features, label, *(w.alias(c) for c, w in weights.items())), features).drop(*features).persist()
    try:
        members = []
        for c in weights:
            b = base.select("_x", label, F.col(c).alias("_bw")).where(F.col("_bw") > 0)
            members.append(fit_logistic(b, features, label, "_bw", alpha=alpha, max_iter=max_iter, tol=tol))
        return members
    finally:
        base.unpersist()


def model_table(spark, models: dict | Sequence[dict], model_id: str) -> DataFrame:
    """Parameter table ``(model_id, member, feature, coef)`` (intercept as ``_intercept``)."""
    if isinstance(models, dict) and "coef" in models:
        items = [("0", models)]
    elif isinstance(models, dict):
        items = [(str(k), m) for k, m in models.items()]
    else:
        items = [(str(i), m) for i, m in enumerate(models)]
    rows = []
    for member, m in items:
        rows += [(model_id, member, f, float(c)) for f, c in zip(m["features"], m["coef"], strict=True)]
        rows.append((model_id, member, "_intercept", float(m["intercept"])))
    return spark.createDataFrame(rows, "model_id string, member string, feature string, coef double")


# ------------------------------------------------------ incremental (mixing)


def fit_sgd(df: DataFrame, features: Sequence[str], label: str, loss: str = "log", epochs: int = 5,
            lr: float = IN.LEARNING_RATE, alpha: float = ALPHA, weight_col: str | None = None,
            batch: int | None = 64, path: str | None = None) -> dict:
    """Incremental SGD with parameter mixing: one distributed pass per epoch (see :mod:`incremental`).

    ``batch`` rows make a vectorised step (1 gives the reference's per-sample
    updates, None one exact gradient step per epoch).  With a ``path`` the
    training can be stopped and gone on with.
    """
    learner = IN.Learner(loss, tuple(features), lr=lr, alpha=alpha, batch=batch)
    rows = IN.dense_rows(df, features, [F.col(label)], [F.col(weight_col)] if weight_col else None)
    return IN.train(rows, learner, path or scratch_path(df.sparkSession, "sgd"), epochs).models()["0"]


def hinge_rows(bow: DataFrame, label: str) -> DataFrame:
    """``bucket, value, y``: the rows of a hinge learner from a bag of words and a 0/1 label; unlabelled rows go."""
    return bow.where(F.col(label).isNotNull() & F.col("bow").isNotNull()).select(
        F.col("bow.bucket").cast("array<int>").alias("bucket"), F.col("bow.value").alias("value"),
        (F.col(label) * 2 - 1).cast("double").alias("y"))


def fit_passive_aggressive(bow: DataFrame, labels: DataFrame | None, key: str, label: str, epochs: int = 5,
                           c: float = PA_C, n_features: int = N_HASH_FEATURES, batch: int | None = 1,
                           path: str | None = None) -> DataFrame:
    """PA-I (hinge) over sparse hashed features with parameter mixing per epoch.

    ``bow`` has a row per document, with its bag of words in ``bow`` (an array,
    as ``with_bow`` attaches it) and its 0/1 label; or it is the long ``(key,
    bucket, value)`` form with the labels beside it, regrouped here.  Each
    task runs PA in order over its documents against a dense weight vector
    (``batch=None``: the mean of the steps from the epoch's first weights);
    the vectors are summed by a tree.  Returns the ``(bucket, weight)`` rows
    that are not zero, plus ``bucket = -1`` for the intercept.
    """
    if "bucket" in bow.columns:  # the long form, one row per bucket
        bow = bow.groupBy(key).agg(F.collect_list(F.struct("bucket", "value")).alias("bow")).join(labels.select(key, label), key)
    learner = IN.Learner("hinge", c=c, n_features=n_features, batch=batch)
    done = IN.train(hinge_rows(bow, label), learner, path or scratch_path(bow.sparkSession, "hinge"), epochs)
    last = done.table().where(F.col("version") == (done.latest() or 0))
    bucket = F.when(F.col("feature") == "_intercept", F.lit(-1)).otherwise(F.col("feature").try_cast("long")).cast("long")
    return last.select(bucket.alias("bucket"), F.col("coef").alias("weight")).where((F.col("weight") != 0) | (F.col("bucket") == -1))
