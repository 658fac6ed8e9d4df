"""Model parameter store.

A model is stored as rows of a Parquet parameter table, appended per run::

    run_id, created_at, engine_version, member, feature, mean, scale, coef

(``mean``/``scale`` carry the fitted scaler, ``coef`` the learner; the
intercept is the feature ``_intercept``).  Loading picks the latest run with
``max_by`` -- no listing of files, no driver-side search -- and warns when it
was written by another engine version.
"""

from __future__ import annotations

import logging

import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("rivulet.models")

PARAM_COLUMNS = ["run_id", "created_at", "engine_version", "member", "feature", "mean", "scale", "coef"]


def param_rows(models, moments: dict[str, tuple[float, float]] | None = None) -> list[tuple]:
    """(member, feature, mean, scale, coef) rows for one model / members / per-class models."""
    if isinstance(models, dict) and "coef" in models:
        items = [("0", models)]
    elif isinstance(models, dict):
        items = [(str(k), m) for k, m in models.items()]
    else:
        items = [(str(i), m) for i, m in enumerate(models)]
    rows = []
    for member, m in items:
        for f, c in zip(m["features"], m["coef"], strict=True):
            mean, scale = (moments or {}).get(f, (None, None))
            rows.append((member, f, mean, scale, float(c)))
        rows.append((member, "_intercept", None, None, float(m["intercept"])))
    return rows


def write_params(spark: SparkSession, path: str, run_id: str, created_at: str, rows: list[tuple],
                 engine_version: str | None = None) -> None:
    df = spark.createDataFrame(rows, "member string, feature string, mean double, scale double, coef double")
    out = df.select(F.lit(run_id).alias("run_id"), F.to_timestamp(F.lit(created_at)).alias("created_at"),
                    F.lit(engine_version or pyspark.__version__).alias("engine_version"), "*")
    out.write.mode("append").parquet(path)


def latest_params(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the most recent run (by ``created_at``) of a parameter table."""
    table = spark.read.parquet(path)
    latest = table.agg(F.max_by("run_id", "created_at").alias("run_id"))
    rows = table.join(F.broadcast(latest), "run_id", "left_semi")
    return rows


def check_engine_version(params: DataFrame) -> list[str]:
    """Distinct engine versions that differ from the running one (logged)."""
    other = [r[0] for r in params.select("engine_version").distinct()
             .where(F.col("engine_version") != pyspark.__version__).collect()]
    for v in other:
        log.warning("model written by engine %s, running %s", v, pyspark.__version__)
    return other


def to_models(params: DataFrame) -> dict[str, dict]:
    """Driver copy of a parameter set: member -> model dict, with its ``scaler`` where one was stored."""
    out: dict[str, dict] = {}
    for r in params.orderBy("member", "feature").collect():
        m = out.setdefault(r["member"], {"features": [], "coef": [], "intercept": 0.0, "scaler": {}})
        if r["mean"] is not None:
            m["scaler"][r["feature"]] = (r["mean"], r["scale"])
        if r["feature"] == "_intercept":
            m["intercept"] = r["coef"]
        else:
            m["features"].append(r["feature"])
            m["coef"].append(r["coef"])
    return out
