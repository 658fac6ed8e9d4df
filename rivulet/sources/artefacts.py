"""Whole model artefacts (S10, S11): what scoring needs, in one nested row of a table.

An artefact holds the fitted scaler, the kernel (gamma, basis rows and
normaliser) if there is one, the members with their weights, the mode, the
classes in order, the threshold, and the stamp of its run.  The table is
appended to; loading takes the latest run of a model and warns when another
engine version wrote it.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyspark
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import linear, sigmoid
from ..operators.features import KERNEL_ROWS, rbf
from ..operators.scoring import ovr_probabilities, soft_vote

log = logging.getLogger("rivulet.models")

ENSEMBLE, ONE_VS_REST, REGRESSION = "ensemble", "one_vs_rest", "regression"
SCHEMA = """model_id string, run_id string, created_at timestamp, engine_version string, mode string,
    classes array<string>, threshold double, scaler array<struct<feature: string, mean: double, scale: double>>,
    kernel struct<gamma: double, features: array<string>, basis: array<array<double>>, normaliser: array<array<double>>>,
    members array<struct<name: string, features: array<string>, coef: array<double>, intercept: double>>"""


@dataclass(frozen=True)
class Artefact:
    """A fitted model; ``kernel`` holds gamma, features, basis and normaliser, and members then weigh its components."""

    model_id: str
    mode: str
    members: Sequence[Mapping]
    scaler: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    kernel: Mapping | None = None
    classes: Sequence[str] = ()
    threshold: float | None = None
    run_id: str = ""
    created_at: object = None
    engine_version: str = pyspark.__version__

    def __post_init__(self):
        if self.mode not in (ENSEMBLE, ONE_VS_REST, REGRESSION):
            raise ValueError(f"unknown mode {self.mode}")
        if self.mode == ONE_VS_REST and len(self.classes) != len(self.members):
            raise ValueError(f"{len(self.members)} members for {len(self.classes)} classes")
        if self.mode == REGRESSION and len(self.members) != 1:
            raise ValueError("a regression has one member")
        width = len(self.kernel["basis"]) if self.kernel else None
        for m in self.members:
            if len(m["coef"]) != (width or len(m["features"])):
                raise ValueError("a member's weights do not fit its features")


def save(spark: SparkSession, path: str, artefact: Artefact, run_id: str, created_at: str | None = None) -> None:
    """Append an artefact as one row, stamped now unless ``created_at`` says otherwise."""
    kernel = artefact.kernel and (float(artefact.kernel["gamma"]), list(artefact.kernel["features"]),
                                  np.asarray(artefact.kernel["basis"], float).tolist(), np.asarray(artefact.kernel["normaliser"], float).tolist())
    members = [(str(m.get("name", i)), [str(f) for f in m["features"]], [float(c) for c in m["coef"]], float(m["intercept"]))
               for i, m in enumerate(artefact.members)]
    scaler = [(f, float(m), float(s)) for f, (m, s) in artefact.scaler.items()]
    row = (artefact.model_id, run_id, None, artefact.engine_version, artefact.mode, list(artefact.classes), artefact.threshold,
           scaler, kernel, members)
    stamp = F.current_timestamp() if created_at is None else F.to_timestamp(F.lit(created_at))
    spark.createDataFrame([row], SCHEMA).withColumn("created_at", stamp).write.mode("append").parquet(path)


def load(spark: SparkSession, path: str, model_id: str | None = None) -> Artefact:
    """The latest run of a model (of any, if there is no name) from a table or any folder above one."""
    table = spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(path)
    if model_id is not None:
        table = table.where(F.col("model_id") == model_id)
    newest = table.orderBy(F.desc("created_at"), F.desc("run_id")).limit(1).collect()  # one model
    if not newest:
        raise ValueError(f"no artefact of {model_id or 'any model'} in {path}")
    r = newest[0].asDict(recursive=True)
    if r["engine_version"] != pyspark.__version__:
        log.warning("model written by engine %s, running %s", r["engine_version"], pyspark.__version__)
    kernel = r["kernel"] and r["kernel"] | {k: np.array(r["kernel"][k]) for k in ("basis", "normaliser")}
    return Artefact(r["model_id"], r["mode"], r["members"], {s["feature"]: (s["mean"], s["scale"]) for s in r["scaler"]},
                    kernel, r["classes"], r["threshold"], r["run_id"], r["created_at"], r["engine_version"])


def _scaled(artefact: Artefact, feature: str) -> Column:
    mean, scale = artefact.scaler.get(feature, (0.0, 1.0))
    return (F.col(feature).cast("double") - F.lit(float(mean))) / F.lit(float(scale)) if feature in artefact.scaler else F.col(feature)


def decisions(df: DataFrame, artefact: Artefact, name: str = "_z") -> DataFrame:
    """Attach the members' linear decisions as an array.

    Without a kernel they are column expressions.  With one, an Arrow function
    multiplies blocks of ``KERNEL_ROWS`` rows with the basis; normaliser and
    weights are multiplied beforehand, so no row's components are ever stored.
    """
    if artefact.kernel is None:
        return df.withColumn(name, F.array(*[
            linear([_scaled(artefact, f) for f in m["features"]], m["coef"], m["intercept"]) for m in artefact.members]))
    kernel = artefact.kernel
    weights = np.asarray(kernel["normaliser"]).T @ np.array([m["coef"] for m in artefact.members]).T
    shared = df.sparkSession.sparkContext.broadcast(
        (np.asarray(kernel["basis"]), float(kernel["gamma"]), weights, np.array([m["intercept"] for m in artefact.members])))

    @F.arrow_udf("array<double>")
    def decide(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        basis, gamma, w, b = shared.value
        for rows in batches:
            x = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
            z = np.concatenate([rbf(x[i:i + KERNEL_ROWS], basis, gamma) @ w + b for i in range(0, len(x), KERNEL_ROWS)]
                               or [np.zeros((0, len(b)))])
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * len(b)), pa.array(z.reshape(-1)))

    # a null feature reaches the function as NaN, and makes the decision NaN
    inputs = F.array(*[F.coalesce(_scaled(artefact, f).cast("double"), F.lit(float("nan"))) for f in kernel["features"]])
    return df.withColumn(name, decide(inputs))


def score(df: DataFrame, artefact: Artefact) -> DataFrame:
    """``df`` with what the model's mode gives.

    ensemble: ``probability`` (mean of the members) and ``predicted``
    (probability >= threshold); one_vs_rest: ``p_<class>``, ``predicted`` and
    ``confidence``; regression: ``predicted`` and, with a threshold,
    ``above`` (predicted > threshold).
    """
    z = [F.col("_z")[i] for i in range(len(artefact.members))]
    with_z = decisions(df, artefact)
    if artefact.mode == REGRESSION:
        out = with_z.withColumn("predicted", z[0])
        return (out if artefact.threshold is None else out.withColumn("above", (z[0] > artefact.threshold).cast("int"))).drop("_z")
    if artefact.mode == ENSEMBLE:
        p = soft_vote([sigmoid(x) for x in z])
        cut = 0.5 if artefact.threshold is None else artefact.threshold
        return with_z.withColumn("probability", p).withColumn("predicted", (F.col("probability") >= cut).cast("int")).drop("_z")
    named = {f"_z{i}": x for i, x in enumerate(z)}
    models = {c: {"features": [f"_z{i}"], "coef": [1.0], "intercept": 0.0} for i, c in enumerate(artefact.classes)}
    return ovr_probabilities(with_z.withColumns(named), list(artefact.classes), models).drop("_z", *named)
