"""Multi-pass training that can stop and go on.

A pass takes the weights of the last version to every task; each task updates
its copy over its own rows (a partial fit) and hands on its weights times its
rows; the sums are reduced by a tree of bounded fan-in, block of weights by
block of weights, and their mean is the next version (parameter mixing,
Zinkevich et al. 2010).  Versions are folders of a Parquet table under one
path.  A trainer that is started again on that path goes on after the last
complete version, from the rows that the first one wrote.

A learner has several outputs that see the same rows: the classes of a
one-vs-rest model, or the members of an ensemble with a weight of their own for
each row.  With ``batch=None`` a task takes one step by the mean gradient of
all its rows; mixing then gives the exact gradient step over the table,
however its rows lie in partitions, which is what the oracles recompute.

Only the model (``width`` numbers, a property of the task, not of the data)
reaches the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import ALPHA, N_HASH_FEATURES, PA_C
from ..session import path_exists

LEARNING_RATE = 0.01
#: Weights that one row of a version holds, and partial sums that one task of the tree adds up.
BLOCK = 1 << 16
FAN_IN = 32
#: Rows that are multiplied at once where a step takes more.
ROWS = 4096

_PART = "block int, part long, at long, n long, w array<double>"


@dataclass(frozen=True)
class Learner:
    """What a pass does with its rows: ``log`` and ``squared`` loss by SGD, ``hinge`` by Passive-Aggressive I.

    Dense learners (log, squared) read rows ``x, y, s``: features, one target
    and one weight for each output.  The hinge learner reads ``bucket, value,
    y`` with y in {-1, 1}.  ``batch`` rows make a step (None: all rows of a
    task; 1: the reference's single samples).
    """

    kind: str
    features: Sequence[str] = ()
    outputs: Sequence[str] = ("0",)
    lr: float = LEARNING_RATE
    alpha: float = ALPHA
    batch: int | None = None
    c: float = PA_C
    n_features: int = N_HASH_FEATURES
    feature_map: Callable[[np.ndarray], np.ndarray] | None = field(default=None, compare=False)

    @property
    def width(self) -> int:
        return self.n_features + 1 if self.kind == "hinge" else len(self.outputs) * (len(self.features) + 1)

    def described(self) -> str:
        """What a version of the weights depends on; another learner must not go on from them."""
        return json.dumps([self.kind, list(self.features), list(self.outputs), self.width])


def dense_rows(df: DataFrame, features: Sequence[str], targets: Sequence[Column],
               weights: Sequence[Column] | None = None) -> DataFrame:
    """``x, y, s``: the rows of a dense learner, with one target (and weight) for each output."""
    def doubles(cols: Sequence[Column]) -> Column:
        return F.array(*[c.cast("double") for c in cols])

    return df.select(doubles([F.col(f) for f in features]).alias("x"), doubles(targets).alias("y"),
                     doubles(weights or [F.lit(1.0)] * len(targets)).alias("s"))


# ------------------------------------------------------------------ one pass


def _lists(column: pa.Array) -> np.ndarray:
    """A list column whose rows have one length, as a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


class _Dense:
    """Partial fit of all outputs: ``w`` is outputs x (features + intercept)."""

    def __init__(self, learner: Learner, weights: np.ndarray):
        self.learner = learner
        self.w = weights.reshape(len(learner.outputs), -1).copy()
        self.rest: list[tuple[np.ndarray, ...]] = []
        self.waiting = self.n = 0
        self.gradient = np.zeros_like(self.w)

    def _sum(self, x: np.ndarray, y: np.ndarray, s: np.ndarray) -> np.ndarray:
        """Summed gradient of the loss over some rows at the present weights."""
        z = x @ self.w[:, :-1].T + self.w[:, -1]
        r = ((np.exp(-np.logaddexp(0.0, -z)) if self.learner.kind == "log" else z) - y) * s
        return np.column_stack([r.T @ x, r.sum(axis=0)])

    def _step(self, gradient: np.ndarray, n: int) -> None:
        self.w[:, :-1] *= 1.0 - self.learner.lr * self.learner.alpha
        self.w -= self.learner.lr * gradient / n

    def add(self, batch: pa.RecordBatch) -> None:
        x, y, s = (_lists(batch.column(c)) for c in ("x", "y", "s"))
        for i in range(0, len(x), ROWS):
            rows = [a[i:i + ROWS] for a in (x, y, s)]
            if self.learner.feature_map is not None:
                rows[0] = self.learner.feature_map(rows[0])
            self.n += len(rows[0])
            if self.learner.batch is None:
                self.gradient += self._sum(*rows)
            else:
                self.rest.append(tuple(rows))
                self.waiting += len(rows[0])
                self._steps(self.learner.batch)

    def _steps(self, size: int, last: bool = False) -> None:
        """Steps of ``size`` rows each, whatever the batches in which rows arrive; ``last`` takes what is left."""
        if not self.waiting or (self.waiting < size and not last):
            return
        rows = [np.concatenate(a) for a in zip(*self.rest, strict=True)]
        whole = self.waiting if last else self.waiting // size * size
        for i in range(0, whole, size):
            part = [a[i:min(i + size, whole)] for a in rows]
            self._step(self._sum(*part), len(part[0]))
        self.rest = [tuple(a[whole:] for a in rows)]
        self.waiting -= whole

    def result(self) -> np.ndarray:
        if self.learner.batch is None:
            self._step(self.gradient, self.n)
        else:
            self._steps(self.learner.batch, last=True)
        return self.w.reshape(-1)


class _Hinge:
    """Passive-Aggressive I over sparse rows; the last weight is the intercept.

    With ``batch=None`` every row's step is taken from the pass's first
    weights and their mean is added once, else rows follow one another.
    """

    def __init__(self, learner: Learner, weights: np.ndarray):
        self.learner, self.w, self.n = learner, weights.copy(), 0
        self.move = np.zeros_like(weights) if learner.batch is None else None

    def add(self, batch: pa.RecordBatch) -> None:
        buckets, values = batch.column("bucket"), batch.column("value")
        at = buckets.offsets.to_numpy()
        at = at - at[0]
        b = buckets.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        v = values.flatten().to_numpy(zero_copy_only=False)
        target = self.w if self.move is None else self.move
        for i, y in enumerate(batch.column("y").to_numpy(zero_copy_only=False).tolist()):
            bi, vi = b[at[i]:at[i + 1]], v[at[i]:at[i + 1]]
            loss = 1.0 - y * (self.w[-1] + float(self.w[bi] @ vi))
            size = float(vi @ vi)
            if loss > 0 and size > 0:
                tau = min(self.learner.c, loss / size)
                target[bi] += tau * y * vi  # the buckets of a row are distinct
                target[-1] += tau * y
        self.n += batch.num_rows

    def result(self) -> np.ndarray:
        return self.w if self.move is None else self.w + self.move / self.n


def _pass(learner: Learner, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = (_Hinge if learner.kind == "hinge" else _Dense)(learner, shared.value)
        for batch in batches:
            fit.add(batch)
        if fit.n:
            w, part = fit.result() * fit.n, TaskContext.get().partitionId()
            for block, start in enumerate(range(0, len(w), BLOCK)):
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block], pa.int32()), "part": pa.array([part]), "at": pa.array([part]),
                    "n": pa.array([fit.n]), "w": pa.array([w[start:start + BLOCK]], pa.list_(pa.float64()))})

    return run


def _added(table: pa.Table) -> pa.Table:
    """The sum of some partial sums of a block, in order of their numbers, so that a replay adds them alike."""
    table = table.sort_by("at")
    w = sum(np.asarray(x.values) for x in table.column("w").combine_chunks())
    part = table.column("part")[0].as_py()
    return pa.table({"block": table.column("block")[:1], "part": pa.array([part]), "at": pa.array([part]),
                     "n": pa.array([sum(table.column("n").to_pylist())]), "w": pa.array([w], pa.list_(pa.float64()))})


def tree_sum(parts: DataFrame, n_parts: int, fan_in: int = FAN_IN) -> DataFrame:
    """One row for each block: the partial sums added up by a tree whose tasks hold ``fan_in`` of them."""
    while True:
        n_parts = -(-n_parts // fan_in)
        grouped = parts.withColumn("part", F.floor(F.col("part") / fan_in)).groupBy("block", "part")
        parts = grouped.applyInArrow(_added, _PART)
        if n_parts <= 1:
            return parts


def one_pass(rows: DataFrame, learner: Learner, weights: np.ndarray) -> DataFrame:
    """``block, n, w``: the mixed weights (times the rows ``n`` that they saw) after one pass."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)
    columns = ["bucket", "value", "y"] if learner.kind == "hinge" else ["x", "y", "s"]
    parts = rows.select(*columns).mapInArrow(_pass(learner, shared), _PART)
    return tree_sum(parts, rows.rdd.getNumPartitions()).select("block", "n", "w")


# ------------------------------------------------------------------ versions


@dataclass(frozen=True)
class Versions:
    """The versions of a learner's weights: Parquet folders ``version=<n>`` under ``path``."""

    spark: SparkSession
    path: str
    learner: Learner

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def latest(self, before: int | None = None) -> int | None:
        """The last complete version (below ``before``); a folder without Spark's mark of success does not count."""
        if not path_exists(self.spark, self.path):
            return None
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        names = [s.getPath().getName() for s in root.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(root)]
        numbers = sorted((int(n.partition("=")[2]) for n in names if n.startswith("version=")), reverse=True)
        return next((n for n in numbers if (before is None or n < before)
                     and path_exists(self.spark, f"{self._folder(n)}/_SUCCESS")), None)

    def read(self, version: int | None) -> np.ndarray:
        """The weights of a version; zeros where there is none."""
        out = np.zeros(self.learner.width)
        if version is None:
            return out
        rows = self.spark.read.parquet(self._folder(version)).collect()  # one row for each block of the model
        if any(r["learner"] != self.learner.described() for r in rows):
            raise ValueError(f"{self.path} holds weights of another learner: {rows[0]['learner']}")
        for r in rows:
            w = np.array(r["w"])
            out[r["block"] * BLOCK:r["block"] * BLOCK + len(w)] = w / max(1, r["n"])
        return out

    def write(self, version: int, mixed: DataFrame, before: np.ndarray) -> None:
        """Write a version, replacing a folder that an interrupted or replayed pass has left; no rows repeat ``before``."""
        named = mixed.withColumn("learner", F.lit(self.learner.described()))
        named.write.mode("overwrite").parquet(self._folder(version))
        if self.spark.read.parquet(self._folder(version)).isEmpty():
            blocks = [(b, 1, before[i:i + BLOCK].tolist(), self.learner.described())
                      for b, i in enumerate(range(0, len(before), BLOCK))]
            self.spark.createDataFrame(blocks, "block int, n long, w array<double>, learner string").write.mode(
                "overwrite").parquet(self._folder(version))

    def table(self) -> DataFrame:
        """``version, output, feature, coef`` of all versions; the intercept is ``_intercept``, a bucket its number."""
        rows = self.spark.read.parquet(self.path)
        cells = rows.select("version", "block", "n", F.posexplode("w").alias("i", "x")).select(
            F.col("version").cast("int").alias("version"), (F.col("block") * F.lit(BLOCK) + F.col("i")).alias("i"),
            (F.col("x") / F.greatest(F.col("n"), F.lit(1))).alias("coef"))
        if self.learner.kind == "hinge":
            last = F.col("i") == self.learner.n_features
            return cells.select("version", F.lit(self.learner.outputs[0]).alias("output"),
                                F.when(last, F.lit("_intercept")).otherwise(F.col("i").cast("string")).alias("feature"), "coef")
        names = F.array(*[F.lit(f) for f in [*self.learner.features, "_intercept"]])
        outputs, d = F.array(*[F.lit(str(o)) for o in self.learner.outputs]), len(self.learner.features) + 1
        return cells.select("version", F.get(outputs, F.floor(F.col("i") / d).cast("int")).alias("output"),
                            F.get(names, (F.col("i") % d).cast("int")).alias("feature"), "coef")

    def models(self, version: int | None = None) -> dict[str, dict]:
        """Output -> model dict of a dense learner (the latest version by default)."""
        w = self.read(self.latest() if version is None else version).reshape(len(self.learner.outputs), -1)
        return {str(o): {"features": list(self.learner.features), "coef": [float(x) for x in row[:-1]], "intercept": float(row[-1])}
                for o, row in zip(self.learner.outputs, w, strict=True)}


def train(rows: Callable[[], DataFrame] | DataFrame, learner: Learner, path: str, epochs: int,
          spark: SparkSession | None = None) -> Versions:
    """Versions 1 to ``epochs`` under ``path``: one pass over the rows for each.

    The rows are written once, under ``path/rows``; the call that finds them
    (and complete versions) there reads them again and goes on after the last
    version, so nothing is computed twice when a driver is started anew.
    ``rows`` may be a function, which is called only if the rows are missing.
    """
    session = spark or (rows.sparkSession if isinstance(rows, DataFrame) else SparkSession.active())
    stored = f"{path}/rows"
    if not path_exists(session, f"{stored}/_SUCCESS"):
        (rows if isinstance(rows, DataFrame) else rows()).write.mode("overwrite").parquet(stored)
    table = session.read.parquet(stored)
    versions = Versions(session, f"{path}/versions", learner)
    done = versions.latest() or 0
    weights = versions.read(done or None)
    for version in range(done + 1, epochs + 1):
        versions.write(version, one_pass(table, learner, weights), weights)
        weights = versions.read(version)
    return versions


def online_batches(learner: Learner, path: str, prepare: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """foreachBatch learner: version b is one pass over micro-batch b from the last version before it.

    A replayed batch starts from the same version and replaces its own; weights
    that cannot be read fail the batch, so a model never starts afresh unnoticed.
    """
    def fit(batch: DataFrame, batch_id: int) -> None:
        versions = Versions(batch.sparkSession, path, learner)
        before = versions.read(versions.latest(before=batch_id))
        versions.write(batch_id, one_pass(prepare(batch), learner, before), before)

    return fit


def mapped_features(feature_map: Mapping | None) -> Callable[[np.ndarray], np.ndarray] | None:
    """The function of a stored kernel (gamma, basis, normaliser): rows to features."""
    if feature_map is None:
        return None
    from .features import rbf

    basis, norm, gamma = (feature_map[k] for k in ("basis", "normaliser", "gamma"))
    return lambda x: rbf(x, basis, gamma) @ norm.T
