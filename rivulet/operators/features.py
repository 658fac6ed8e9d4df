"""Feature moments, standard scaling, as-of-chunk scaling and the Nystroem RBF map
(G4, M1, W4, M2)."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import N_COMPONENTS, RBF_GAMMA, SEED
from ..functions.exprs import order_hash

#: Rows that are multiplied with the kernel's basis at once.
KERNEL_ROWS = 512


def moment_aggs(features: Sequence[str]) -> list:
    out = []
    for i, f in enumerate(features):
        out += [F.avg(f).alias(f"m{i}"), F.stddev_pop(f).alias(f"s{i}")]
    return out


def feature_moments(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Long ``(feature, mean, scale)``: population std, zero std -> scale 1.

    One scan, partial/final aggregation; ``stddev_pop`` merges (n, mean, M2)
    so it is numerically stable at any size.
    """
    wide = df.agg(*moment_aggs(features))
    pairs = ", ".join(f"'{f}', m{i}, s{i}" for i, f in enumerate(features))
    long = wide.selectExpr(f"stack({len(features)}, {pairs}) AS (feature, mean, std)")
    return long.select("feature", "mean",
                       F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")).alias("scale"))


def collect_moments(moments: DataFrame) -> dict[str, tuple[float, float]]:
    """Driver copy of a moments table (one row per feature)."""
    return {r["feature"]: (r["mean"], r["scale"]) for r in moments.collect()}


def standard_scale(df: DataFrame, moments: Mapping[str, tuple[float, float]],
                   suffix: str = "") -> DataFrame:
    """``(x - mean) / scale`` as literal column expressions (no join, no UDF)."""
    return df.withColumns({f"{f}{suffix}": (F.col(f) - F.lit(float(m))) / F.lit(float(s))
                           for f, (m, s) in moments.items()})


def _merged(a: tuple, b: tuple) -> tuple:
    """Count, mean and sum of squared deviations of two groups together."""
    (na, ma, qa), (nb, mb, qb) = a, b
    n = na + nb
    if not n:
        return 0, 0.0, 0.0
    d = mb - ma
    return n, ma + d * nb / n, qa + qb + d * d * na * nb / n


def _running(order: str, n_features: int):
    """Running (n, mean, M2) over the rows of a frame in ``order``."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop(columns="_all", errors="ignore").sort_values(order, ignore_index=True)
        for i in range(n_features):
            total, out = (0, 0.0, 0.0), []
            for row in zip(pdf[f"n{i}"], pdf[f"m{i}"], pdf[f"q{i}"], strict=True):
                total = _merged(total, row)
                out.append(total)
            for k, c in enumerate("nmq"):
                pdf[f"{c}{i}"] = [t[k] for t in out]
        return pdf

    return run


def running_moments(df: DataFrame, features: Sequence[str], chunk_col: str, block: int = 4_096) -> DataFrame:
    """Per chunk c: mean and population std over chunks ``0..c`` (first-epoch scaler).

    One (n, mean, M2) per chunk from a partial aggregate; the data itself is
    never sorted.  Chunks are merged in order in blocks of ``block`` ids, blocks
    in order among themselves, and each chunk's running triple with that of all
    blocks before its own: deviations are only ever taken from nearby means, so
    columns of large magnitude keep their variance.
    """
    k = range(len(features))
    aggs = []
    for i, f in enumerate(features):
        aggs += [F.count(f).alias(f"n{i}"), F.coalesce(F.avg(f), F.lit(0.0)).cast("double").alias(f"m{i}"),
                 F.coalesce(F.var_pop(f) * F.count(f), F.lit(0.0)).cast("double").alias(f"q{i}")]
    per_chunk = df.groupBy(chunk_col).agg(*aggs).withColumn("_blk", F.floor(F.col(chunk_col) / F.lit(block)))
    kind = per_chunk.schema[chunk_col].dataType.simpleString()
    triple = ", ".join(f"n{i} long, m{i} double, q{i} double" for i in k)
    within = per_chunk.groupBy("_blk").applyInPandas(_running(chunk_col, len(k)), f"{chunk_col} {kind}, {triple}, _blk long")
    last = within.groupBy("_blk").agg(*[F.max_by(f"{c}{i}", chunk_col).alias(f"{c}{i}") for i in k for c in "nmq"])
    upto = last.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(  # one row for each block
        _running("_blk", len(k)), f"_blk long, {triple}")
    earlier = Window.orderBy("_blk")
    before = upto.select("_blk", *[F.coalesce(F.lag(f"{c}{i}").over(earlier), F.lit(0)).alias(f"b{c}{i}") for i in k for c in "nmq"])
    cols = [F.col(chunk_col)]
    for i, f in enumerate(features):
        n = F.col(f"n{i}") + F.col(f"bn{i}")
        d = F.col(f"m{i}") - F.col(f"bm{i}")
        mean = F.when(F.col(f"bn{i}") == 0, F.col(f"m{i}")).otherwise(F.col(f"bm{i}") + F.try_divide(d * F.col(f"n{i}"), n))
        m2 = F.col(f"q{i}") + F.col(f"bq{i}") + F.coalesce(F.try_divide(d * d * F.col(f"n{i}") * F.col(f"bn{i}"), n), F.lit(0.0))
        sd = F.sqrt(F.coalesce(F.try_divide(m2, n), F.lit(0.0)))
        cols += [mean.alias(f"{f}_mean"), F.when(sd == 0, F.lit(1.0)).otherwise(sd).alias(f"{f}_scale")]
    return within.join(before, "_blk").select(*cols)


def scale_as_of_chunk(df: DataFrame, features: Sequence[str], chunk_col: str) -> DataFrame:
    """Scale each row with the running moments of its own and earlier chunks.

    The moments table has one row per chunk; the join is left to AQE, which
    broadcasts it when the chunk count is small and shuffles otherwise.
    ``df`` is read twice (per-chunk sums, then the join back): when it is
    expensive to recompute (e.g. freshly chunk-numbered), pass a materialised
    frame (``session.materialize``).
    """
    mom = running_moments(df, features, chunk_col)
    out = df.join(mom, chunk_col)
    return out.withColumns({f"{f}_scaled": (F.col(f) - F.col(f"{f}_mean")) / F.col(f"{f}_scale")
                            for f in features}).drop(*[f"{f}_mean" for f in features],
                                                     *[f"{f}_scale" for f in features])


# --- Nystroem RBF kernel map -------------------------------------------------

def select_basis(df: DataFrame, key: str, features: Sequence[str], n_components: int = N_COMPONENTS,
                 seed: int = SEED) -> np.ndarray:
    """The ``n_components`` rows with the smallest seeded key hash, as a matrix.

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each partition
    keeps its own top n, so only n rows per partition ever move.
    """
    rows = (df.select(key, *features).orderBy(order_hash(key, seed), F.col(key))
            .limit(int(n_components)).collect())
    return np.array([[float(r[f]) for f in features] for r in rows], dtype=np.float64)


def rbf(x: np.ndarray, basis: np.ndarray, gamma: float) -> np.ndarray:
    d2 = (x * x).sum(1)[:, None] + (basis * basis).sum(1)[None, :] - 2.0 * x @ basis.T
    return np.exp(-gamma * np.maximum(d2, 0.0))


def nystroem_normalisation(basis: np.ndarray, gamma: float) -> np.ndarray:
    """``N = U S^-1/2 V^T`` of the basis kernel (singular values floored at 1e-12)."""
    k = rbf(basis, basis, gamma)
    u, s, vt = np.linalg.svd(k)
    s = np.maximum(s, 1e-12)
    return (u / np.sqrt(s)) @ vt


def kernel_columns(df: DataFrame, features: Sequence[str], basis: np.ndarray,
                   gamma: float, prefix: str = "k") -> DataFrame:
    """``k_j = exp(-gamma * ||x - b_j||^2)`` as column expressions (small bases)."""
    cols = {}
    for j, b in enumerate(basis):
        d2 = None
        for f, bv in zip(features, b, strict=True):
            diff = F.col(f) - F.lit(float(bv))
            t = diff * diff
            d2 = t if d2 is None else d2 + t
        cols[f"{prefix}{j}"] = F.exp(F.lit(-float(gamma)) * d2)
    return df.withColumns(cols)


def nystroem_map(df: DataFrame, features: Sequence[str], basis: np.ndarray, gamma: float = RBF_GAMMA,
                 out_col: str = "phi") -> DataFrame:
    """``phi(x) = K(x, B) N^T`` on Arrow batches (dense matmul needs NumPy).

    B and N are bounded by ``n_components`` (not by the data) and shipped once
    per executor as a broadcast.  Rows are mapped and handed on in blocks of
    ``KERNEL_ROWS``, so a task holds one block of components however many rows
    a batch has.
    """
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast((basis, nystroem_normalisation(basis, gamma), float(gamma)))
    feats = list(features)
    rest = df.select(*[c for c in df.columns if c != out_col])
    names = [*rest.columns, out_col]
    schema = T.StructType(rest.schema.fields + [T.StructField(out_col, T.ArrayType(T.DoubleType()))])

    def _map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, n, g = bc.value
        for batch in batches:
            for i in range(0, batch.num_rows, KERNEL_ROWS):
                part = batch.slice(i, KERNEL_ROWS)
                x = np.column_stack([part.column(f).cast(pa.float64()).fill_null(np.nan).to_numpy() for f in feats])
                phi = rbf(x, b, g) @ n.T
                ends = np.arange(len(phi) + 1, dtype=np.int32) * phi.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(phi.reshape(-1)))],
                    names=names)

    return rest.mapInArrow(_map, schema)
