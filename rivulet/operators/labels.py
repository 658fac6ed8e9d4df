"""Label domain, class weights, label derivation and holdout splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import DECISION_CUT, SEED, TEST_RATIO
from ..functions.exprs import col_of, order_hash, unit_hash


def class_histogram(df: DataFrame, target: str) -> DataFrame:
    """``(target, n)`` over non-null labels (partial + final aggregate)."""
    return df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n"))


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """Balanced weights ``total / (n_classes * n_c)`` per class.

    The window runs over the histogram (one row per class), not over the data.
    """
    hist = class_histogram(df, target)
    everything = Window.partitionBy(F.lit(1))
    total = F.sum("n").over(everything)
    k = F.count(F.lit(1)).over(everything)
    return hist.withColumn("weight", total / (k * F.col("n")))


def class_domain(df: DataFrame, target: str) -> DataFrame:
    """Sorted distinct labels with a 0-based ``class_index``."""
    d = df.where(F.col(target).isNotNull()).select(target).distinct()
    return d.withColumn("class_index",
                        (F.dense_rank().over(Window.partitionBy(F.lit(1)).orderBy(target)) - 1).cast("int"))


def collect_classes(df: DataFrame, target: str) -> list:
    """Label list on the driver, in order (one row for each class)."""
    return [r[target] for r in class_domain(df, target).orderBy("class_index").collect()]


def weight_column(df: DataFrame, target: str, name: str = "class_weight") -> DataFrame:
    """Attach the balanced class weight to every row (null labels get none).

    A broadcast join with the weight table, one row per class.  The rows stay
    where they are: dealt by their label, they would be the work of as many
    tasks as there are classes.
    """
    w = class_weights(df, target).select(F.col(target).alias("_label"), F.col("weight").alias(name))
    return df.join(F.broadcast(w), F.col(target) == F.col("_label"), "left").drop("_label")


def binarise(c: str | Column, threshold: float) -> Column:
    """Strict ``>`` threshold -> 0/1 int."""
    return (col_of(c) > F.lit(threshold)).cast("int")


def decide(p: str | Column, cut: float = DECISION_CUT) -> Column:
    """Probability decision, non-strict ``>=``."""
    return (col_of(p) >= F.lit(cut)).cast("int")


def holdout_flag(key: str | Column, ratio: float, seed: int = SEED) -> Column:
    """Stateless holdout: a row is test iff its seeded key hash is below ``ratio``.

    Depends on the key only, so it is the same under any partitioning, on
    re-runs and on streams.
    """
    return unit_hash(key, seed) < F.lit(float(ratio))


def holdout_hash(df: DataFrame, key: str, ratio: float = TEST_RATIO, seed: int = SEED,
                 name: str = "is_test") -> DataFrame:
    return df.withColumn(name, holdout_flag(key, ratio, seed))


def holdout_per_chunk(df: DataFrame, key: str, chunk_col: str, ratio: float = TEST_RATIO,
                      seed: int = SEED, name: str = "is_test") -> DataFrame:
    """Exact-count split per chunk: ``ceil(ratio * n_chunk)`` test rows each.

    The test rows of a chunk are those with the smallest seeded key hash.
    Windows are partitioned by chunk, which is bounded by the batch size.
    """
    w = Window.partitionBy(chunk_col)
    rank = F.row_number().over(w.orderBy(order_hash(key, seed), F.col(key)))
    n_test = F.ceil(F.lit(float(ratio)) * F.count(F.lit(1)).over(w))
    return df.withColumn(name, rank <= n_test)
