"""Evaluation metrics as aggregates.

Every metric is a distributed aggregate; nothing iterates over rows on the
driver.  Zero divisions give 0 (``zero_division=0``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import safe_div

EPS = 2.220446049250313e-16  # float64 machine epsilon (probability clip)


def confusion_counts(df: DataFrame, true: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(true).alias("true_label"), F.col(pred).alias("pred_label")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, true: str, pred: str, labels: Sequence) -> DataFrame:
    """Long ``(true_label, pred_label, n)`` over the full label cross product, zeros filled.

    ``labels`` is the label domain; each label's row of the grid is exploded
    where it lies and joined with the aggregated counts.
    """
    spark = df.sparkSession
    counts = confusion_counts(df, true, pred)
    dtype = dict(counts.dtypes)["true_label"]
    cells = spark.createDataFrame([(t,) for t in labels], f"true_label {dtype}").withColumn(
        "pred_label", F.explode(F.array(*map(F.lit, labels)).cast(f"array<{dtype}>")))
    return (cells.join(counts, ["true_label", "pred_label"], "left")
            .select("true_label", "pred_label", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")))


def per_class_stats(matrix: DataFrame) -> DataFrame:
    """Per class: support (row sum), predicted count (column sum), true positives."""
    contrib = matrix.select(F.explode(F.array(
        F.struct(F.col("true_label").alias("cls"), F.col("n").alias("sup"), F.lit(0).cast("long").alias("prd"),
                 F.when(F.col("true_label") == F.col("pred_label"), F.col("n")).otherwise(F.lit(0))
                 .cast("long").alias("tp")),
        F.struct(F.col("pred_label").alias("cls"), F.lit(0).cast("long").alias("sup"), F.col("n").alias("prd"),
                 F.lit(0).cast("long").alias("tp")),
    )).alias("c")).select("c.*")
    return contrib.groupBy("cls").agg(F.sum("sup").alias("support"), F.sum("prd").alias("predicted"),
                                      F.sum("tp").alias("tp"))


def weighted_metrics(matrix: DataFrame) -> DataFrame:
    """One row: accuracy and support-weighted precision / recall / F1."""
    st = per_class_stats(matrix)
    p = safe_div(F.col("tp").cast("double"), F.col("predicted").cast("double"))
    r = safe_div(F.col("tp").cast("double"), F.col("support").cast("double"))
    st = st.withColumn("_p", p).withColumn("_r", r)
    f1 = safe_div(2.0 * F.col("_p") * F.col("_r"), F.col("_p") + F.col("_r"))
    st = st.withColumn("_f1", f1)
    total = F.sum("support")
    return st.agg(
        safe_div(F.sum("tp").cast("double"), total.cast("double")).alias("accuracy"),
        safe_div(F.sum(F.col("_p") * F.col("support")), total.cast("double")).alias("precision_weighted"),
        safe_div(F.sum(F.col("_r") * F.col("support")), total.cast("double")).alias("recall_weighted"),
        safe_div(F.sum(F.col("_f1") * F.col("support")), total.cast("double")).alias("f1_weighted"),
    )


def weighted_metrics_rows(df: DataFrame, true: str, pred: str) -> DataFrame:
    """Weighted metrics straight from labelled rows (binary or multi-class)."""
    return weighted_metrics(confusion_counts(df, true, pred))


def binary_metrics(df: DataFrame, true: str, pred: str) -> DataFrame:
    """Positive-class precision / recall / F1 and accuracy, zero_division=0."""
    t, p = F.col(true) == 1, F.col(pred) == 1
    agg = df.agg(F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"),
                 F.count_if(t & ~p).alias("fn"), F.count(F.lit(1)).alias("n"),
                 F.count_if(F.col(true) == F.col(pred)).alias("correct"))
    prec = safe_div(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double"))
    rec = safe_div(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double"))
    f1 = safe_div(2.0 * F.col("tp"), (2 * F.col("tp") + F.col("fp") + F.col("fn")).cast("double"))
    return agg.select(safe_div(F.col("correct").cast("double"), F.col("n").cast("double")).alias("accuracy"),
                      prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))


def roc_auc(df: DataFrame, label: str, score: str, n_partitions: int | None = None) -> DataFrame:
    """Exact ROC AUC (ties count one half) as one row ``auc``; null if one class.

    AUC = sum over positives of (negatives scored lower + half the tied
    negatives) / (P * N).  Rows are first aggregated by distinct score (a
    partial aggregate, so a score shared by a third of the rows is one row).
    The distinct scores are then range-partitioned and sorted within
    partitions; equal scores share a partition, so each partition computes
    its own term over its sorted scores and reports ``(pid, term, P, N)``.
    Every positive also beats all negatives of lower partitions, which a
    window over one row per partition adds.  One sampling pass, one sorted
    pass, and no task ever holds more than its range.
    """
    spark = df.sparkSession
    n = n_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    by_score = df.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    ranged = (by_score.repartitionByRange(n, "s").sortWithinPartitions("s")
              .withColumn("_pid", F.spark_partition_id()))

    def local_terms(batches):
        import numpy as np
        import pandas as pd
        pid, below, term, p_tot, n_tot = None, 0.0, 0.0, 0.0, 0.0
        for pdf in batches:
            if pdf.empty:
                continue
            pid = int(pdf["_pid"].iloc[0])
            pos = pdf["pos"].to_numpy(dtype=np.float64)
            neg = pdf["neg"].to_numpy(dtype=np.float64)
            neg_before = below + np.concatenate(([0.0], np.cumsum(neg)[:-1]))
            term += float(np.sum(pos * (neg_before + neg / 2.0)))
            below += float(neg.sum())
            p_tot += float(pos.sum())
            n_tot += float(neg.sum())
        if pid is not None:
            yield pd.DataFrame({"_pid": [pid], "_term": [term], "_p": [p_tot], "_n": [n_tot]})

    parts = ranged.mapInPandas(local_terms, "_pid int, _term double, _p double, _n double")
    lower = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    cross = parts.withColumn("_nlow", F.coalesce(F.sum("_n").over(lower), F.lit(0.0)))
    tot = cross.agg(F.sum(F.col("_term") + F.col("_p") * F.col("_nlow")).alias("_c"),
                    F.sum("_p").alias("_p"), F.sum("_n").alias("_n"))
    return tot.select(F.try_divide(F.col("_c"), F.col("_p") * F.col("_n")).alias("auc"))


def regression_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    """R^2, MSE, MAE in one aggregate (R^2 = 1 if constant y predicted exactly)."""
    e = F.col(y) - F.col(p)
    agg = df.agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"), F.var_pop(y).alias("_var"))
    r2 = (F.when(F.col("_var") == 0, F.when(F.col("mse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(F.lit(1.0) - F.col("mse") / F.col("_var")))
    return agg.select(r2.alias("r2"), "mse", "mae")


def log_loss(df: DataFrame, p_true: str, eps: float = EPS) -> DataFrame:
    """Mean negative log-likelihood of the true-class probability (clipped)."""
    p = F.least(F.greatest(F.col(p_true), F.lit(eps)), F.lit(1.0 - eps))
    return df.agg(F.avg(-F.ln(p)).alias("log_loss"))


def append_metrics(wide: DataFrame, path: str, run_id: str) -> None:
    """Metrics sink: append a run's ``(run_id, metric, value)`` rows to a table."""
    metrics_long(wide, run_id).select("run_id", "metric", "value").write.mode("append").parquet(path)


def metrics_long(wide: DataFrame, run_id: str | None = None) -> DataFrame:
    """Wide one-row metrics -> ``(run_id, metric, value)`` rows."""
    cols = [c for c in wide.columns if c != "run_id"]
    ids = ["run_id"] if "run_id" in wide.columns else []
    out = wide.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        ids, cols, "metric", "value")
    if run_id is not None and not ids:
        out = out.withColumn("run_id", F.lit(run_id))
    return out
