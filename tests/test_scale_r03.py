"""Steps that grew faster than their input: rows dealt by class, small pieces, whole batches of words."""

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rivulet.operators import batch_runner as BR
from rivulet.operators import labels as L
from rivulet.operators import learners as LR
from rivulet.operators import text as TX
from rivulet.plans import catalog_learn as CL


def test_class_weights_leave_rows_where_they_are(spark):
    rows = spark.range(0, 1000, 1, 6).select("id", F.when(F.col("id") < 990, F.col("id") % 10 < 3).cast("int").alias("y"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the size of the weights is not known
    try:
        found = L.weight_column(rows, "y", "w")
        parts = found.groupBy(F.spark_partition_id()).count().count()
        got = {r["y"]: r["w"] for r in found.select("y", "w").distinct().collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert parts == 6
    assert got == {1: pytest.approx(990 / (2 * 297)), 0: pytest.approx(990 / (2 * 693)), None: None}


def test_gradient_rows_are_written_once(spark):
    rows = spark.range(0, 300, 1, 3).select(
        (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 3 == 0).cast("double").alias("y"),
        *[LR.poisson_weight(F.col("id").cast("string"), i).alias(f"w{i}") for i in range(2)])
    models = {i: {"features": ["a"], "coef": [0.1 * i], "intercept": -0.2, "weight": f"w{i}"} for i in range(2)}
    out = CL._gradient_rows(spark, rows, models, "y")
    assert "md5" not in out._jdf.queryExecution().toString()  # the rows' expressions are not evaluated again
    got = {(r["member"], r["feature"]): r["grad"] for r in out.collect()}
    for i, m in models.items():
        mean = rows.agg(F.avg(f"w{i}")).first()[0]
        for r in LR.logistic_gradient(rows.withColumn("_w", F.col(f"w{i}") / F.lit(mean)), m, "y", "_w").collect():
            assert got[str(i), r["feature"]] == pytest.approx(r["grad"], abs=1e-6)


def test_scored_pieces_leave_as_one_frame():
    def scorer(rows):
        if (rows["v"] % 10 == 3).any():
            raise ValueError("three")
        return pd.DataFrame({"whole": rows["v"] + (1 << 60), "text": rows["v"].astype(str)})

    frame = pd.DataFrame({"v": range(500)}, index=range(1000, 1500))
    out = list(BR.score_pieces(scorer, frame, ["whole", "text"]))
    assert len(out) == 1 and out[0]["v"].tolist() == list(range(500))
    want = [None if v % 10 == 3 else v + (1 << 60) for v in range(500)]
    assert out[0]["whole"].tolist() == want and out[0]["text"].tolist() == [None if v % 10 == 3 else str(v) for v in range(500)]
    assert out[0]["error"].tolist() == ["ValueError: three" if v % 10 == 3 else None for v in range(500)]


def test_words_are_held_for_a_part_of_a_batch(spark, monkeypatch):
    texts = pa.array(["one two two", None, "", "three " * 50, "two"] * 40)
    want = TX._normalised(texts, 1 << 20)
    monkeypatch.setattr(TX, "PART_BYTES", 200)
    sizes = [len(part) for _, part in TX._parts(texts)]
    assert len(sizes) > 20 and sum(sizes) == len(texts)
    got = [(start + r, b, v) for start, part in TX._parts(texts) for r, b, v in zip(*TX._normalised(part, 1 << 20), strict=True)]
    assert got == list(zip(*want, strict=True))
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts.to_pylist())], "id long, t string").coalesce(1)
    bags = {r["id"]: [(c["bucket"], c["value"]) for c in r["bow"]] for r in TX.with_bow(frame, "t", n_features=1 << 20).collect()}
    assert [(i, *c) for i in sorted(bags) for c in bags[i]] == list(zip(*want, strict=True))


def test_floats_of_a_batch_with_failing_rows_stay_floats():
    def scorer(rows):
        if (rows["v"] % 10 == 3).any():
            raise ValueError("three")
        half = rows["v"] / 2
        return pd.DataFrame({"half": half.where(rows["v"] % 10 != 4), "whole": rows["v"],  # a missing result is no failure
                             "mixed": half if len(rows) % 2 else rows["v"]})

    out, = BR.score_pieces(scorer, pd.DataFrame({"v": range(500)}), ["half", "whole", "mixed"])
    assert out["half"].dtype == "float64" and out["whole"].dtype == object
    for v, half, whole, mixed, error in out.itertuples(index=False):
        assert error == ("ValueError: three" if v % 10 == 3 else None)
        assert pd.isna(half) if v % 10 in (3, 4) else half == v / 2
        assert (whole, mixed) == (None, None) if error else (whole == v and mixed in (v, v / 2))
