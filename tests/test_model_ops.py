"""Contract, splits, scaling, kernel map, learners, streaming helpers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.operators import contract as C
from rivulet.operators import features as FE
from rivulet.operators import labels as L
from rivulet.operators import learners as LR
from rivulet.operators import ordering as O
from rivulet.operators import scoring as S


def test_header_normalisation_and_collision(spark):
    df = spark.createDataFrame([(1, 2, 3)], ['" LOR "', "' SOP'", "Mother's qualification"])
    assert C.normalise_headers(df).columns == [" LOR ", " SOP", "Mothers qualification"]
    with pytest.raises(ValueError):
        C.normalise_headers(spark.createDataFrame([(1, 2)], ["a", " a"]))


def test_required_columns(spark):
    df = spark.createDataFrame([(1,)], ["a"])
    with pytest.raises(ValueError, match="columns are absent"):
        C.require_columns(df, {"required_columns": ["a", "b"]})
    C.require_columns(df, {"required_columns": ["a", "b"]}, tolerate=["b"])
    C.require_columns(df, {})


def test_whole_column_cast(spark):
    df = spark.createDataFrame([("1", "x"), ("2", "3")], "a string, b string")
    out = C.cast_whole_columns(df, {"dtypes": {"a": "int64", "b": "int64"}})
    assert dict(out.dtypes) == {"a": "bigint", "b": "string"}


def test_dry_run_chunks_skip_quarantined(spark):
    rows = [(i, i // 10, "bad" if 10 <= i < 20 else "ok") for i in range(60)]
    df = spark.createDataFrame(rows, "k long, chunk long, s string")
    routed = C.quarantine_rows(df, {"bad": F.col("s") == "bad"})
    kept = sorted(r["k"] for r in C.dry_run_chunks(routed, "chunk", 15).collect())
    assert kept == list(range(10)) + list(range(20, 30))     # chunk 1 quarantined, chunk 2 crosses limit


def test_holdout_partition_invariant_and_ratio(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    a = L.holdout_hash(df.repartition(1), "k").where("is_test").select("k")
    b = L.holdout_hash(df.repartition(8), "k").where("is_test").select("k")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert abs(a.count() / 20000 - 0.2) < 0.02


def test_holdout_per_chunk_counts(spark):
    df = spark.range(95).select(F.col("id").alias("k"), (F.col("id") / 10).cast("long").alias("c"))
    out = L.holdout_per_chunk(df, "k", "c", 0.2).where("is_test").groupBy("c").count()
    got = {r["c"]: r["count"] for r in out.collect()}
    assert got == {**{c: 2 for c in range(9)}, 9: 1}


def test_chunk_numbers_many_buckets(spark):
    df = spark.range(5000).select((F.col("id") * 3 + 7).alias("seq"))
    out = O.chunk_numbers(df, "seq", 100, partitions=7)
    got = {r["seq"]: r["chunk_id"] for r in out.collect()}
    assert all(got[i * 3 + 7] == i // 100 for i in range(5000))


def test_moments_population_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "x double, c double")
    m = FE.collect_moments(FE.feature_moments(df, ["x", "c"]))
    assert abs(m["x"][1] - np.std([1, 2, 4])) < 1e-12 and m["c"][1] == 1.0


def test_running_moments_last_chunk_equals_global(spark):
    df = spark.range(1000).select((F.col("id") / 100).cast("long").alias("chunk"),
                                  (F.sin(F.col("id")) * 10).alias("x"))
    rm = FE.running_moments(df, ["x"], "chunk").orderBy(F.desc("chunk")).first()
    g = FE.collect_moments(FE.feature_moments(df, ["x"]))["x"]
    assert abs(rm["x_mean"] - g[0]) < 1e-9 and abs(rm["x_scale"] - g[1]) < 1e-9


def test_nystroem_map_matches_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 3))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "k long, a double, b double, c double")
    basis = FE.select_basis(df, "k", ["a", "b", "c"], 10)
    out = {r["k"]: r["phi"] for r in FE.nystroem_map(df, ["a", "b", "c"], basis, 0.1).collect()}
    k_bb = np.exp(-0.1 * ((basis[:, None, :] - basis[None, :, :]) ** 2).sum(-1))
    u, s, vt = np.linalg.svd(k_bb)
    norm = (u / np.sqrt(np.maximum(s, 1e-12))) @ vt
    k_xb = np.exp(-0.1 * ((x[:, None, :] - basis[None, :, :]) ** 2).sum(-1))
    assert np.allclose(np.array([out[i] for i in range(50)]), k_xb @ norm.T, atol=1e-9)


def test_ovr_probabilities_sum_to_one(spark):
    df = spark.createDataFrame([(0.5, -1.0), (3.0, 2.0)], "a double, b double")
    models = {c: {"features": ["a", "b"], "coef": [w, -w], "intercept": 0.1 * w}
              for c, w in (("x", 1.0), ("y", -0.5), ("z", 0.2))}
    for r in S.ovr_probabilities(df, ["x", "y", "z"], models).collect():
        assert abs(r["p_x"] + r["p_y"] + r["p_z"] - 1) < 1e-12
        assert r["confidence"] == max(r["p_x"], r["p_y"], r["p_z"])


def _planted(spark, n=4000):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, 2))
    p = 1 / (1 + np.exp(-(1.5 * x[:, 0] - 2.0 * x[:, 1] + 0.3)))
    y = (rng.random(n) < p).astype(float)
    return spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)],
                                 "a double, b double, y double")


def test_logistic_recovers_planted(spark):
    m = LR.fit_logistic(_planted(spark), ["a", "b"], "y")
    assert abs(m["coef"][0] - 1.5) < 0.25 and abs(m["coef"][1] + 2.0) < 0.25


def test_sgd_mixing_close_to_batch(spark):
    df = _planted(spark).repartition(4)
    batch = LR.fit_logistic(df, ["a", "b"], "y")
    sgd = LR.fit_sgd(df, ["a", "b"], "y", loss="log", epochs=5, lr=0.05, batch=1)
    assert all(abs(a - b) < 0.3 for a, b in zip(batch["coef"], sgd["coef"]))


def test_gradient_zero_at_optimum(spark):
    df = _planted(spark)
    m = LR.fit_logistic(df, ["a", "b"], "y", alpha=1e-4, tol=LR.EXACT)
    g = {r["feature"]: r["grad"] for r in LR.logistic_gradient(df, m, "y", None, 1e-4).collect()}
    assert all(abs(v) < 1e-4 for v in g.values())


def test_linear_matches_closed_form(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("x"), (F.col("id") * 3 + 5 + F.sin("id")).alias("y"))
    m = LR.fit_linear(df, ["x"], "y", alpha=0.0)
    cf = LR.least_squares_1d(df, "y", "x").collect()[0]
    assert abs(m["coef"][0] - cf["slope"]) < 1e-6 and abs(m["intercept"] - cf["intercept"]) < 1e-4


def test_poisson_weights_mean_one(spark):
    df = spark.range(20000).select(LR.poisson_weight("id", 42).alias("w"))
    r = df.agg(F.avg("w"), F.variance("w")).collect()[0]
    assert abs(r[0] - 1) < 0.05 and abs(r[1] - 1) < 0.1


def test_pa_separates_text(spark):
    from rivulet.operators.text import hashed_bow
    docs = [(i, ("good great fine " if i % 2 else "bad awful poor ") * (1 + i % 3), i % 2) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string, y int")
    bow = hashed_bow(df, "doc_id", "text")
    w = {r["bucket"]: r["weight"] for r in LR.fit_passive_aggressive(bow, df, "doc_id", "y", epochs=2).collect()}
    dec = bow.withColumn("w", F.udf(lambda b: w.get(b, 0.0), "double")("bucket")).groupBy("doc_id").agg(
        F.sum(F.col("value") * F.col("w")).alias("f"))
    got = {r["doc_id"]: r["f"] + w.get(-1, 0.0) for r in dec.collect()}
    assert all((got[i] > 0) == (i % 2 == 1) for i in range(40))


def test_pa_step_size(spark):
    df = spark.createDataFrame([(1.0, 0.2, 1.0), (-1.0, 0.5, 0.5), (1.0, 3.0, 1.0), (1.0, 0.0, 0.0)],
                               "y double, f double, sq double")
    got = [r[0] for r in df.select(LR.pa_step_size(F.col("y"), F.col("f"), F.col("sq"), 1.0)).collect()]
    assert got == [pytest.approx(0.8), pytest.approx(1.0), 0.0, 0.0]
    assert math.isclose(got[0], 0.8)


def _gradient(df, model, label, weight=None):
    return max(abs(r["grad"]) for r in LR.logistic_gradient(df, model, label, weight).collect())


def test_gradient_vanishes_at_the_weights(spark):
    df = _planted(spark).withColumn("w", F.lit(1.0) + (F.col("a") > 0).cast("double"))
    w = df.select((F.col("w") / df.agg(F.avg("w")).first()[0]).alias("w"), "a", "b", "y")
    assert _gradient(w, LR.fit_logistic(df, ["a", "b"], "y", "w", tol=LR.EXACT), "y", "w") < 1e-6


def test_ovr_and_ensemble_members(spark):
    df = _planted(spark).withColumn("cls", F.when(F.col("a") > 0.5, "hi").when(F.col("a") < -0.5, "lo")
                                    .otherwise("mid")).withColumn("k", F.monotonically_increasing_id())
    models = LR.fit_ovr(df, ["a", "b"], "cls", ["hi", "lo", "mid"], tol=LR.EXACT)
    for c, m in models.items():
        assert _gradient(df.withColumn("t", (F.col("cls") == c).cast("double")), m, "t") < 1e-6
    members = LR.fit_ensemble(df, ["a", "b"], "y", "k", n_members=3, tol=LR.EXACT)
    assert len(members) == 3 and len({round(m["coef"][0], 6) for m in members}) == 3


def test_three_hundred_features(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 300))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=400) > 0).astype(float)
    names = [f"x{i}" for i in range(300)]
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], [*names, "y"])
    assert _gradient(df, LR.fit_logistic(df, names, "y", alpha=LR.ALPHA, tol=LR.EXACT), "y") < 1e-5


def test_minibatch_sgd_converges_with_more_epochs(spark):
    df = _planted(spark).repartition(2)
    batch = LR.fit_logistic(df, ["a", "b"], "y")
    mb = LR.fit_sgd(df, ["a", "b"], "y", loss="log", epochs=20, lr=0.5, batch=16)
    assert all(abs(a - b) < 0.3 for a, b in zip(batch["coef"], mb["coef"]))


def test_ridge_matches_the_closed_form(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 2))
    y = 3 * x[:, 0] - 2 * x[:, 1] + 1 + 0.1 * rng.normal(size=3000)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double")
    m = LR.fit_linear(df, ["a", "b"], "y", alpha=0.0)
    want = np.linalg.lstsq(np.hstack([x, np.ones((3000, 1))]), y, rcond=None)[0]
    assert all(abs(p - q) < 1e-8 for p, q in zip([*m["coef"], m["intercept"]], want))
    ridge = LR.fit_linear(df, ["a", "b"], "y", alpha=0.5)
    assert abs(ridge["coef"][0]) < abs(m["coef"][0])                 # shrinkage
