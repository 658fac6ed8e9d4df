"""Metrics: exact AUC vs brute force, weighted metrics, zero division, one class."""

import itertools
import random

from rivulet.operators import metrics as M


def brute_auc(labels, scores):
    pos = [s for y, s in zip(labels, scores) if y == 1]
    neg = [s for y, s in zip(labels, scores) if y != 1]
    total = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return total / (len(pos) * len(neg))


def test_auc_with_ties_matches_brute_force(spark):
    rnd = random.Random(7)
    labels = [rnd.randint(0, 1) for _ in range(600)]
    scores = [round(rnd.random(), 2) for _ in range(600)]      # many ties
    df = spark.createDataFrame(list(zip(labels, scores)), "y int, s double")
    for parts in (1, 3, 16):
        got = M.roc_auc(df, "y", "s", n_partitions=parts).collect()[0]["auc"]
        assert abs(got - brute_auc(labels, scores)) < 1e-12


def test_auc_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "y int, s double")
    assert M.roc_auc(df, "y", "s").collect()[0]["auc"] is None


def _sk_weighted(t, p):
    classes = sorted(set(t) | set(p))
    n = len(t)
    prec = rec = f1 = 0.0
    for c in classes:
        tp = sum(1 for a, b in zip(t, p) if a == c and b == c)
        pc = sum(1 for b in p if b == c)
        sc = sum(1 for a in t if a == c)
        pr = tp / pc if pc else 0.0
        rc = tp / sc if sc else 0.0
        fc = 2 * pr * rc / (pr + rc) if pr + rc else 0.0
        prec += pr * sc
        rec += rc * sc
        f1 += fc * sc
    acc = sum(1 for a, b in zip(t, p) if a == b) / n
    return acc, prec / n, rec / n, f1 / n


def test_weighted_metrics_rows_equal_matrix(spark):
    rnd = random.Random(3)
    t = [rnd.choice("ABC") for _ in range(500)]
    p = [rnd.choice("ABD") for _ in range(500)]                # class D never true, C never predicted
    df = spark.createDataFrame(list(zip(t, p)), "t string, p string")
    a = M.weighted_metrics_rows(df, "t", "p").collect()[0]
    cm = M.confusion_matrix(df, "t", "p", ["A", "B", "C", "D"])
    b = M.weighted_metrics(cm).collect()[0]
    exp = _sk_weighted(t, p)
    for row in (a, b):
        got = (row["accuracy"], row["precision_weighted"], row["recall_weighted"], row["f1_weighted"])
        assert all(abs(x - y) < 1e-12 for x, y in zip(got, exp))
    assert cm.count() == 16 and sum(r["n"] for r in cm.collect()) == 500


def test_all_wrong_and_empty(spark):
    df = spark.createDataFrame([(0, 1), (1, 0)], "t int, p int")
    r = M.binary_metrics(df, "t", "p").collect()[0]
    assert (r["accuracy"], r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0, 0.0)
    empty = spark.createDataFrame([], "t int, p int")
    r = M.weighted_metrics_rows(empty, "t", "p").collect()[0]
    assert r["accuracy"] == 0.0 and r["f1_weighted"] == 0.0


def test_regression_metrics_constant_target(spark):
    df = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "y double, p double")
    r = M.regression_metrics(df, "y", "p").collect()[0]
    assert r["r2"] == 1.0 and r["mse"] == 0.0


def test_log_loss_clips(spark):
    df = spark.createDataFrame([(0.0,), (1.0,)], "p double")
    r = M.log_loss(df, "p").collect()[0]["log_loss"]
    assert 18 < r < 19                                          # -ln(eps)/2


def test_metrics_long(spark):
    wide = spark.createDataFrame([(0.5, 0.25)], "accuracy double, f1 double")
    got = {r["metric"]: r["value"] for r in M.metrics_long(wide, "run-1").collect()}
    assert got == {"accuracy": 0.5, "f1": 0.25}


def test_hashed_bags_equal_a_plain_count(spark):
    import math
    import re
    from collections import Counter

    from rivulet.operators.text import bucket_of_py, hashed_bow, linear_text_decision, with_bow
    texts = ["Été été de la mer", "a b cc cc dd", None, "", "x y z", "日本語 ünïcode_x 12 1 ½½ 𝔘𝔫 é́é", "a" * 9000 + " bb" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "text_id int, text string")
    for n in (1 << 20, 1000):  # a power of two and another size
        want = {}
        for i, t in enumerate(texts):
            counts = Counter(bucket_of_py(w, n) for w in re.findall(r"\w{2,}", (t or "").lower()))
            norm = math.sqrt(sum(c * c for c in counts.values()))
            want |= {(i, b): c / norm for b, c in counts.items()}
        got = {(r["text_id"], r["bucket"]): r["value"] for r in hashed_bow(df, "text_id", "text", n).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - v) < 1e-12 for k, v in want.items())
        bags = {(r["text_id"], b["bucket"]): b["value"] for r in with_bow(df, "text", "bag", n).collect() for b in r["bag"]}
        assert bags == got
        for r in linear_text_decision(df, "text", {"cc": 2.0, "été": -1.0}, 0.25, n_features=n).collect():
            z = sum(v * (2.0 * (b == bucket_of_py("cc", n)) - (b == bucket_of_py("été", n))) for (i, b), v in want.items() if i == r["text_id"])
            assert abs(r["decision"] - 0.25 - z) < 1e-12
