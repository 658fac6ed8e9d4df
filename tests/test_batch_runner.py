"""Scoring that continues on error: which rows end where, and at what cost."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rivulet.operators import batch_runner as BR
from rivulet.session import scratch_path


def make_picky():
    def picky(rows: pd.DataFrame) -> pd.DataFrame:  # a local function: tasks cannot import this module
        bad = rows["v"].isna() | (rows["v"] % 10 == 3)
        if bad.any():
            raise ValueError(f"cannot score {rows['id'][bad].iloc[0]}")
        return pd.DataFrame({"twice": rows["v"] * 2.0})

    return picky


picky = make_picky()


def table(spark, n=200):
    rows = [(i, None if i == 50 else float(i)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, v double").repartition(3)


def test_only_the_rows_that_raise_go_to_the_dead_letters(spark):
    valid, dead = scratch_path(spark, "t-valid"), scratch_path(spark, "t-dead")
    BR.write_sinks(BR.score_batches(table(spark), picky, "twice double"), ["id", "v"], valid, dead)
    got = {r["id"]: r["twice"] for r in spark.read.parquet(valid).collect()}
    bad = {i for i in range(200) if i == 50 or i % 10 == 3}
    assert got == {i: 2.0 * i for i in range(200) if i not in bad}
    letters = spark.read.parquet(dead)
    assert letters.columns == ["id", "v", "error"]
    assert {r["id"]: r["error"] for r in letters.collect()} == {i: f"ValueError: cannot score {i}" for i in bad}


def test_pieces_keep_their_order_and_few_calls_are_made():
    rows, calls = pd.DataFrame({"id": range(1024), "v": [3.0 if i == 700 else 0.0 for i in range(1024)]}), []

    def counted(part):
        calls.append(len(part))
        return picky(part)

    out = pd.concat(BR.score_pieces(counted, rows, ["twice"]))
    assert out["id"].tolist() == list(range(1024)) and out["error"].notna().sum() == 1
    assert len(calls) == 1 + 2 * 10  # one bad row: two halves for each of ten levels


@pytest.mark.parametrize("scorer, message", [
    (lambda rows: pd.DataFrame({"twice": [1.0] * (len(rows) + 1)}), "ValueError: the scorer returned 2 rows for 1"),
    (lambda rows: pd.DataFrame({"other": rows["v"]}), "ValueError: the scorer returned no twice"),
    (lambda rows: {}[1], "KeyError: 1")])
def test_a_scorer_that_never_works_loses_no_row(spark, scorer, message):
    rows = BR.score_batches(table(spark, 9), scorer, "twice double").collect()
    assert len(rows) == 9 and {r["error"] for r in rows} == {message} and {r["twice"] for r in rows} == {None}


def test_clashing_names_and_no_rows(spark):
    frame = table(spark, 5).withColumn("error", F.lit("old")).withColumn("twice", F.lit("old"))
    rows = BR.score_batches(frame, picky, "twice double").orderBy("id").collect()
    assert [r["twice"] for r in rows] == [0.0, 2.0, 4.0, None, 8.0]
    assert BR.score_batches(frame.limit(0), picky, "twice double").count() == 0


def test_a_replayed_batch_replaces_its_own_sinks(spark):
    valid, dead = scratch_path(spark, "t-v"), scratch_path(spark, "t-d")
    run = BR.score_stream_batches(picky, "twice double", valid, dead)
    for batch in (0, 1, 1):
        run(table(spark, 20), batch)
    assert spark.read.parquet(valid).groupBy("batch_id").count().orderBy("batch_id").collect() == [(0, 18), (1, 18)]
    assert spark.read.parquet(dead).count() == 4


def test_many_failing_rows_cost_few_calls_each():
    bad = [i for i in range(10_000) if (i * 7919) % 101 == 5]
    rows, calls = pd.DataFrame({"id": range(10_000), "v": [3.0 if i in set(bad) else 10.0 * i for i in range(10_000)]}), []

    def counted(part):
        calls.append(len(part))
        return picky(part)

    out = pd.concat(BR.score_pieces(counted, rows, ["twice"]))
    assert out["id"].tolist() == list(range(10_000)) and out.index[out["error"].notna()].tolist() == bad
    assert out["error"][bad].tolist() == [f"ValueError: cannot score {i}" for i in bad]
    assert [x for i, x in enumerate(out["twice"]) if i not in set(bad)] == [20.0 * i for i in range(10_000) if i not in set(bad)]
    assert len(calls) <= 10 * len(bad)  # halving alone: about 15


def test_any_pattern_of_failing_rows_and_pieces():
    rng = random.Random(3)
    for n in [1, 2, 3, 7, 64, 100] * 20:
        bad, most = {i for i in range(n) if rng.random() < rng.choice([0.0, 0.05, 0.5, 1.0])}, rng.choice([1, 5, 1000])

        def scorer(part, bad=bad, most=most):
            if len(part) > most or bad & set(part["id"]):
                raise ValueError(f"{len(part)}")
            return pd.DataFrame({"v": part["id"] * 2, "s": part["id"].astype(str)})

        out, = BR.score_pieces(scorer, pd.DataFrame({"id": range(n)}), ["v", "s"])
        assert out["id"].tolist() == list(range(n))
        assert out["error"].tolist() == ["ValueError: 1" if i in bad else None for i in range(n)]
        assert out["v"].tolist() == [None if i in bad else 2 * i for i in range(n)]
        assert out["s"].tolist() == [None if i in bad else str(i) for i in range(n)]


def test_failing_rows_that_share_a_value_cost_about_one_call_each():
    rng, calls, suspicion = random.Random(4), [], BR.Suspicion()

    def scorer(part):
        calls.append(len(part))
        if (part["a"] + part["b"] == 0).any() or part["c"].isna().any():
            raise ValueError(f"zero or null in {len(part)}")
        return pd.DataFrame({"v": part["id"] * 2})

    bad = 0
    for _ in range(3):
        rows = pd.DataFrame({"id": range(5000), "same": "x", "a": [rng.randrange(10) for _ in range(5000)],
                             "b": [float(rng.randrange(10)) for _ in range(5000)], "c": [["l"]] * 5000})
        out, = BR.score_pieces(scorer, rows, ["v"], suspicion)
        wrong = rows["a"] + rows["b"] == 0
        bad += wrong.sum()
        assert out["id"].tolist() == list(range(5000)) and out["error"].notna().tolist() == wrong.tolist()
        assert [v for v, w in zip(out["v"], wrong, strict=True) if not w] == [2 * i for i in range(5000) if not wrong[i]]
    assert len(calls) <= 2 * bad + 60  # places alone: about eight for each


def test_missing_values_of_any_kind_may_be_shared():
    def scorer(part):
        if part["a"].isna().any():
            raise ValueError("missing")
        return pd.DataFrame({"v": part["id"].to_numpy()})

    for a in (pd.Series([1, pd.NA, 2, pd.NA, pd.NA] * 20, dtype="Int64"), pd.Series(["x", None, "y", None, None] * 20), pd.Series([[1], None, [2], None, None] * 20)):
        rows = pd.DataFrame({"id": range(100), "a": a, "b": pd.Series([pd.NA, 1, 1, pd.NA, 1] * 20, dtype="Int64")})
        out, = BR.score_pieces(scorer, rows, ["v"])
        assert out["error"].notna().tolist() == a.isna().tolist()
        assert out["v"].dropna().tolist() == [i for i in range(100) if not a.isna()[i]]
