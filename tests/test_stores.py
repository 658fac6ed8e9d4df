"""State that outlives a run: Bloom blocks, model artefacts; early stops, headers, listings, row numbers."""

import datetime
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.functions.exprs import bloom_geometry
from rivulet.operators import audit as A
from rivulet.operators import dry_run as DR
from rivulet.operators import features as FE
from rivulet.operators.bloom_state import BloomStore, merge
from rivulet.session import scratch_path
from rivulet.sources import artefacts as AR
from rivulet.sources import csv as CSV
from rivulet.sources import inventory as INV

SF = "/root/testdata/sf0.001"

# ---------------------------------------------------------------- Bloom


def test_runs_over_parts_equal_one_run_and_may_be_repeated(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "user_id")
    want = sorted(map(tuple, A.bloom_dedup(ev, "user_id", "event_id", 60, 0.05).collect()))
    store = BloomStore(spark, scratch_path(spark, "t-bloom"), 60, 0.05)
    cuts = [0, 300, 301, 900, 10 ** 9]
    kept, after = [], None
    for run, (a, b) in enumerate(zip(cuts, cuts[1:])):
        part = ev.where(F.col("event_id").between(a, b - 1))
        for _ in range(2):  # the second time as after a lost driver
            got = sorted(map(tuple, store.dedup(part, "user_id", "event_id", run, after).collect()))
        kept += got
        after = run
    assert sorted(kept) == want
    whole = BloomStore(spark, scratch_path(spark, "t-bloom"), 60, 0.05)
    whole.dedup(ev, "user_id", "event_id", 0)
    bits = lambda s: {(r["bucket"], bytes(r["bits"])) for r in s.collect()}
    assert bits(store.state(after)) == bits(whole.state(0)) == bits(merge(store.state(1), whole.state(0), store.state(after)))
    fill = whole.fill(0).first()
    assert 0 < fill["bits_set"] <= fill["bits"] == bloom_geometry(60, 0.05)[0]


def test_filters_too_large_to_send_and_missing_states(spark, monkeypatch):
    monkeypatch.setattr("rivulet.operators.bloom_state.MOST_BROADCAST", 0)
    ev = spark.createDataFrame([(i, f"k{i % 40}" if i % 7 else None) for i in range(200)], "seq long, key string")
    store = BloomStore(spark, scratch_path(spark, "t-bloom"), 10_000, 0.01)
    first = store.dedup(ev.where("seq < 100"), "key", "seq", 0).count()
    second = store.dedup(ev.where("seq >= 100"), "key", "seq", 1, 0).count()
    assert first + second == A.bloom_dedup(ev, "key", "seq", 10_000, 0.01).count() == 41
    assert store.dedup(ev.limit(0), "key", "seq", 2, 1).count() == 0
    with pytest.raises(ValueError, match="no state"):
        store.dedup(ev, "key", "seq", 4, 3)


# ---------------------------------------------------------------- artefacts


def test_kernel_artefact_scores_as_its_parts_do(spark):
    g = np.random.default_rng(0)
    x = g.normal(size=(30, 2)) * 3 + 1
    frame = spark.createDataFrame([(*map(float, r),) for r in x], "a double, b double").repartition(2)
    basis = (x[:7] - [1.0, 2.0]) / [3.0, 4.0]
    norm = FE.nystroem_normalisation(basis, 0.2)
    members = [{"features": [f"f{i}" for i in range(7)], "coef": list(g.normal(size=7)), "intercept": 0.1 * m} for m in range(3)]
    model = AR.Artefact("m", AR.ENSEMBLE, members, {"a": (1.0, 3.0), "b": (2.0, 4.0)},
                        {"gamma": 0.2, "features": ["a", "b"], "basis": basis, "normaliser": norm}, threshold=0.4)
    path = scratch_path(spark, "t-model")
    AR.save(spark, f"{path}/deep/er", model, "r1")
    found = AR.load(spark, path)
    assert (found.run_id, found.mode, found.threshold) == ("r1", AR.ENSEMBLE, 0.4)
    assert abs((datetime.datetime.now() - found.created_at).total_seconds()) < 24 * 3600
    scaled = FE.standard_scale(frame, found.scaler)
    phi = {tuple(round(r[c] * s + m, 9) for c, (m, s) in found.scaler.items()): np.array(r["phi"])
           for r in FE.nystroem_map(scaled, ["a", "b"], basis, 0.2).collect()}
    for r in AR.score(frame, found).collect():
        z = [phi[round(r["a"], 9), round(r["b"], 9)] @ m["coef"] + m["intercept"] for m in members]
        want = np.mean(1 / (1 + np.exp(-np.array(z))))
        assert r["probability"] == pytest.approx(want, abs=1e-9) and r["predicted"] == (r["probability"] >= 0.4)


def test_latest_run_of_a_model_and_models_that_do_not_fit(spark):
    path = scratch_path(spark, "t-models")
    member = {"features": ["a"], "coef": [1.0], "intercept": 0.0}
    for name, run, day in (("x", "r1", "2024-03-01"), ("x", "r0", "2024-02-01"), ("y", "r9", "2025-01-01")):
        AR.save(spark, path, AR.Artefact(name, AR.REGRESSION, [member | {"intercept": float(run[1])}]), run, f"{day} 00:00:00")
    assert AR.load(spark, path, "x").run_id == "r1" and AR.load(spark, path).run_id == "r9"
    with pytest.raises(ValueError, match="no artefact"):
        AR.load(spark, path, "z")
    for wrong in ({"mode": "other"}, {"mode": AR.ONE_VS_REST, "classes": ["a", "b"]},
                  {"mode": AR.ENSEMBLE, "members": [member | {"coef": [1.0, 2.0]}]}):
        with pytest.raises(ValueError):
            AR.Artefact(**({"model_id": "w", "members": [member]} | wrong))


def test_the_map_does_not_depend_on_blocks_and_keeps_columns(spark, monkeypatch):
    frame = spark.createDataFrame([(i, float(i % 13), float(i % 7), "x") for i in range(100)], "id int, a double, b double, phi string")
    basis = np.array([[float(i), float(i % 3)] for i in range(8)])
    want = {r["id"]: r["phi"] for r in FE.nystroem_map(frame, ["a", "b"], basis, 0.05).collect()}
    monkeypatch.setattr(FE, "KERNEL_ROWS", 3)
    out = FE.nystroem_map(frame, ["a", "b"], basis, 0.05)
    assert out.columns == ["id", "a", "b", "phi"]
    assert all(np.allclose(r["phi"], want[r["id"]], atol=1e-12) for r in out.collect())


# ---------------------------------------------------------------- dry runs, files


def _files(spark, n_files, rows):
    path = scratch_path(spark, "t-files")
    spark.range(n_files * rows).select("id", (F.col("id") % 4 > 0).cast("string").alias("ok")).repartitionByRange(n_files, "id") \
        .sortWithinPartitions("id").write.option("header", True).csv(path)
    return sorted(spark.read.csv(path).inputFiles())


@pytest.mark.parametrize("limit, in_flight, files_read", [(1, 0, 1), (70, 0, 1), (76, 0, 4), (75, 3, 4), (400, 0, 10), (10 ** 6, 0, 10)])
def test_a_dry_run_reads_no_more_files_than_it_needs(spark, limit, in_flight, files_read):
    files = _files(spark, 10, 100)
    run = DR.dry_run_files(lambda some: CSV.read_csv(spark, some, ["id", "ok"]), files, {"not ok": F.col("ok") == "false"}, 20, limit, in_flight)
    total, passed = 0, None
    for chunk in range(50):
        total += 15
        if total >= limit:
            passed = chunk + 1 + in_flight
            break
    got = sorted(int(r["id"]) for r in run.rows.collect())
    assert got == [i for i in range(1000) if i % 4 and (passed is None or i < 20 * passed)]
    assert run.files_read == files_read and sum("/t-files-" in f for f in run.rows.inputFiles()) <= files_read


def test_heads_are_read_once_and_files_without_the_target_are_left_out(spark):
    path = scratch_path(spark, "t-heads")
    big = spark.range(200_000).select("id", F.lit("x" * 50).alias("text"))
    big.coalesce(1).write.option("header", True).csv(f"{path}/a")
    big.limit(3).select(F.col("text").alias(" 'text' "), "id").coalesce(1).write.option("header", True).csv(f"{path}/b")
    big.limit(5).select("id").coalesce(1).write.option("header", True).csv(f"{path}/c")
    heads = CSV.header_directory(spark, f"{path}/*")
    assert sorted(r["header"] for r in heads.collect()) == [" 'text' ,id", "id", "id,text"] or heads.count() == 3
    rows, skipped = CSV.read_csv_with(spark, f"{path}/*", ["text"])
    assert rows.count() == 200_003 and rows.where("text IS NULL").count() == 0
    assert [r["missing"] for r in skipped.collect()] == [["text"]]
    assert all("/c/" not in f for f in rows.inputFiles())
    none, all_skipped = CSV.read_csv_with(spark, f"{path}/*", ["absent"])
    assert none.columns == ["absent"] and none.count() == 0 and all_skipped.count() == 3


def test_row_numbers_move_no_row_and_keep_clashing_columns(spark):
    path = scratch_path(spark, "t-rows")
    names = ["_in", "_mid", "split", "shift"]
    src = spark.range(5000).select("id", *[F.lit(n).alias(n) for n in names])
    src.repartitionByRange(6, "id").sortWithinPartitions("id").write.parquet(path)
    out = CSV.with_file_row_index(spark.read.parquet(path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    rows = out.collect()
    assert all(r["id"] == r["row_index"] for r in rows) and rows[0]["_mid"] == "_mid" and len(rows) == 5000
    few = CSV.with_file_row_index(spark.read.parquet(path), most_broadcast=1)
    assert sorted(r["row_index"] for r in few.collect()) == list(range(5000))


def test_deep_flat_and_empty_trees(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(INV, "PIECE", 50)
    deep = tmp_path
    for i in range(12):
        deep = deep / f"level {i}"
        deep.mkdir()
    (deep / "bottom.txt").write_text("abc")
    (tmp_path / "flat").mkdir()
    (tmp_path / "void").mkdir()
    for i in range(333):
        (tmp_path / "flat" / f"f{i:03d}").write_text("x" * (i % 5))
    os.symlink(tmp_path, tmp_path / "flat" / "loop")
    listing = INV.list_files(spark, [str(tmp_path)])
    got = {r["path"]: r["size_bytes"] for r in listing.collect()}
    assert got == {f"flat/f{i:03d}": i % 5 for i in range(333)} | {os.path.relpath(deep / "bottom.txt", tmp_path): 3}
    sizes = [len(p) for p in listing.rdd.glom().collect() if p]
    assert len(sizes) > 3 and max(sizes) < 333  # the flat folder is measured by several tasks
    assert INV.list_files(spark, [str(tmp_path / "void")]).count() == 0 and INV.list_files(spark, []).count() == 0
