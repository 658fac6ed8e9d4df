"""Null, tied and large-magnitude inputs of the order, dedup and scaling operators; shared storage."""

import math
import types

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet import session
from rivulet.functions.exprs import bloom_geometry, hex_mod
from rivulet.operators import audit as A
from rivulet.operators import features as FE
from rivulet.operators import ordering as O
from rivulet.sources import csv as CSV


@pytest.mark.parametrize("partitions", [1, 7])
def test_row_index_keeps_nulls_text_keys_and_input_order_of_ties(spark, partitions):
    keys = [None, "b", "a", None, "b"] * 40
    df = spark.createDataFrame(list(enumerate(keys)), "i int, k string").coalesce(1)
    got = sorted((r["row_index"], r["k"], r["i"]) for r in O.with_row_index(df, "k", partitions=partitions).collect())
    want = sorted(enumerate(keys), key=lambda x: (x[1] is not None, x[1] or "", x[0]))
    assert got == [(n, k, i) for n, (i, k) in enumerate(want)]


def test_tied_rows_are_spread_over_tasks(spark, monkeypatch):
    written = []
    monkeypatch.setattr(O, "materialize", lambda df, name: written.append(session.materialize(df, name)) or written[0])
    df = spark.range(4000).select(F.lit(1).alias("k"), "id")
    out = O.with_row_index(df, "k", partitions=8)
    assert out.agg(F.count_distinct("row_index"), F.max("row_index")).first()[:] == (4000, 3999)
    assert written[0].select(F.shiftright(written[0].columns[-1], 33)).distinct().count() >= 4


def test_null_keys_keep_their_first_row(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4)], "k string, s int")
    assert sorted(r["s"] for r in A.first_seen_dedup(df, "k", "s").collect()) == [1, 3]
    assert sorted(r["s"] for r in A.bloom_dedup(df, "k", "s", 1000).collect()) == [1, 3]


def test_modulus_beyond_2_31(spark):
    import hashlib
    m, _ = bloom_geometry(300_000_000, 0.01)
    assert m > 2**31
    got = spark.range(50).select("id", hex_mod(F.md5(F.col("id").cast("string")), m, 32).alias("h")).collect()
    assert all(r["h"] == int(hashlib.md5(str(r["id"]).encode()).hexdigest(), 16) % m for r in got)


def test_running_moments_of_large_magnitudes(spark):
    values = [1.7e9 + 0.001 * i for i in range(1000)]
    df = spark.createDataFrame([(v, i // 10) for i, v in enumerate(values)], "x double, c long")
    got = {r["c"]: (r["x_mean"], r["x_scale"]) for r in FE.running_moments(df, ["x"], "c", block=16).collect()}
    for c in range(100):
        part = np.array(values[:10 * c + 10])
        assert math.isclose(got[c][0], part.mean(), rel_tol=1e-14)
        assert math.isclose(got[c][1], (part - part[0]).std(), rel_tol=1e-3)


def test_null_and_nan_are_written_empty(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, float("nan")), (3, 0.5)], "k int, x double").coalesce(1)
    path = CSV.write_csv(df, str(tmp_path / "out"), float_format="%.2f")
    lines = [r[0] for r in spark.read.text(path).collect()]
    assert sorted(lines) == sorted(["k,x", "1,", "2,", "3,0.50"])


def fake_session(master, base=None):
    class Context:
        def __init__(self):
            self.master, self.dir = master, None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d

    return types.SimpleNamespace(sparkContext=Context(), conf=types.SimpleNamespace(get=lambda k, d=None: base))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_its_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(fake_session(master))
    assert session.ensure_checkpoint_dir(fake_session(master, "hdfs://x/y")) == "hdfs://x/y"


def test_a_local_master_gets_a_folder():
    assert session.ensure_checkpoint_dir(fake_session("local[4]"))


def test_row_index_keeps_columns_of_any_name(spark):
    names = ["_in", "_mid", "_part", "_off", "n", "at"]
    df = spark.range(500).select("id", *[F.lit(n).alias(n) for n in names]).repartition(4)
    out = O.with_row_index(df, "id")
    assert out.columns == ["id", *names, "row_index"]
    rows = out.collect()
    assert all(r["id"] == r["row_index"] and [r[n] for n in names] == names for r in rows) and len(rows) == 500
    chunks = O.chunk_numbers(df, "id", 100, name="chunk")
    assert chunks.columns == ["id", *names, "chunk"] and {(r["id"] // 100, r["chunk"]) for r in chunks.collect()} == {(i, i) for i in range(5)}
