"""The tree of ``file_inventory``: what its sink writes, and what a file costs."""

import os

from pyspark.sql import functions as F

from rivulet.plans.registry import entries
from rivulet.session import scratch_path
from rivulet.sources import inventory as INV

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _tree(root):
    """(folder, size) of every file, checksums left out, and the hidden files."""
    found = [(os.path.relpath(at, root), name, os.path.getsize(os.path.join(at, name))) for at, _, names in os.walk(root) for name in names]
    return sorted((at, size) for at, name, size in found if not name.startswith(".")), [name for _, name, _ in found if name.startswith(".")]


def _started():
    """Processes and threads that this machine has started."""
    with open("/proc/stat") as f:
        return int(next(x for x in f if x.startswith("processes")).split()[1])


def test_a_file_of_the_tree_does_not_start_processes(spark):
    d = scratch_path(spark, "t-forks")
    rows = [(i * 50, f"text {i}", "en", f"s{i % 3}", 6) for i in range(400)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{d}/documents.parquet")
    spark.range(8).repartition(8).mapInArrow(lambda x: x, "id long").count()  # workers are there
    before = _started()
    got = {r["folder"]: (r["size_bytes"], r["status"]) for r in entries()["file_inventory"].fn(spark, d).collect()}
    assert _started() - before < 4 * 400
    want = {f"source={s}/lang=en/group={i // 50}": (len(text) + 1, "VALID") for i, text, _, s, _ in rows}
    assert got == want | {"": (0, "CORRUPT (0 Bytes)")}


def test_the_tree_is_that_of_sparks_sink(spark, monkeypatch):
    names = ["a", "a b", "é", "x/y", "50%", "k=v", "[q]^{}", "'\"#*:?\\", "\t", "", None, INV.NO_VALUE]
    rows = [(a, n, text) for a in names for n in (1, None) for text in ("one", "größer", "", None, "two\nlines")]
    df = spark.createDataFrame(rows, "`k=1` string, n int, text string").repartition(5)
    own = INV.write_tree(df, scratch_path(spark, "t-own"), ["k=1", "n"], "text")
    monkeypatch.setattr(INV, "_mounted", lambda root: False)
    # Spark deals null and empty values out apart before both get the same folder
    one = df.withColumn("k=1", F.coalesce("k=1", F.lit(INV.NO_VALUE))).replace("", INV.NO_VALUE, ["k=1"])
    sparks = INV.write_tree(one, scratch_path(spark, "t-sparks"), ["k=1", "n"], "text")
    assert _tree(own)[0] == _tree(sparks)[0] and len(_tree(own)[0]) == 2 * 10 + 1
    assert _tree(own)[1] == []


def test_a_folder_over_several_batches_is_one_file(spark):
    key, df = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.range(1000).selectExpr("id % 3 AS g", "cast(id AS string) AS text")
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        root = INV.write_tree(df, scratch_path(spark, "t-batches"), ["g"], "text")
    finally:
        spark.conf.set(key, before)
    for g in range(3):
        [name] = os.listdir(f"{root}/g={g}")
        with open(f"{root}/g={g}/{name}") as f:
            assert sorted(map(int, f)) == list(range(g, 1000, 3))


def test_a_second_attempt_replaces_the_file(spark, tmp_path):
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "a", "b"]), pa.array([b"x", b"yy", b"z"])], names=["g", "text"])
    for _ in range(2):
        [out] = INV._write_folders(str(tmp_path), ["g"])(iter([batch]))
        assert out.to_pydict() == {"files": [2]}
    assert _tree(str(tmp_path)) == ([("g=a", 5), ("g=b", 2)], [])


def test_an_empty_table_makes_a_tree_with_its_mark_alone(spark):
    root = INV.write_tree(spark.createDataFrame([], "g int, text string"), scratch_path(spark, "t-none"), ["g"], "text")
    assert _tree(root) == ([(".", 0)], [])
