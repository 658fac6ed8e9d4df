"""CSV edge cases, row identity, inventory and manifests on hand-written files."""

import json
import os

import pytest

from rivulet.operators import contract as C
from rivulet.sources import csv as CSV
from rivulet.sources import inventory as INV
from rivulet.session import scratch_path


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_preamble_short_long_bad_quoted_na(spark):
    d = _write(scratch_path(spark, "t-csv"), "a.csv",
               'credit export v2\n'
               'ID,LIMIT_BAL,NOTE,default\n'
               '1,100.5,"two\nlines",0\n'
               '2,oops,NA,1\n'
               '3,7\n'
               '4,8,x,1,surplus\n'
               '5,9,y,0,\n')
    df = CSV.read_csv_preamble(spark, d, multiline=True)
    rows = {r["ID"]: r for r in df.collect()}
    assert set(rows) == {"1", "2", "3", "4", "5"}
    assert rows["1"]["NOTE"] == "two\nlines"
    assert rows["3"]["NOTE"] is None                        # short row padded
    cast = C.soft_cast(CSV.normalise_null_tokens(df), {"dtypes": {"LIMIT_BAL": "float64"}})
    r2 = {r["ID"]: r for r in cast.collect()}["2"]
    assert r2["LIMIT_BAL"] is None and r2["_cast_errors"] == ["LIMIT_BAL"]
    assert r2["NOTE"] is None                               # 'NA' token -> null


def test_bad_line_skip_drops_long_rows_only(spark):
    d = _write(scratch_path(spark, "t-bad"), "b.csv", "a,b,c\n1,2,3\n4,5\n6,7,8,9\n10,11,12,\n")
    got = sorted(r["a"] for r in CSV.read_csv_skip_bad_lines(spark, d).collect())
    assert got == ["1", "10", "4"]                          # trailing empty surplus kept (documented)


def test_multi_file_preamble(spark):
    d = scratch_path(spark, "t-multi")
    for i in range(3):
        _write(d, f"part-{i}.csv", f"preamble {i}\nk,v\n{i},{i * 10}\n{i + 10},{i}\n")
    df = CSV.read_csv_preamble(spark, d)
    assert sorted(int(r["k"]) for r in df.collect()) == [0, 1, 2, 10, 11, 12]


def test_file_row_index_is_gap_free_in_file_order(spark):
    d = scratch_path(spark, "t-idx")
    for i in range(4):
        _write(d, f"part-{i}.csv", "v\n" + "".join(f"{i * 100 + j}\n" for j in range(25)))
    df = CSV.with_file_row_index(CSV.read_csv(spark, d, multiline=False))
    got = sorted((r["row_index"], int(r["v"])) for r in df.collect())
    assert [g[0] for g in got] == list(range(100))
    assert [g[1] for g in got] == [i * 100 + j for i in range(4) for j in range(25)]


def test_write_csv_refuses_own_input(spark):
    d = scratch_path(spark, "t-self")
    spark.range(3).write.csv(d)
    with pytest.raises(ValueError):
        CSV.write_csv(spark.read.csv(d), d)


def test_float_format(spark):
    df = CSV.format_floats(spark.createDataFrame([(1.5, 2)], "x double, n int"))
    assert df.collect()[0]["x"] == "1.50000000"


def test_inventory_sees_empty_files_and_manifest(spark):
    root = scratch_path(spark, "t-inv")
    _write(root, "weights.bin", "weights")
    _write(os.path.join(root, "logs"), "run_audit.log", "")
    listing = INV.list_files(spark, [root]).withColumn("job_id", INV.F.lit("job-1"))
    st = {r["path"]: r["status"] for r in INV.file_status(listing).collect()}
    assert st == {"weights.bin": "VALID", "logs/run_audit.log": "CORRUPT (0 Bytes)"}
    doc = json.loads(INV.manifest(listing).collect()[0]["manifest"])
    assert doc["job_id"] == "job-1" and doc["integrity_warnings"] == ["run_audit.log"]
    assert [f["path"] for f in doc["files"]] == ["logs/run_audit.log", "weights.bin"]
    missing = INV.missing_assets(listing, ["run_audit.log", "weights.bin", "report.csv"]).collect()
    assert [r["name"] for r in missing] == ["report.csv"]


def test_inventory_fans_out_subdirectories(spark):
    root = scratch_path(spark, "t-fan")
    for i in range(5):
        _write(os.path.join(root, f"d{i}", "x"), f"f{i}.txt", "a" * i)
    _write(root, "top.txt", "t")
    got = {r["path"]: r["size_bytes"] for r in INV.list_files(spark, [root]).collect()}
    assert got == {**{f"d{i}/x/f{i}.txt": i for i in range(5)}, "top.txt": 1}


def test_a_header_in_another_order_is_refused_or_matched_by_name(spark):
    d = scratch_path(spark, "t-order")
    _write(d, "a.csv", "x,y\n1,2\n")
    _write(d, "b.csv", "y,x\n8,9\n")
    _write(d, "c.csv", "x\n5\n")
    with pytest.raises(Exception, match="header"):
        CSV.read_csv(spark, d, ["x", "y"]).collect()
    got = sorted(((r["x"], r["y"]) for r in CSV.read_csv_by_header(spark, d).select("x", "y").collect()), key=str)
    assert got == [("1", "2"), ("5", None), ("9", "8")]
