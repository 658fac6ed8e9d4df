"""The manifest, its proofs and tampered leaves against a plain recursive version."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from odd_docs import ODD, make_docs
from rivulet.llm import merkle
from rivulet.llm.catalog import op13_merkle

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes):
    """Root of a list of digests, and per node the sibling digests (left, right) from the bottom up."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(place):
            run = nodes[at // 8 * 8:at // 8 * 8 + 8]
            paths[i].append((run[:at % 8], run[at % 8 + 1:]))
        nodes, place = [h(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)], [at // 8 for at in place]
    return nodes[0], paths


def key(value):
    return value is not None, value.encode() if isinstance(value, str) else value or 0


def slow(docs):
    """Rows of the query over (doc_id, source, lang, n_chars, text)."""
    by = {}
    for row in docs:
        by.setdefault(row[2], []).append((key(row[0]), leaf_of(row), row))
    langs, out = sorted(by, key=key), []
    trees = {g: tree([x[1] for x in sorted(by[g], key=lambda x: x[:2])]) for g in langs}
    root, tops = tree([trees[g][0] for g in langs])
    for g, top in zip(langs, tops, strict=True):
        for (_, leaf, row), path in zip(sorted(by[g], key=lambda x: x[:2]), trees[g][1], strict=True):
            path, new = path + top, leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                lower = None if row[4] is None else row[4].translate({c: c + 32 for c in range(65, 91)})
                new = leaf_of((*row[:4], lower))
            for left, right in path:
                new = h(*left, new, *right)
            out.append((row[0], leaf, trees[g][0], root, h(*[x for left, right in path for x in left + right]), new, new == root))
    return sorted(out, key=str)


def run(spark, frame, tmp_path):
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = op13_merkle(spark, str(tmp_path))
    assert got.columns == COLUMNS
    rows = frame.select("doc_id", "source", "lang", "n_chars", "text").collect()
    return sorted(map(tuple, got.collect()), key=str), [tuple(r) for r in rows]


def test_documents(spark, docs, tmp_path):
    got, rows = run(spark, docs, tmp_path)
    assert got == slow(rows) and {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("langs", [None, [None, "a", "é", "Z", "a", None, "a", "b", "c", "d", "e", "f", "g"]])
def test_odd_documents(spark, tmp_path, langs):
    """Null ids, texts and groups, repeated rows and more groups than children of a node."""
    ids = [3, None, 1, 2, 2, None, -7, 10 ** 12, 8, 8, 11, 0, 5]
    frame = make_docs(spark, ODD, ids, langs)
    got, rows = run(spark, frame.unionByName(frame), tmp_path)
    assert got == slow(rows)


def test_one_document_and_none(spark, tmp_path):
    got, rows = run(spark, make_docs(spark, ["A text"]), tmp_path / "one")
    assert got == slow(rows) and got[0][4] == h()
    assert run(spark, make_docs(spark, []), tmp_path / "none")[0] == []


def test_many_levels_and_one_row_that_fills_a_third(spark, tmp_path):
    frame = make_docs(spark, [f"T{i}" for i in range(700)], langs=["en"] * 600 + ["de"] * 65 + ["fr"] * 35)
    again = make_docs(spark, ["same"] * 350, ids=[5] * 350)
    got, rows = run(spark, frame.unionByName(again).repartition(5), tmp_path)
    assert got == slow(rows)


def test_some_requests_open_only_their_branches(spark):
    leaves = spark.range(600).select("id", F.when(F.col("id") % 3 > 0, F.lit("x")).alias("grp"),
                                     merkle.digest([F.col("id")]).alias("leaf"))
    found = merkle.manifest(leaves, ["id"])
    asked = spark.createDataFrame([("x", 0, "first"), ("x", 399, "last"), (None, 77, "null group"), ("x", 400, "none"), ("y", 0, "none")],
                                  "grp string, pos long, note string")
    rows = merkle.descend(found, asked).collect()
    by_place = {(r["grp"], r["pos"]): r["leaf"] for r in found.leaves.collect()}
    assert sorted(r["note"] for r in rows) == ["first", "last", "null group"]
    for r in rows:
        name = by_place[r["grp"], r["pos"]]
        for s in r["path"]:
            name = h(*s["siblings"][:s["digit"]], name, *s["siblings"][s["digit"]:])
        assert name == found.root
