"""Norm-bucketed search and anchor-clustered lists against plain loops over all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.llm import hard_negatives as HN
from rivulet.llm import top_products as TP
from rivulet.llm import vectors as V

SCHEMA = "vec_id long, embedding array<float>, label int, norm string, score string, block string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, y, "n", "s", "b") for i, v, y in rows], SCHEMA).repartition(3)


def clean(rows, scale):
    out = []
    for i, v, y in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            out.append((i, [math.floor(scale * float(np.float32(x))) for x in v], y))
    return out


def dot(a, b):
    return sum(x * y for x, y in zip(a, b, strict=False))


def order(entry):
    return -entry[0], entry[1] is None, entry[1] or 0


def slow_top(rows, every, k):
    rows = clean(rows, TP.SCALE)
    out, asked = [], set()
    for n, (i, v, _) in enumerate(rows):
        if i is None or i % every or (i, tuple(v)) in asked:
            continue
        asked.add((i, tuple(v)))
        scores = sorted(((dot(v, w), j) for m, (j, w, _) in enumerate(rows) if m != n), key=order)
        out += [(i, r + 1, j, s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out, key=str)


def slow_negatives(rows, every):
    rows = [(i, v, (y + 1) % 10 if i is not None and i % 7 == 0 else y) for i, v, y in clean(rows, HN.SCALE) if y is not None]
    out, asked = [], set()
    for n, (i, v, y) in enumerate(rows):
        if i is None or i % every or (i, tuple(v), y) in asked:
            continue
        asked.add((i, tuple(v), y))
        scores = [(dot(v, w), j, z) for m, (j, w, z) in enumerate(rows) if m != n]
        for s, p, _ in sorted((x for x in scores if x[2] == y), key=order)[:5]:
            fit = sorted((x for x in scores if x[2] != y and 50 * s <= 100 * x[0] <= 95 * s), key=order)[:3]
            out += [(i, p, r + 1, x[1], s, x[0]) for r, x in enumerate(fit)]
    return sorted(out, key=str)


def mined(frame, every):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = HN.hard_negatives(frame, F.col("vec_id") % every == 0, label)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()), key=str)


def top(frame, every, k):
    found = TP.top_products(frame, F.col("vec_id") % every == 0, k)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()), key=str)


def random_rows(n, d, seed, spread=1.0, centres=6):
    """Vectors around a few directions, with lengths over some orders of magnitude."""
    g = np.random.default_rng(seed)
    at = g.normal(size=(centres, d))
    own = g.integers(0, centres, n)
    v = at[own] + spread * g.normal(size=(n, d))
    v *= np.exp(g.normal(size=(n, 1)))
    return [(int(i), [float(x) for x in row], int(y)) for i, row, y in zip(g.permutation(n), v, (own + g.integers(0, 2, n)) % 10)]


ODD = [(0, None, 1), (5, [1.0, None, 2.0], 1), (10, [float("nan"), 1.0, 1.0], 1), (15, [float("inf"), 1.0, 0.0], 2),
       (20, [0.0, 0.0, 0.0], 1), (25, [], 1), (30, [1.0, 2.0], 1), (35, [1.0, 2.0, 3.0], None), (None, [1.0, 1.0, 1.0], 1),
       (None, [1.0, 1.0, 1.0], 2), (40, [1.0, 1.0, 1.0], 1), (40, [1.0, 1.0, 1.0], 1), (40, [2.0, 1.0, 1.0], 1),
       (45, [-1.0, -1.0, -1.0], 2), (50, [0.9, 1.0, 0.9], 2), (55, [0.9, 1.0, 0.9], 1), (60, [0.5, 0.5, 0.5], 2),
       (100, [1.0, 1.0, 1.0], 2), (41, [1.0, 1.0, 1.0], 2)]


@pytest.fixture(params=["blocks as in production", "small blocks"])
def sizes(request, monkeypatch):
    """Results are the same whatever the sizes of blocks, seeds and tiles."""
    if request.param == "small blocks":
        for module, name, n in [(TP, "SEEDS", 40), (TP, "BLOCK_ROWS", 60), (TP, "BLOCK_QUERIES", 16), (TP, "TILE", 7),
                                (HN, "SEEDS", 30), (HN, "BLOCK_MEMBERS", 8), (HN, "BLOCK_ROWS", 90), (HN, "STRIDE", 16),
                                (HN, "SAMPLE_OF_CLUSTER", 4)]:
            monkeypatch.setattr(module, name, n)


def test_odd_rows(spark, sizes):
    frame = table(spark, ODD)
    assert top(frame, 5, 4) == slow_top(ODD, 5, 4)
    assert mined(frame, 5) == slow_negatives(ODD, 5)


def test_empty_tables(spark):
    for rows in ([], ODD[:4]):
        assert top(table(spark, rows), 5, 4) == [] and mined(table(spark, rows), 5) == []


@pytest.mark.parametrize("spread", [0.1, 1.5])
def test_random_vectors(spark, sizes, spread):
    rows = random_rows(400, 12, 3, spread)
    frame = table(spark, rows)
    assert top(frame, 20, 20) == slow_top(rows, 20, 20)
    assert mined(frame, 10) == slow_negatives(rows, 10)


def test_a_third_of_the_rows_is_one_vector(spark, sizes):
    rows = random_rows(300, 8, 5, 0.5) + [(1000 + i, [0.5] * 8, i % 3) for i in range(150)]
    frame = table(spark, rows)
    assert top(frame, 10, 20) == slow_top(rows, 10, 20)
    assert mined(frame, 25) == slow_negatives(rows, 25)


def test_components_past_the_exact_doubles(spark):
    g = np.random.default_rng(2)
    rows = [(i, [float(x) for x in g.normal(size=5) * 2.0 ** 21], i % 2) for i in range(60)]
    assert top(table(spark, rows), 10, 5) == slow_top(rows, 10, 5)
    assert mined(table(spark, rows), 10) == slow_negatives(rows, 10)


def test_components_past_a_long_do_not_stop_the_job(spark):
    rows = [(i, [1e30 if i == 3 else 1.0, float(i)], i % 2) for i in range(60)]
    assert len(top(table(spark, rows), 10, 5)) == 30
    mined(table(spark, rows), 10)


def test_small_query_classes_share_a_block_and_large_ones_are_cut(monkeypatch):
    monkeypatch.setattr(TP, "BLOCK_QUERIES", 10)
    first, splits, begun = TP._query_blocks({1: 4, 2: 5, 4: 3, 5: 25, 7: 1}, 8)
    assert [first[c] for c in (1, 2, 4, 5, 7)] == [0, 0, 1, 2, 5]
    assert [splits[c] for c in (1, 2, 4, 5, 7)] == [1, 1, 1, 3, 1]
    assert begun == [0, 1, 1, 1, 2, 5, 5, 6, 6]  # blocks whose queries a row of that class may serve


def test_small_clusters_share_a_pack_and_large_ones_are_cut(monkeypatch):
    monkeypatch.setattr(HN, "BLOCK_MEMBERS", 10)
    assert HN.packs({0: 4, 1: 6, 3: 2, 4: 25, 5: 9}) == ({0: 0, 1: 0, 3: 1, 4: 2, 5: 3}, [1, 1, 3, 1])
    assert HN.packs({}) == ({}, [])


def test_both_prunings_are_chosen_and_leave_out_products():
    """Narrow cosines go by coordinates, wide ones by length, and either verifies fewer products than there are."""
    g = np.random.default_rng(1)
    at = g.normal(size=(40, 16))
    rows = at[g.integers(0, 40, 4000)] + 0.02 * g.normal(size=(4000, 16))
    rows = (10_000 * rows / V.lengths(rows)[:, None]).astype(np.int64)  # one bucket: lengths within the ratio
    bucket = TP.Bucket(rows, np.arange(4000))
    every = rows[:200] @ rows.T
    least = np.sort(every, axis=1)[:, -5]
    counted = {}
    i, c, s = TP.search_bucket(bucket, rows[:200], least, 5, counted)
    want = sorted((q, -x, n) for q in range(200) for x, n in sorted((-v, n) for n, v in enumerate(every[q]))[:5])
    assert sorted((int(q), int(v), int(bucket.names[n])) for q, n, v in zip(i, c, s)) == want
    assert counted["coordinate"] > 0 and counted["verified"] < 200 * 4000 / 2
    wide = {}
    TP.search_bucket(bucket, rows[:200], np.full(200, V.LEAST), 5, wide)
    assert wide == {"length": 200, "verified": 200 * 4000}


def test_members_stop_once_their_bound_is_certain():
    g = np.random.default_rng(4)
    at = g.normal(size=(8, 16))
    own = g.integers(0, 8, 8000)
    rows = (1000 * (at[own] + 0.05 * g.normal(size=(8000, 16)))).astype(np.int64)
    anchors = rows[own == 0][:50]
    centre = HN.centres(anchors, 1)
    bound = HN.bounds(rows, centre, HN.angles(anchors, centre).max(axis=0))[:, 0]
    products = anchors @ rows.T
    assert (products <= bound[None, :] * V.lengths(anchors)[:, None]).all()
    members = HN.Members(anchors, np.zeros(50, int), np.full((50, 1), V.LEAST), np.full((50, 1), V.LAST), 5, True)
    counted = {}
    HN.walk(members, rows, np.arange(8000), np.zeros(8000, int), bound, counted)
    who, _, score, name = members.result()
    got = sorted(zip(who.tolist(), score.tolist(), name.tolist()))
    assert got == sorted((q, int(products[q, n]), n) for q in range(50)
                         for n in sorted(range(8000), key=lambda n: (-products[q, n], n))[:5])
    assert counted["products"] < 50 * 8000 / 2
