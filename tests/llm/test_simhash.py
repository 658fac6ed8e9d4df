import random

import xxhash
from odd_docs import ODD, make_docs
from pyspark.sql import functions as F

from rivulet.llm.simhash import components, fingerprint, home_anchors, links, near_anchors, near_duplicates


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps):
    """Least id of each row's component; rows are (id, fingerprint)."""
    name = list(range(len(fps)))

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i][1] ^ fps[j][1]).count("1") <= 2:
                name[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(fps):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, least.get(find(i))) for i, (d, _) in enumerate(fps) if d is not None)


def result(docs):
    rows = near_duplicates(docs).collect()
    return rows, sorted((r["doc_id"], r["component_id"]) for r in rows if r["doc_id"] is not None)


def test_whole_table(docs):
    rows, got = result(docs)
    fps = [(r["doc_id"], slow_fingerprint(r["text"])) for r in docs.collect()]
    assert sorted((r["doc_id"], r["fp"] % 2**64) for r in rows) == sorted(fps)
    assert got == slow_components(fps)


def test_odd_rows(spark):
    ids = [None, 1, 1, *range(3, len(ODD))]
    docs = make_docs(spark, ODD, ids=ids).withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(0))
    rows, got = result(docs)
    assert len(rows) == len(ODD)
    assert got == slow_components([(i, slow_fingerprint(t)) for i, t in zip(ids, ODD, strict=True)])
    assert near_duplicates(docs.limit(0)).count() == 0


def test_links_are_all_close_pairs(spark):
    rng = random.Random(5)
    fps = {0, 2**64 - 1}
    for _ in range(40):
        centre = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            fps.add(centre ^ sum(1 << b for b in set(rng.choices(range(64), k=rng.randint(0, 3)))))
    fps = sorted(fps)
    frame = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long")
    got = {frozenset((r["a"] % 2**64, r["b"] % 2**64)) for r in links(frame).collect()}
    assert got == {frozenset((a, b)) for a in fps for b in fps if a < b and bin(a ^ b).count("1") <= 2}


def test_every_close_pair_meets_at_a_home_anchor():
    import numpy as np

    from rivulet.llm.simhash import _remainder
    rng = random.Random(7)
    for _ in range(300):
        u = rng.getrandbits(64)
        v = u ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 2)))
        syn = tuple(int(_remainder(np.array([v >> s & (1 << 23) - 1]))[0]) for s in (0, 23))
        assert int(home_anchors(np.array([u], np.uint64))[0]) in near_anchors(v, syn).tolist()


def test_components_of_long_chains(spark):
    pairs = [(i + 1, i) for i in range(200)] + [(1000 + i, 999 + i) for i in range(1, 50)] + [(500, 300), (500, 400)]
    frame = spark.createDataFrame(pairs, "a long, b long").repartition(16)
    got = {r["node"]: r["root"] for r in components(frame).collect()}
    assert all(got[i] == 0 for i in range(1, 201)) and all(got[1000 + i] == 1000 for i in range(1, 50))
    assert got[400] == got[500] == 300


def test_fingerprint_counts_repeats():
    for t in ["a b c a b c a b c d", "x", "x y", "A B c", "é É z"]:
        assert fingerprint(t.encode()) == slow_fingerprint(t)
