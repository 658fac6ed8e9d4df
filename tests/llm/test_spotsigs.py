import hashlib

import pytest
import xxhash
from odd_docs import ODD, make_docs
from pyspark.sql import functions as F

from rivulet.llm import spotsigs as S

COLUMNS = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def slow_spots(text):
    """Signatures as tuples of words."""
    words = S.WORD.findall(text.lower())
    out = set()
    for i, w in enumerate(words):
        bare = len(words[:i + 1]) > S.GAP and not S.ANCHORS & set(words[i - S.GAP:i + 1])
        if w in S.ANCHORS or (bare and xxhash.xxh64_intdigest(w) % S.SHARE == 0):
            chain = [x for x in words[i + 1:] if x not in S.ANCHORS][:S.CHAIN]
            if len(chain) == S.CHAIN:
                out.add((w, *chain))
    return out or {("", *words, "" if words else text)}


def slow(rows):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0), reverse=True)
    out = []
    for k, i in enumerate(order):
        text, following = rows[i][1] or "", rows[order[(k + 1) % len(order)]][1] or ""
        half = len(text) // 2
        new = text[:len(text) - half] + following[:half]
        a, b, c = slow_spots(text), slow_spots(new), slow_spots(following)
        out.append((rows[i][0], len(text), hashlib.sha256(new.encode()).hexdigest(),
                    round(len(a & b) / len(a | b), 9), round(len(a & c) / len(a | c), 9)))
    return out


def got(frame):
    return [(r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in frame.collect()]


@pytest.mark.parametrize("partition_bytes", [8 << 20, 40_000])
def test_whole_table(docs, partition_bytes):
    frame = S.with_next(docs, partition_bytes=partition_bytes)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(got(frame)) == sorted(slow(rows))
    prints = {r["doc_id"]: r["fingerprint"] for r in frame.collect()}
    by_text = {}
    for i, t in rows:
        assert by_text.setdefault(t, prints[i]) == prints[i]
    assert sum(r["near_edited"] > r["near_next"] for r in frame.collect()) > 0.8 * len(rows)


def test_odd_rows(spark):
    ids = [None, 40, *range(len(ODD) - 2)]
    docs = make_docs(spark, ODD, ids=ids).withColumn("first", F.lit("clash")).withColumn("part", F.lit("clash"))
    frame = S.with_next(docs, partition_bytes=500)
    assert sorted(got(frame), key=str) == sorted(slow(list(zip(ids, ODD, strict=True))), key=str)
    assert S.with_next(docs.limit(0)).count() == 0
    one = got(S.with_next(make_docs(spark, ["the quick brown fox"])))
    assert one == slow([(0, "the quick brown fox")])
    repeated = make_docs(spark, ["a the b c", "a the b c", "x"], ids=[5, 5, 5])
    assert S.with_next(repeated).count() == 3


def test_spots_without_a_word_list(docs):
    texts = [" ".join(w for w in S.WORD.findall(r["text"].lower()) if w not in S.ANCHORS) for r in docs.where("lang = 'en' AND n_chars > 800").limit(20).collect()]
    texts = [t for t in texts if len(set(t.split())) > 80]  # a repeated line has few spots
    assert len(texts) > 5
    for a, b in zip(texts, texts[1:], strict=False):
        own, changed = S.signatures(a), S.signatures(S.edited(a, b))
        assert len(own) > 5 and S.likeness(own, changed) > 0.1 > S.likeness(own, S.signatures(b))


def test_likeness_is_pruned_by_length():
    a, b = S.signatures("the cat sat of dog ran"), S.signatures("the cat sat")
    assert S.likeness(a, b) > 0 and S.likeness(a, b, floor=0.9) == 0.0
    assert S.likeness(a, a) == 1.0


def test_fingerprints_are_sets(docs):
    for r in S.fingerprints(docs).limit(20).collect():
        assert len(set(r["signatures"])) == len(r["signatures"]) and len(r["fingerprint"]) == 32


@pytest.mark.parametrize("threshold", [0.8, 0.5])
def test_similar_pairs_are_all_pairs(spark, threshold):
    import random
    rng = random.Random(4)
    sets = []
    for _ in range(25):
        base = [rng.randrange(400) for _ in range(rng.randint(1, 40))]
        sets += [sorted({x if rng.random() > 0.08 else rng.randrange(10**6) for x in base} | {7}) for _ in range(rng.randint(1, 5))]
    rows = [(f"{i:03d}", s) for i, s in enumerate(sets)]
    frame = spark.createDataFrame([*rows, rows[0]], "fingerprint string, signatures array<long>")
    got = {(r["a"], r["b"]) for r in S.similar_pairs(frame, threshold).collect()}
    want = set()
    for i, (f, a) in enumerate(rows):
        for g, b in rows[i + 1:]:
            if len(set(a) & set(b)) >= threshold * len(set(a) | set(b)) - 1e-9:
                want.add((f, g))
    assert got == want and len(want) > 10
    assert S.similar_pairs(frame.limit(0)).count() == 0
