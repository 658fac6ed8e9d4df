import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_docs import ODD, make_docs
from pyspark.sql import functions as F

from rivulet.llm import sharding as S
from rivulet.session import scratch_path


def check(rows, texts, shards):
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    held = {}
    for r in rows:
        assert 0 <= r["shard"] < shards
        held.setdefault(r["shard"], []).append(r["ordinal"])
    assert all(sorted(o) == list(range(len(o))) for o in held.values())


def test_whole_table(docs):
    rows = S.shard(docs, shards=8).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 8)
    sums = Counter()
    for r in rows:
        sums[r["shard"]] += r["size"]
    assert max(sums.values()) - min(sums.values()) <= 0.02 * sum(sums.values()) / 8


def test_odd_rows(spark):
    ids = [None, 1, 1, *range(3, len(ODD))]
    docs = make_docs(spark, ODD, ids=ids).withColumn("slot", F.lit("clash")).withColumn("shard", F.lit("clash"))
    check(S.shard(docs).collect(), list(zip(ids, ODD, strict=True)), S.SHARDS)
    assert S.shard(docs.limit(0)).count() == 0
    same = make_docs(spark, ["again"] * 50, ids=[7] * 50)
    check(S.shard(same).collect(), [(7, "again")] * 50, S.SHARDS)


def test_the_map_is_versioned_and_edited(spark, docs):
    path = scratch_path(spark, "map")
    S.write_map(spark, path, 0, [s % 4 for s in range(64)])
    S.shard(docs, shards=4, slots=64, map_path=path).count()
    first = {r["slot"]: r["shard"] for r in S.read_map(spark, path, 1).collect()}
    S.shard(docs, shards=4, slots=64, map_path=path).count()
    second = {r["slot"]: r["shard"] for r in S.read_map(spark, path).collect()}
    assert {r["slot"]: r["shard"] for r in S.read_map(spark, path, 0).collect()} == {s: s % 4 for s in range(64)}
    assert first == second and set(first) == set(range(64))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=80), st.integers(1, 6))
def test_rebalancing_narrows_the_gap(sizes, shards):
    dealt = [s % shards for s in range(len(sizes))]
    places = S.rebalance(dealt, sizes, shards)

    def gap(p):
        load = [0] * shards
        for x, s in zip(p, sizes, strict=True):
            load[x] += s
        return max(load) - min(load)

    assert len(places) == len(sizes) and all(0 <= p < shards for p in places)
    assert gap(places) <= gap(dealt) and gap(places) <= max(sizes, default=0)


def test_only_dataframe_functions(docs):
    plan = S.shard(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|ExistingRDD", plan)


def test_a_record_repeated_whole_is_spread(spark, docs):
    one = docs.where(F.octet_length("text") > 2000).limit(1).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("copy")
    table = docs.unionByName(one)
    rows = S.shard(table).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in table.collect()], S.SHARDS)
    sums, slots = Counter(), Counter()
    for r in rows:
        sums[r["shard"]] += r["size"]
        slots[r["virtual_slot"]] += 1
    assert max(sums.values()) - min(sums.values()) <= max(r["size"] for r in rows) and max(slots.values()) <= 10


def slow_shard(texts, slot_of, slots, shards):
    """The rows of every slot, the map that moves slots between the fullest and the emptiest shard, and the ordinals."""
    held = {}
    for row in texts:
        held.setdefault(slot_of[row], []).append(row)
    size = [sum(len(t.encode()) + 16 for _, t in held.get(s, [])) for s in range(slots)]
    place = [s % shards for s in range(slots)]
    while True:
        load = [sum(z for z, p in zip(size, place, strict=True) if p == k) for k in range(shards)]
        high, low = load.index(max(load)), load.index(min(load))
        gap, best = load[high] - load[low], None
        for s in range(slots):
            for back in [None, *(o for o in range(slots) if place[o] == low and size[o])]:
                moved = size[s] - (size[back] if back is not None else 0)
                if place[s] == high and size[s] and 0 < moved < gap and (best is None or abs(2 * moved - gap) < best):
                    best, pair = abs(2 * moved - gap), (s, back)
        if best is None:
            break
        place[pair[0]] = low
        if pair[1] is not None:
            place[pair[1]] = high
    return load


def test_map_and_ordinals_equal_a_slow_recount(spark, docs):
    """Sums of slots, the loads that the edited map gives, and each record's ordinal, counted row by row."""
    path = scratch_path(spark, "map")
    S.write_map(spark, path, 0, [s % 4 for s in range(32)])
    few = docs.where("doc_id < 60").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = S.shard(few, shards=4, slots=32, map_path=path).collect()
    texts = [tuple(r) for r in few.collect()]
    slot_of = {tuple(r)[:2]: r["slot"] for r in few.select("doc_id", "text", F.pmod(F.xxhash64(
        "doc_id", F.crc32(F.col("text").cast("binary"))), F.lit(32)).cast("int").alias("slot")).collect()}
    by_id = dict(texts)
    assert {(r["doc_id"], r["virtual_slot"]) for r in rows} == {(i, slot_of[i, t]) for i, t in texts}
    load = [0] * 4
    for r in rows:
        load[r["shard"]] += len(by_id[r["doc_id"]].encode()) + 16
    assert sorted(load) == sorted(slow_shard(texts, slot_of, 32, 4))
    places = {r["slot"]: r["shard"] for r in S.read_map(spark, path, 1).collect()}
    assert all(places[r["virtual_slot"]] == r["shard"] for r in rows)
    for shard in range(4):
        own = sorted((r["virtual_slot"], r["doc_id"], r["ordinal"]) for r in rows if r["shard"] == shard)
        assert [o for _, _, o in own] == list(range(len(own)))
