"""The pipeline as a whole, and each stage on the rows that its predecessor kept."""

import pytest
from odd_docs import ODD, make_docs
from pyspark.sql import functions as F
from test_repeats import slow_words
from test_simhash import slow_components, slow_fingerprint

import corpus_pipeline as P


def test_each_stage_works_on_what_its_predecessor_kept(spark, docs):
    columns, before = docs.columns, docs
    kept = {}
    for name, stage in P.STAGES[:-1]:
        after = stage(spark, before, "")
        assert after.columns == columns
        kept[name] = (before.collect(), after.collect())
        before = spark.createDataFrame(kept[name][1], docs.schema)
    for name in ("quality rules", "language ID"):
        old, new = kept[name]
        assert set(new) <= set(old) and len(new) >= 0.7 * len(old)
    old, new = kept["SimHash near-dedup"]
    first = dict(slow_components([(r["doc_id"], slow_fingerprint(r["text"])) for r in old]))
    assert sorted(r["doc_id"] for r in new) == sorted(i for i, c in first.items() if i == c)
    old, new = kept["substring dedup"]
    want = {r["doc_id"]: (r["text"] if not gone else text)
            for r, (_, gone, text) in zip(old, slow_words([r["text"] for r in old]), strict=True) if not gone or text}
    assert {r["doc_id"]: r["text"] for r in new} == want
    assert all(r["n_chars"] == len(r["text"]) for r in new)
    pieces = P.STAGES[-1][1](spark, before, "").groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"))
    assert all(r["n"] == r["all"] for r in pieces.collect()) and pieces.count() == len(new)


def test_run_gives_the_pieces_of_the_last_stage(spark):
    out = P.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 100


@pytest.mark.parametrize("stage", range(5))
def test_odd_rows_and_empty_tables(spark, stage):
    docs = make_docs(spark, [*ODD, None], ids=[None, 1, 1, *range(3, len(ODD)), None], langs=[None, "en"] * (len(ODD) // 2) + ["de"] * (1 + len(ODD) % 2))
    out = P.STAGES[stage][1](spark, docs.withColumn("row", F.lit("clash")), "")
    rows = out.collect()
    if stage < 4:
        assert out.columns == [*docs.columns, "row"]
    if stage == 2:  # one of each group of near copies stays
        groups = slow_components([(i, slow_fingerprint(t)) for i, t in enumerate([*ODD, None])])
        assert len(rows) == len({c for _, c in groups})
    assert P.STAGES[stage][1](spark, docs.limit(0), "").count() == 0


def test_simhash_stage_does_not_depend_on_how_often_its_input_is_computed(spark, docs):
    """Input that comes from a shuffle, which is cut otherwise for each set of columns that a reader asks for."""
    copies = docs.withColumn("doc_id", F.col("doc_id") + 10_000).where(F.col("doc_id") % 3 == 0)
    rows = docs.unionByName(copies).withColumn("__row", F.lit("the user's"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        dealt = rows.groupBy("doc_id").agg(*[F.first(c).alias(c) for c in rows.columns if c != "doc_id"])
        kept = P.simhash_dedup(spark, dealt, "")
        found = sorted(r["doc_id"] for r in kept.select("doc_id").collect())
        whole = kept.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    first = slow_components([(r["doc_id"], slow_fingerprint(r["text"])) for r in rows.collect()])
    assert found == sorted(i for i, c in first if i == c) == sorted(r["doc_id"] for r in whole)
    assert {r["__row"] for r in whole} == {"the user's"}


def test_quality_stage_keeps_columns_of_any_name(spark, docs):
    named = docs.withColumn("document", F.lit("a")).withColumn("__document", F.lit("b"))
    kept = P.quality_rules(spark, named, "")
    assert kept.columns == named.columns
    assert {(r["document"], r["__document"]) for r in kept.collect()} == {("a", "b")}
