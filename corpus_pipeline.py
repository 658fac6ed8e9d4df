"""A training corpus from raw documents: five stages, each one operator over all its predecessor kept.

Each stage takes and returns the columns of ``documents`` (the last returns
packed pieces).  ``run`` writes what each stage keeps as Parquet in the shared
checkpoint folder and reads it again, so no stage computes another's work anew
and a lost executor costs no more than its tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import language, packing, quality, simhash, substring_dedup
from rivulet.llm.common import documents, small_batches, vocabulary
from rivulet.session import materialize, ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The rows that a stage's SQL cannot express: compression, fingerprints, indexes, packing.
ORACLE_SQL = None


def _ready(spark: SparkSession) -> None:
    ship_package(spark)
    small_batches(spark)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose length, repeats and distributions pass; the references are fitted on this stage's input."""
    _ready(spark)
    whole = docs.select("doc_id", "text", "lang", F.struct(*docs.columns).alias("document"))
    return quality.quality(whole, keep=("document",)).where("kept").select("document.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told by a margin; the dictionaries are fitted on this stage's labelled rows."""
    _ready(spark)
    return language.predict(docs, language.fit(docs)).where(~F.col("rejected")).select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document (by id, then place in the table) of each group of near copies."""
    _ready(spark)
    # written once: the numbers are read twice, and a frame that is computed twice may number its rows in another order
    placed = materialize(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*docs.columns).alias("document")), "numbered", "zstd")
    named = placed.select(F.struct(F.col("document.doc_id").alias("doc_id"), "row").alias("doc_id"), F.col("document.text").alias("text"))
    groups = simhash.near_duplicates(named)
    gone = groups.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id.row").alias("row"))
    return placed.join(gone.hint("shuffle_hash"), "row", "left_anti").select("document.*")


def substring_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur again; documents of which nothing is left go."""
    _ready(spark)
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    kept = substring_dedup.remove_repeats(docs, carry=rest, verbatim=True)
    new = {"doc_id": F.col("doc_id"), "text": F.col("kept")} | {c: F.col("carried")[c] for c in rest}
    if "n_chars" in new:
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(new["n_chars"])
    return (kept.where((F.col("n_removed") == 0) | (F.col("kept") != ""))
            .select(*(new[c].alias(c) for c in docs.columns)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    _ready(spark)
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_dedup),
    ("substring dedup", substring_removal),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``: the pieces of the last one."""
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, name.lower().replace(" ", "-"))
    return docs
