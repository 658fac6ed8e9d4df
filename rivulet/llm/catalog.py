"""Registered queries of the subpackage: each operator over its whole table."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (hard_negatives, language, merkle, oracles, packing, piece_codec, quality, sharding, simhash, spotsigs, substring_dedup, suffix_dedup,
               token_counts, top_products)
from .common import documents, model_file, small_batches, vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {"op1_substring_dedup": oracles.SUBSTRING_DEDUP, "op8_suffix_dedup": oracles.SUFFIX_DEDUP,
                       "op11_top_products": oracles.TOP_PRODUCTS, "op12_hard_negatives": oracles.HARD_NEGATIVES, "op13_merkle": oracles.MERKLE}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every 35-word window that occurs again, removed."""
    kept = substring_dedup.remove_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


@query
def op2_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the rebuilt model, their parity with sentencepiece, and the decoded text."""
    coded = piece_codec.encode_decode(documents(spark, sf_dir), model_file("piece_bpe_32k.model"))
    return coded.select("doc_id", "n_tokens", "ids_crc32", "parity", F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Harmonic packing of every document into sequences of 2048 tokens."""
    return packing.pack(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and the components of those that differ in at most two bits."""
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain counts and the verdict by distribution distance."""
    judged = quality.quality(documents(spark, sf_dir))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "kept", "char_distance", "word_distance")


@query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty shards of near equal size by a rebalanced map of virtual slots."""
    placed = sharding.shard(documents(spark, sf_dir))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("ordinal").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


@query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those outside the held-out third."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang").withColumn(
        "held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False)))
    found = language.predict(docs, language.fit(docs.where(~F.col("held_out"))))
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every 100-byte string that also starts earlier, removed."""
    kept = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by rank-synchronous merging."""
    counted = token_counts.token_counts(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


@query
def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness to it and to the next document."""
    return spotsigs.with_next(documents(spark, sf_dir))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


@query
def op11_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest inner products of every twentieth vector with all others, by norm buckets."""
    return top_products.top_products(embeddings(spark, sf_dir), F.col("vec_id") % 20 == 0)


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, by shared lists of its cluster."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(embeddings(spark, sf_dir), F.col("vec_id") % 50 == 0, label)


@query
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of the documents by language, a proof of every leaf, and the root that a third of them, tampered with, give."""
    docs = documents(spark, sf_dir)
    changed = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaves = docs.select("doc_id", F.col("lang").alias("grp"), merkle.digest([F.col(f) for f in merkle.FIELDS]).alias("leaf"),
                         F.when(tampered, merkle.digest([changed if f == "text" else F.col(f) for f in merkle.FIELDS])).alias("tampered"))
    found = merkle.manifest(leaves, ["doc_id"])
    if found.root is None:
        return leaves.select("doc_id", "leaf", *[F.lit("").alias(c) for c in ("subroot", "root", "proof_sha256", "folded_root")],
                             F.lit(False).alias("verified")).limit(0)
    proved = merkle.descend(found).withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return proved.select("doc_id", "leaf", "subroot", F.lit(found.root).alias("root"),
                         merkle.siblings_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == found.root).alias("verified"))
