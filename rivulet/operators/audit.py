"""Null audit, first-seen dedup (exact and Bloom) and the audit summary.

All dedup forms are skew-safe: the per-key work is a partial (map-side)
aggregate, and rows are matched back on ``(key, seq)``, which is unique, so a
key holding a third of the table never lands in one task.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import BLOOM_N_ITEMS, BLOOM_P
from ..functions.exprs import bloom_geometry, hex_mod, key_text

log = logging.getLogger("rivulet.audit")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Normalise float NaN to SQL NULL (pandas treats both as missing)."""
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not fl:
        return df
    return df.withColumns({c: F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c)) for c in fl})


def drop_null_any(df: DataFrame) -> DataFrame:
    """Drop rows with a null (or NaN) in any column, label included."""
    return nan_to_null(df).na.drop(how="any")


def drop_null_subset(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return nan_to_null(df).na.drop(how="any", subset=list(subset))


def first_seen(df: DataFrame, key: str, seq: str) -> DataFrame:
    """``(key, seq)`` of the first occurrence of every key (partial aggregate)."""
    return df.groupBy(key).agg(F.min(seq).alias(seq))


def first_seen_dedup(df: DataFrame, key: str, seq: str) -> DataFrame:
    """Exact first-seen dedup: keep the row with the smallest ``seq`` per key.

    ``seq`` must be unique (a row sequence such as an event id).
    """
    return matching(df, first_seen(df, key, seq), key, seq)


def matching(df: DataFrame, kept: DataFrame, key: str, seq: str) -> DataFrame:
    """Rows of ``df`` whose key and sequence are in ``kept``; a null key equals a null key."""
    k = kept.select(F.col(key).alias("_key"), F.col(seq).alias("_seq"))
    return df.join(k, F.col(key).eqNullSafe(F.col("_key")) & (F.col(seq) == F.col("_seq")), "left_semi")


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Per key: rows seen and rows a first-seen dedup would drop."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("n_duplicates", F.col("n_rows") - 1))


def bloom_bits(df: DataFrame, key: str, m: int, k: int) -> DataFrame:
    """Explode the k distinct Bloom bit positions of each row's key.

    Bit i is ``(md5(s) + i * sha1(s)) mod m`` with ``s`` the key's text; both
    digests are reduced mod m first, which is exact.  A null key has the text
    ``nan``, as a missing index label has.
    """
    s = F.coalesce(key_text(key), F.lit("nan"))
    h1 = hex_mod(F.md5(s), m, 32)
    h2 = hex_mod(F.sha1(s), m, 40)
    bits = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                                        lambda i: F.pmod(h1 + i.cast("long") * h2, F.lit(m))))
    return df.withColumn("_bit", F.explode(bits))


def bloom_survivors(df: DataFrame, key: str, seq: str, n_items: int,
                    p: float = 0.01) -> DataFrame:
    """``(key, seq)`` of the rows a sequential Bloom-filter dedup would keep.

    Exact parallel form of "drop a row iff all its bits are already set":
    a dropped row's bits are all set already, so the filter before row r is
    the union of the bits of *every* earlier row.  With ``first(b)`` the
    smallest sequence that touches bit b, row r is dropped iff
    ``max(first(b) for b in bits(r)) < seq(r)``.  Later rows of a key share its
    bits, so only the first row of each key can survive: the work runs over
    distinct keys, never over a hot key's rows.
    """
    m, k = bloom_geometry(n_items, p)
    firsts = first_seen(df, key, seq)
    bits = bloom_bits(firsts, key, m, k)
    bit_first = bits.groupBy("_bit").agg(F.min(seq).alias("_first"))
    worst = (bits.join(bit_first, "_bit")
             .groupBy(key, seq).agg(F.max("_first").alias("_last_first")))
    return worst.where(F.col("_last_first") >= F.col(seq)).select(key, seq)


def bloom_dedup(df: DataFrame, key: str, seq: str, n_items: int, p: float = 0.01) -> DataFrame:
    """Rows kept by the Bloom-filter first-seen dedup (false positives included)."""
    return matching(df, bloom_survivors(df, key, seq, n_items, p), key, seq)


def bloom_capacity(df: DataFrame, key: str, n_items: int) -> DataFrame:
    """One row: approximate distinct keys vs the filter's design size.

    A filter sized below the number of distinct keys saturates and starts
    dropping good rows as false positives (the reference sized its filters
    independently of the input).
    """
    return df.agg(F.approx_count_distinct(key).alias("distinct_keys")).withColumns(
        {"n_items": F.lit(int(n_items)), "undersized": F.col("distinct_keys") > F.lit(int(n_items))})


def audit(df: DataFrame, key: str, seq: str, mode: str = "exact",
          n_items: int = BLOOM_N_ITEMS, p: float = BLOOM_P, check_capacity: bool = True) -> DataFrame:
    """Null drop then first-seen dedup -- the epoch-0 audit, run once."""
    clean = drop_null_any(df)
    if mode == "exact":
        return first_seen_dedup(clean, key, seq)
    if mode == "bloom":
        if check_capacity:
            cap = bloom_capacity(clean, key, n_items).collect()[0]
            if cap["undersized"]:
                log.warning("Bloom filter sized for %d items sees ~%d distinct keys: expect false-positive drops",
                            n_items, cap["distinct_keys"])
        return bloom_dedup(clean, key, seq, n_items, p)
    raise ValueError(f"unknown dedup mode {mode!r}")


def audit_summary(df: DataFrame, key: str, seq: str, mode: str = "exact",
                  n_items: int = BLOOM_N_ITEMS, p: float = BLOOM_P) -> DataFrame:
    """One row: total, null rows, duplicates dropped, total dropped, retention %.

    Exact mode is a single aggregate: first-seen dedup keeps one row per
    distinct key, so the rows kept are ``count(DISTINCT key)`` over the non-null
    rows (map-side dedup of keys, so a hot key is one row per partition, and
    no full row is shuffled).  Bloom mode counts the survivors, which are
    computed over distinct keys.
    """
    base = nan_to_null(df)
    any_null = F.lit(False)
    for c in base.columns:
        any_null = any_null | F.col(c).isNull()
    flagged = base.withColumn("_null", any_null)
    if mode == "exact":
        counts = flagged.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if("_null").alias("null_rows"),
                             F.count_distinct(F.when(~F.col("_null"), F.col(key))).alias("_kept"))
    else:
        survivors = bloom_survivors(flagged.where(~F.col("_null")), key, seq, n_items, p)
        marked = flagged.select("_null", F.lit(None).cast("long").alias("_s")).unionByName(
            survivors.select(F.lit(None).cast("boolean").alias("_null"), F.lit(1).cast("long").alias("_s")))
        counts = marked.agg(F.count_if(F.col("_null").isNotNull()).alias("total_rows"),
                            F.count_if(F.col("_null") == F.lit(True)).alias("null_rows"),
                            F.count("_s").alias("_kept"))
    dups = F.col("total_rows") - F.col("null_rows") - F.col("_kept")
    return (counts.withColumn("duplicates_dropped", dups)
            .withColumn("total_dropped", F.col("null_rows") + F.col("duplicates_dropped"))
            .withColumn("retention_pct", F.when(F.col("total_rows") > 0, F.round(
                F.lit(100.0) * (F.col("total_rows") - F.col("total_dropped")) / F.col("total_rows"), 6))
                .otherwise(F.lit(0.0)))
            .select("total_rows", "null_rows", "duplicates_dropped", "total_dropped", "retention_pct"))
