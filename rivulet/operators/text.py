"""Text features, phrase drivers and priority alerts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import N_HASH_FEATURES, SEGMENT_NEGATIVE, SEGMENT_POSITIVE, TOP_ALERTS, TOP_PHRASES
from ..functions.exprs import hex_mod
from ..llm.common import chunks
from ..functions.text import default_stop_words, drop_stop_words, tokens, uni_and_bigrams

N_FEATURES = N_HASH_FEATURES
#: What lies between the tokens of ``TOKEN_PATTERN``, and their least length: runs of letters, numbers and underscores.
NO_WORD = r"[^\p{L}\p{N}_]+"
MIN_TOKEN = 2
#: Bytes of text that a task cuts into words at once.
PART_BYTES = 1 << 20


def bucket_of(token, n_features: int = N_FEATURES):
    """Feature bucket of a token: ``md5(token) mod n_features`` (reproducible in SQL)."""
    return hex_mod(F.md5(token), n_features, 32)


def bucket_of_py(token: str, n_features: int = N_FEATURES) -> int:
    return int.from_bytes(hashlib.md5(token.encode()).digest()) % n_features


def _buckets(tokens: pa.Array, n_features: int) -> np.ndarray:
    """``bucket_of_py`` of many tokens; a power of two needs only the digests' last bytes."""
    digests = [hashlib.md5(t.encode()).digest() for t in tokens.to_pylist()]
    if n_features & (n_features - 1) == 0 and n_features < 1 << 63:
        return (np.frombuffer(b"".join(d[8:] for d in digests), ">u8") % np.uint64(n_features)).astype(np.int64)
    return np.array([int.from_bytes(d) % n_features for d in digests], np.int64)


def _counted(texts: pa.Array, n_features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and count of every bucket of a batch of lower-case texts, in order of row and bucket.

    Arrow cuts the texts and numbers their distinct tokens; each of these is hashed once for the batch.
    """
    words = pc.split_pattern_regex(texts, NO_WORD)
    found = words.flatten().dictionary_encode()
    long = pc.utf8_length(found.dictionary).to_numpy(zero_copy_only=False) >= MIN_TOKEN
    at = found.indices.to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(texts)), words.value_lengths().fill_null(0).to_numpy())
    kept = long[at] if len(at) else np.zeros(0, bool)
    keys = rows[kept] * n_features + (_buckets(found.dictionary, n_features)[at[kept]] if len(at) else 0)
    keys.sort()
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[first, len(keys)]).astype(np.float64)
    return keys[first] // n_features, keys[first] % n_features, counts


def _normalised(texts: pa.Array, n_features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and value: the counts divided by their row's L2 norm."""
    rows, at, counts = _counted(texts, n_features)
    norms = np.sqrt(np.bincount(rows, counts * counts, minlength=len(texts)))
    return rows, at, counts / norms[rows]


def _parts(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """First row and texts of neighbouring rows of about ``PART_BYTES``: their words, many
    times as large as they are, are only held for one part of a batch."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for start, end in chunks(sizes.tolist(), PART_BYTES):
        yield start, texts.slice(start, end - start)


def with_bow(df: DataFrame, text: str, name: str = "bow", n_features: int = N_FEATURES) -> DataFrame:
    """Attach each row's hashed bag of words: ``array<struct<bucket, value>>``, L2-normalised.

    Lower-case word tokens, counts per bucket (unsigned), divided by the row's
    L2 norm; null text has an empty bag.  One Arrow function per batch of rows:
    nothing is shuffled and rows that share a key stay apart.
    """
    @F.arrow_udf("array<struct<bucket: bigint, value: double>>")
    def bag(texts: pa.Array) -> pa.Array:
        sizes, buckets, found = [np.zeros(1, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for _, part in _parts(texts):
            rows, at, values = _normalised(part, n_features)
            sizes.append(np.bincount(rows, minlength=len(part)))
            buckets.append(at)
            found.append(values)
        cells = pa.StructArray.from_arrays([pa.array(np.concatenate(buckets)), pa.array(np.concatenate(found))], names=["bucket", "value"])
        return pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(sizes)).astype(np.int32)), cells)

    return df.withColumn(name, bag.asNondeterministic()(F.lower(F.col(text))))  # evaluated once, wherever it is read


def hashed_bow(df: DataFrame, key: str, text: str, n_features: int = N_FEATURES) -> DataFrame:
    """Sparse hashed bag of words, one row per bucket: ``(key, bucket, value)`` (no shuffle; rows leave Arrow as columns)."""
    rows = df.select(F.col(key), F.lower(F.col(text)).alias("text" if key != "text" else "_text"))
    schema = T.StructType([rows.schema.fields[0], T.StructField("bucket", T.LongType()), T.StructField("value", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, part in _parts(batch.column(1)):
                at, buckets, values = _normalised(part, n_features)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at + start)), pa.array(buckets), pa.array(values)],
                                                 names=[key, "bucket", "value"])

    return rows.mapInArrow(run, schema)


def coerce_text(df: DataFrame, text: str) -> DataFrame:
    """Cast the text column to string (null stays null and is routed by the contract)."""
    return df.withColumn(text, F.col(text).cast("string"))


def _dense_weights(weights: Mapping[str, float] | np.ndarray, n_features: int) -> np.ndarray:
    """A dense vector of weights, from one or from words with weights."""
    if not isinstance(weights, Mapping):
        return np.asarray(weights, dtype=np.float64)
    dense = np.zeros(n_features)
    for w, v in weights.items():
        dense[bucket_of_py(w, n_features)] += float(v)
    return dense


def linear_text_decision(df: DataFrame, text: str, weights: Mapping[str, float] | np.ndarray, intercept: float,
                         name: str = "decision", n_features: int = N_FEATURES) -> DataFrame:
    """Attach ``b + sum(value * w[bucket])``, row by row.

    The model is a dense vector of ``n_features`` weights (or words with
    weights, hashed into one) sent once to each executor; rows without a
    weighted token get the intercept.  Bag and product are made in one Arrow
    function, so the bag never leaves it; no shuffle and no join.
    """
    shared = df.sparkSession.sparkContext.broadcast(_dense_weights(weights, n_features))

    @F.arrow_udf("double")
    def decide(texts: pa.Array) -> pa.Array:
        dots = [np.zeros(0)]
        for _, part in _parts(texts):
            rows, at, values = _normalised(part, n_features)
            dots.append(np.bincount(rows, values * shared.value[at], minlength=len(part)))
        return pa.array(intercept + np.concatenate(dots))

    return df.withColumn(name, decide.asNondeterministic()(F.lower(F.col(text))))  # evaluated once, wherever it is read


def linear_bow_decision(df: DataFrame, weights: Mapping[str, float] | np.ndarray, intercept: float, bow: str = "bow",
                        name: str = "decision", n_features: int = N_FEATURES) -> DataFrame:
    """The same from a bag of words that is at hand (``with_bow``)."""
    shared = df.sparkSession.sparkContext.broadcast(_dense_weights(weights, n_features))

    @F.arrow_udf("double")
    def decide(buckets: pa.Array, values: pa.Array) -> pa.Array:
        sizes = buckets.value_lengths().fill_null(0).to_numpy()
        products = shared.value[buckets.flatten().to_numpy()] * values.flatten().to_numpy()
        return pa.array(intercept + np.bincount(np.repeat(np.arange(len(sizes)), sizes), products, minlength=len(sizes)))

    return df.withColumn(name, decide(F.col(f"{bow}.bucket"), F.col(f"{bow}.value")))


def phrase_drivers(df: DataFrame, text: str, label: str, top_n: int = TOP_PHRASES,
                   stop_words: Sequence[str] | None = None,
                   segments: Mapping[int, str] | None = None) -> DataFrame:
    """Top phrases per label segment: ``(Segment, Phrase, Frequency)``.

    Lower-case word tokens, stop words removed, unigrams + bigrams of the
    remaining tokens, total count, top ``top_n`` per segment by frequency
    (ties by phrase).  The ``row_number() <= n`` filter is planned with a
    per-partition group limit ahead of the shuffle, so only ``n`` phrases per
    segment and partition move.
    """
    stop = default_stop_words() if stop_words is None else stop_words
    segs = segments or {1: SEGMENT_POSITIVE, 0: SEGMENT_NEGATIVE}
    seg_col = F.create_map(*[x for k, v in segs.items() for x in (F.lit(k), F.lit(v))])[F.col(label)]
    # materialise the filtered tokens once: the bigram lambda reads them per index
    toks = df.select(seg_col.alias("Segment"), drop_stop_words(tokens(text), stop).alias("_t"))
    exploded = toks.select("Segment", F.explode(uni_and_bigrams(F.col("_t"))).alias("Phrase"))
    counts = (exploded.where(F.col("Segment").isNotNull())
              .groupBy("Segment", "Phrase").agg(F.count(F.lit(1)).alias("Frequency")))
    rank = F.row_number().over(Window.partitionBy("Segment")
                               .orderBy(F.desc("Frequency"), F.asc("Phrase")))
    return counts.withColumn("_r", rank).where(F.col("_r") <= top_n).drop("_r")


def priority_alerts(scored: DataFrame, pred: str, conf: str, key: str, n: int = TOP_ALERTS) -> DataFrame:
    """Predicted negatives with the highest confidence (TakeOrderedAndProject)."""
    return scored.where(F.col(pred) == 0).orderBy(F.desc(conf), F.asc(key)).limit(int(n))
