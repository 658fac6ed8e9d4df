"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task turns into numpy arrays at once.
CHUNK_BYTES = 1 << 21


#: Rows that Spark hands to Python at once.  Texts may be long, and a batch is held whole on both sides.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of Arrow batches for this session, whose rows hold whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary(name: str) -> str:
    """Content of a public tokenizer's file; read on the driver, so executors need no copy of it."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def model_file(name: str) -> bytes:
    """Content of a public tokenizer's binary model, read on the driver."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of each text; null stays None."""
    return column.cast(pa.binary()).to_pylist()


def chunks(sizes: Sequence[int], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring rows of about ``limit`` bytes; a larger row has a range of its own."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def table_bytes(docs: DataFrame, text: str = "text") -> int:
    """Total UTF-8 bytes of a text column (one aggregate)."""
    return docs.agg(F.sum(F.octet_length(F.col(text))).alias("n")).first()["n"] or 0
