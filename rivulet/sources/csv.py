"""Delimited-text sources and sinks.

Reads take every column as text and leave typing to the contract
(``try_cast``), so one bad token never fails a job or re-types a column.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import NULL_TOKENS, null_if_token
from ..operators.contract import normalise_header
from ..session import materialize

OVERFLOW_COL = "_overflow"
#: Lines of a file that a look at its header takes at most at once.
HEAD_LINES = 64
#: Splits whose offsets (two longs each) are sent to all executors; beyond them rows are shuffled to their offset.
MOST_SPLITS = 2_000_000


def string_schema(columns: Sequence[str], extra: Sequence[str] = ()) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in [*columns, *extra]])


def parse_csv_line(line: str, sep: str = ",") -> list[str]:
    return next(csv.reader(io.StringIO(line), delimiter=sep))


def _reader(spark: SparkSession, schema: T.StructType, header: bool, multiline: bool, sep: str):
    return (spark.read.schema(schema).option("header", header).option("multiLine", multiline)
            .option("escape", '"').option("sep", sep).option("mode", "PERMISSIVE"))


def header_line(spark: SparkSession, path: str, line_no: int = 0, sep: str = ",") -> list[str]:
    """Column names from physical line ``line_no`` of the first file split.

    ``limit`` reads only the first partition, which always starts at offset 0
    of a file, so this touches a few bytes however large the input is.
    """
    lines = [r[0] for r in spark.read.text(path).limit(line_no + 1).collect()]
    if len(lines) <= line_no:
        raise ValueError(f"{path}: fewer than {line_no + 1} lines, no header")
    return parse_csv_line(lines[line_no], sep)


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
             multiline: bool = False, sep: str = ",") -> DataFrame:
    """Header on the first line of every file, checked against ``columns`` file by file.

    Files are split between tasks unless ``multiline`` allows line breaks in
    quoted fields, which makes one task of each file.  A file whose header differs
    in order or names fails the read instead of landing in the wrong columns;
    :func:`read_csv_by_header` reads such folders.
    """
    cols = list(columns) if columns else header_line(spark, path, 0, sep)
    return _reader(spark, string_schema(cols), True, multiline, sep).option("enforceSchema", False).csv(path)


def header_directory(spark: SparkSession, path: str | Sequence[str], line_no: int = 0) -> DataFrame:
    """``file, header``: line ``line_no`` of every file, in a distributed read of the heads only.

    Every split is a task of its own and stops after its first lines, so that
    the files' bodies are not read (where a session fixes the size of its
    partitions, tasks read on to the next file).  A file with fewer lines has a
    null header, one without any line no row.
    """
    one, most, batch = "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes", "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = {k: spark.conf.get(k) for k in (one, batch)}
    spark.conf.set(one, spark.conf.get(most))  # an opened file fills a partition
    spark.conf.set(batch, str(HEAD_LINES))
    alone = spark.conf.get(one) == spark.conf.get(most)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: dict[str, list[str]] = {}
        for rows in batches:
            files, starts = rows.column("file"), rows.column("start").to_numpy()
            for i in np.flatnonzero(starts == 0).tolist():
                head = lines.setdefault(files[i].as_py(), [])
                if len(head) <= line_no:
                    head.append(rows.column("value")[i].as_py())
            if alone and rows.num_rows and (starts[0] > 0 or len(lines[files[0].as_py()]) > line_no):
                break
        if lines:
            heads = [(x + [None] * (line_no + 1))[line_no] for x in lines.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(lines), pa.string()), pa.array(heads, pa.string())], names=["file", "header"])

    try:
        found = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"),
                                             F.col("_metadata.file_block_start").alias("start")).mapInArrow(first, "file string, header string")
        rows = [tuple(r) for r in found.collect()]  # a line for each file
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.createDataFrame(rows, "file string, header string")


def _by_header(directory: DataFrame) -> list[tuple[str, list[str]]]:
    """Files of each distinct header, by header."""
    groups = directory.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect()
    return [(g["header"], g["files"]) for g in groups]


def read_csv_by_header(spark: SparkSession, path: str, multiline: bool = False, sep: str = ",") -> DataFrame:
    """Files whose headers order or choose their columns differently, matched by name (absent columns are null).

    The heads of the files are read first; files of one header are read together.
    """
    out = None
    for header, files in _by_header(header_directory(spark, path)):  # one read for each distinct header
        part = read_csv(spark, files, parse_csv_line(header or "", sep), multiline, sep)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"{path}: no header")
    return out


def read_csv_with(spark: SparkSession, path: str, required: Sequence[str], multiline: bool = False,
                  sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """The rows of the files that have all ``required`` columns, and ``file, missing`` of the files left out.

    The decision is taken from the heads of the files, after the headers are
    normalised, so a file that lacks its target or text is not scanned at all.
    """
    out, skipped, columns = None, [], set()
    for header, files in _by_header(header_directory(spark, path)):
        names = [normalise_header(c) for c in parse_csv_line(header or "", sep)]
        missing = [c for c in required if c not in names]
        if missing:
            skipped += [(f, missing) for f in files]
            continue
        columns.update(names)
        part = read_csv(spark, files, parse_csv_line(header, sep), multiline, sep).toDF(*names)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    left_out = spark.createDataFrame(skipped, "file string, missing array<string>")
    return (spark.createDataFrame([], string_schema(required)) if out is None else out), left_out


def read_csv_preamble(spark: SparkSession, path: str, sep: str = ",",
                      multiline: bool = False) -> DataFrame:
    """Line 0 of each file is a preamble, line 1 the header.

    Spark's ``header`` option drops only line 0, so the true header comes
    through as a data row; it is the row whose every value equals its column
    name, and is filtered out (one per file).
    """
    cols = header_line(spark, path, 1, sep)
    df = _reader(spark, string_schema(cols), True, multiline, sep).csv(path)
    is_header = F.lit(True)
    for c in cols:
        is_header = is_header & F.coalesce(F.col(c) == F.lit(c), F.lit(False))
    return df.where(~is_header)


def read_csv_skip_bad_lines(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                            sep: str = ",", multiline: bool = False) -> DataFrame:
    """Drop rows with too many fields, keep short rows padded with null.

    A sentinel column catches the first surplus field; rows that fill it are
    dropped.  (A trailing *empty* surplus field reads as null and is kept.)
    """
    cols = list(columns) if columns else header_line(spark, path, 0, sep)
    df = _reader(spark, string_schema(cols, [OVERFLOW_COL]), True, multiline, sep).csv(path)
    return df.where(F.col(OVERFLOW_COL).isNull()).drop(OVERFLOW_COL)


def normalise_null_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS,
                          columns: Sequence[str] | None = None) -> DataFrame:
    """Map the pandas default missing-value tokens to SQL NULL on string columns."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    targets = [c for c in (columns or strings) if c in strings]
    return df.withColumns({c: null_if_token(c, tokens) for c in targets}) if targets else df


def with_file_row_index(df: DataFrame, name: str = "row_index", most_broadcast: int = MOST_SPLITS) -> DataFrame:
    """Gap-free 0-based row number in file order (file path, then line order).

    Built from the scan's hidden ``_metadata`` (file path, split start) and
    the per-partition row position: rows of one split are consecutive in one
    partition, so a split's first id is its ``min``.  A first scan counts the
    rows of every split; the offsets (three numbers for a split, that is one
    millionth of the data or less) are sent to the scan's own tasks, so no row
    leaves its partition.  Only beyond ``most_broadcast`` splits are they
    joined by a shuffle.  Columns of ``df`` keep their names and values.
    """
    own = "_".join(["at", *df.columns])  # names that no column has
    split, shift = f"{own}_split", f"{own}_shift"
    number = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"))
    src = df.select("*", number.alias(own), F.monotonically_increasing_id().alias(f"{own}_id"))
    blocks = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
                       number.alias(split), F.monotonically_increasing_id().alias("id")).groupBy("path", "start", split).agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    before = Window.orderBy("path", "start").rowsBetween(Window.unboundedPreceding, -1)  # one row for each split
    offsets = blocks.select(split, (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias(shift))
    offsets = materialize(offsets, "splits")
    known, distinct = offsets.agg(F.count(F.lit(1)), F.count_distinct(split)).first()
    if known != distinct:
        raise ValueError("two splits of the input share a 64-bit name")
    joined = src.join(F.broadcast(offsets) if known <= most_broadcast else offsets, F.col(own) == F.col(split))
    return joined.withColumn(name, (F.col(shift) + F.col(f"{own}_id")).cast("long")).select(
        *[c for c in df.columns if c != name], name)


# ------------------------------------------------------------------- sinks


def format_floats(df: DataFrame, fmt: str = "%.8f", columns: Sequence[str] | None = None) -> DataFrame:
    """Render double/float columns as text with a printf format (all of them by default).

    Null and NaN become null, which the sink writes as an empty field.
    """
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    targets = [c for c in (columns or fl) if c in fl]
    return df.withColumns({c: F.when(F.col(c).isNotNull() & ~F.isnan(c), F.format_string(fmt, F.col(c)))
                           for c in targets}) if targets else df


def write_csv(df: DataFrame, path: str, order_by: Sequence[str] | None = None,
              float_format: str | None = None, mode: str = "overwrite") -> str:
    """CSV sink with a header per part file; ``overwrite`` purges stale output.

    ``order_by`` range-partitions first, so part files (in name order) hold
    the rows in key order.  Refuses to overwrite the path it is reading.
    """
    if mode == "overwrite":
        target = _bare(path).rstrip("/")
        if any(_bare(f) == target or _bare(f).startswith(target + "/") for f in df.inputFiles()):
            raise ValueError(f"refusing to overwrite input {path}")
    out = format_floats(df, float_format) if float_format else df
    if order_by:
        out = out.orderBy(*order_by)
    out.write.mode(mode).option("header", True).option("escape", '"').csv(path)
    return path


def write_csv_with_preamble(df: DataFrame, path: str, preamble: str) -> str:
    """Write every part file as: preamble line, header line, data lines.

    Rows are rendered to CSV text in the JVM (``to_csv``); only the two
    leading lines are added per partition in Python.
    """
    header = ",".join(_quote(c) for c in df.columns)
    lines = df.select(F.to_csv(F.struct(*[F.col(c) for c in df.columns])).alias("value"))

    def add_head(batches):
        import pandas as pd
        yield pd.DataFrame({"value": [preamble, header]})
        yield from batches

    lines.mapInPandas(add_head, "value string").write.mode("overwrite").text(path)
    return path


def _bare(uri: str) -> str:
    """Path part of a URI, so ``file:///x`` and ``/x`` compare equal."""
    from urllib.parse import urlparse
    u = urlparse(uri)
    return (u.netloc + u.path) if u.scheme not in ("", "file") else ("/" + u.path.lstrip("/"))


def _quote(s: str) -> str:
    return '"' + s.replace('"', '""') + '"' if any(ch in s for ch in ',"\n') else s
