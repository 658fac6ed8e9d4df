"""File inventory, integrity status, manifests and missing assets.

A tree is listed level by level: the folders of a level are a DataFrame whose
rows tasks open on executors (``os`` for mounted shared storage, ``pyarrow.fs``
for URIs), and the folders they find are the next level.  A task that opens a
folder only reads its names; the files are then dealt out by ranges of their
names and measured there, so a flat folder of millions of files is not one
task's work.  ``binaryFile`` is not used because it skips zero-byte files --
exactly the files the integrity check must flag.  Everything after the listing
is plain DataFrame work.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator, Sequence
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import STATUS_CORRUPT as CORRUPT
from ..functions.constants import STATUS_VALID as VALID
from ..session import materialize

#: Names that a task reads from a folder before it hands them on, and files that one task measures.
PIECE = 10_000
#: Folders that one task opens where there are enough for every core.
FOLDERS = 1024

#: Parts in which a tree is written, one after the other: of the shuffled lines, only a part's lie beside the files.
PARTS = 4
#: What a folder is called whose value is null or empty, and characters that a folder's name has as %XX (both as Spark's).
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = re.compile(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""")

LISTING_SCHEMA = "root string, path string, size_bytes long"
_ENTRY = "root string, path string, folder boolean, size_bytes long"


def _mounted(root: str) -> bool:
    return "://" not in root or root.startswith("file://")


def _fs(root: str):
    """(filesystem or None for local, base path) of a root URI or path."""
    if not _mounted(root):
        from pyarrow import fs as pafs
        return pafs.FileSystem.from_uri(root)
    return None, (root[len("file://"):] if root.startswith("file://") else root)


def _escaped(name: str) -> str:
    return _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", name)


def _write_folders(base: str, keys: Sequence[str]):
    """Writer of rows ``(*keys, text)`` that come folder by folder: the file of each under ``base``."""
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bytes]]:
        for batch in batches:
            *values, texts = (c.to_pylist() for c in batch.columns)
            yield from zip(zip(*values, strict=True), texts, strict=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for values, rows in groupby(lines(batches), itemgetter(0)):
            folder = os.path.join(base, *(f"{_escaped(k)}={_escaped(v)}" for k, v in zip(keys, values, strict=True)))
            part = os.path.join(folder, f".part-00000.txt.{uuid.uuid4().hex}")
            try:
                out = open(part, "wb")
            except FileNotFoundError:
                os.makedirs(folder, exist_ok=True)
                out = open(part, "wb")
            with out:
                for _, text in rows:
                    out.write(text)
                    out.write(b"\n")
            os.replace(part, os.path.join(folder, "part-00000.txt"))  # a task's second attempt leaves one file as well
            n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["files"])

    return write


def write_tree(df: DataFrame, root: str, keys: Sequence[str], text: str) -> str:
    """Text sink: the lines of each group of rows as one file in ``root/key=value/...``, and an empty ``_SUCCESS``.

    Names are those of Spark's own partitioned sink.  That one starts a process
    for each file and folder it makes in mounted storage (to set their modes),
    and the driver then clears the folders its tasks have moved files from, so
    there tasks write the files in place themselves; other stores get Spark's.
    ``df`` is read once for each of :data:`PARTS` and must hold the same rows each time.
    """
    if not _mounted(root):
        df.select(*keys, text).repartition(*keys).write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(*keys).text(root)
        return root
    spark, base = df.sparkSession, _fs(root)[1]
    os.makedirs(base)
    named = df.select(*(F.coalesce(F.nullif(F.col(k).cast("string"), F.lit("")), F.lit(NO_VALUE)).alias(k) for k in keys),
                      F.coalesce(F.col(text), F.lit("")).cast("binary").alias(text))
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup)
    spark.conf.set(cleanup, "true")
    try:
        for i in range(PARTS):  # by another hash than the one that deals rows out to tasks
            part = named.where(F.pmod(F.xxhash64(*keys), F.lit(PARTS)) == i).repartition(*keys).sortWithinPartitions(*keys)
            part.mapInArrow(_write_folders(base, keys), "files long").agg(F.sum("files")).collect()
    finally:
        spark.conf.set(cleanup, before)
    open(os.path.join(base, "_SUCCESS"), "wb").close()
    return root


def _entries(root: str, sub: str) -> Iterator[tuple[str, bool, int | None]]:
    """(path relative to the root, whether it is a folder, size if the listing tells it) in one folder."""
    fsys, base = _fs(root)
    start = os.path.join(base, sub) if sub else base
    if fsys is not None:
        from pyarrow import fs as pafs
        for info in fsys.get_file_info(pafs.FileSelector(start)):
            folder = info.type == pafs.FileType.Directory
            yield os.path.relpath(info.path, base), folder, None if folder else int(info.size)
        return
    with os.scandir(start) as found:
        for e in found:  # a link to a folder is not followed, one to a file is measured
            if e.is_dir(follow_symlinks=False) or e.is_file():
                yield os.path.join(sub, e.name), e.is_dir(follow_symlinks=False), None


def _open_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries of folders, handed on in pieces."""
    names = ["root", "path", "folder", "size_bytes"]
    types = [pa.string(), pa.string(), pa.bool_(), pa.int64()]
    for batch in batches:
        rows: list[tuple] = []
        for root, sub in zip(batch.column("root").to_pylist(), batch.column("path").to_pylist(), strict=True):
            for entry in _entries(root, sub):
                rows.append((root, *entry))
                if len(rows) == PIECE:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes of the files whose listing told none."""
    for batch in batches:
        sizes = [os.path.getsize(os.path.join(_fs(r)[1], p)) if s is None else s for r, p, s in zip(
            *(batch.column(c).to_pylist() for c in ("root", "path", "size_bytes")), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("root"), batch.column("path"), pa.array(sizes, pa.int64())],
                                         names=["root", "path", "size_bytes"])


def list_files(spark: SparkSession, roots: Sequence[str], ordered: bool = False) -> DataFrame:
    """``(root, path, size_bytes)`` for every file under each root, at any depth.

    Each level of folders is written as it is found; the loop ends with the
    first level that holds none.  ``ordered`` sorts the listing by (root,
    path) -- a distributed range sort.
    """
    # an Arrow table, since rows of Python start workers of another kind
    level = spark.createDataFrame(pa.table({"root": pa.array(roots, pa.string()), "path": pa.array([""] * len(roots), pa.string())}))
    n, levels = len(roots), []
    while n:
        tasks = min(n, max(spark.sparkContext.defaultParallelism, -(-n // FOLDERS)))
        opened = level.repartition(tasks, "root", "path").mapInArrow(_open_folders, _ENTRY)
        levels.append(materialize(opened, "level"))
        level = levels[-1].where("folder").select("root", "path")
        n = level.count()
    if not levels:
        return spark.createDataFrame([], LISTING_SCHEMA)
    found = levels[0]
    for one in levels[1:]:
        found = found.unionByName(one)
    files = found.where("NOT folder").select("root", "path", "size_bytes")
    tasks = max(1, -(-files.count() // PIECE))
    listing = files.repartitionByRange(tasks, "root", "path").mapInArrow(_measure, LISTING_SCHEMA)
    return listing.orderBy("root", "path") if ordered else listing


def base_name(path_col: str = "path"):
    return F.element_at(F.split(F.col(path_col), "/"), -1)


def file_status(listing: DataFrame, size_col: str = "size_bytes") -> DataFrame:
    """``status``: CORRUPT (0 Bytes) for empty files, else VALID."""
    return listing.withColumn("status", F.when(F.col(size_col) == 0, F.lit(CORRUPT)).otherwise(F.lit(VALID)))


def manifest_rows(listing: DataFrame, job_col: str = "job_id") -> DataFrame:
    """The manifest as a table, one row per file: ``job_id, path, size_bytes, status, warning``
    (the name of a zero-byte file).  However many files a job wrote, none of them meet."""
    st = file_status(listing)
    return st.select(F.col(job_col).alias("job_id"), "path", "size_bytes", "status",
                     F.when(F.col("status") == CORRUPT, base_name("path")).alias("warning"))


def write_manifest(listing: DataFrame, path: str, job_col: str = "job_id") -> str:
    """Manifest sink: the rows as Parquet, overwriting an older manifest."""
    manifest_rows(listing, job_col).write.mode("overwrite").parquet(path)
    return path


def manifest(listing: DataFrame, job_col: str = "job_id") -> DataFrame:
    """One JSON manifest per job: ``{job_id, files[], integrity_warnings[]}``.

    Files are sorted by path; warnings hold the names of zero-byte files.  The
    document of a job is one row, so this form is for jobs of up to some
    hundred thousand files (a row holds at most 2 GB);
    :func:`manifest_rows` keeps the files of any job apart.
    """
    st = file_status(listing)
    entry = F.struct(F.col("path"), F.col("size_bytes"), F.col("status"))
    warn = F.when(F.col("status") == CORRUPT, base_name("path"))
    per_job = st.groupBy(job_col).agg(
        F.array_sort(F.collect_list(entry)).alias("files"),
        F.array_sort(F.collect_list(warn)).alias("integrity_warnings"))
    doc = F.struct(F.col(job_col).alias("job_id"), "files", "integrity_warnings")
    return per_job.select(F.col(job_col).alias("job_id"), F.to_json(doc).alias("manifest"))


def missing_assets(listing: DataFrame, required: Sequence[str], job_col: str = "job_id") -> DataFrame:
    """Required file names absent from each job's listing: ``(job_id, name)``.

    Required names are expanded per job with ``explode`` (no cross join) and
    matched by file name with a left-anti join.
    """
    found = listing.select(job_col, base_name("path").alias("name")).distinct()
    jobs = listing.select(job_col).distinct()
    req = jobs.select(job_col, F.explode(F.array(*[F.lit(n) for n in required])).alias("name"))
    return req.join(found, [job_col, "name"], "left_anti")
