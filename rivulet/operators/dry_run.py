"""Dry runs that stop early.

A dry run reads files in path order, first one, then 4, 16, ... of them, and
stops as soon as whole chunks hold enough valid rows, so its cost follows the
cap and not the table.  Chunks are runs of ``batch`` rows in file order.

Two rules say which chunks pass.  In an ETL run the rows so far are counted
before each chunk (P10): the chunk that crosses the cap is kept whole.  In a
scoring run only drained chunks count (P11): while ``in_flight`` chunks are
under way, that many more have been handed out when the cap is met.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.csv import with_file_row_index
from . import contract as C

#: Files of the first read, and by how much each read is larger than the one before.
FIRST, GROWTH = 1, 4


@dataclass(frozen=True)
class DryRun:
    """The rows that pass, with their chunk, and how far the input was read."""

    rows: DataFrame
    files_read: int
    files: int
    chunks: int  # chunks handed out, those without a valid row included


def chunks_passed(valid_per_chunk: Mapping[int, int], limit: int, in_flight: int = 0) -> int | None:
    """How many leading chunks a dry run hands out; None if the cap is not met in these.

    ``valid_per_chunk`` maps a chunk's number to its valid rows (chunks without any may be left out).
    """
    total = 0
    for chunk in sorted(valid_per_chunk):
        total += valid_per_chunk[chunk]
        if total >= limit:
            return chunk + 1 + in_flight
    return None


def dry_run_files(read: Callable[[Sequence[str]], DataFrame], files: Sequence[str], rules: Mapping[str, Column], batch: int,
                  limit: int, in_flight: int = 0, chunk_col: str = "chunk_id") -> DryRun:
    """A dry run over ``files`` (ordered by path), each prefix of which ``read`` gives as a scan.

    Rows that fail a rule are quarantined and do not count.  A chunk that the
    end of a prefix cuts is only judged once the next files are read.
    """
    files = sorted(files)
    n = min(FIRST, len(files))
    while True:
        numbered = with_file_row_index(read(files[:n]), "_at")
        placed = numbered.withColumn(chunk_col, F.floor(F.col("_at") / F.lit(batch)).cast("long")).drop("_at")
        routed = C.quarantine_rows(placed, rules)
        valid = F.count_if(F.col(C.ROUTE_COL) == C.VALID)
        per_chunk = routed.groupBy(chunk_col).agg(F.count(F.lit(1)).alias("n"), valid.alias("valid"))
        # a chunk that counts has a valid row, so the first `limit` of them decide
        head = per_chunk.where("valid > 0").orderBy(chunk_col).limit(limit).collect()
        passed = chunks_passed({r[chunk_col]: r["valid"] for r in head}, limit, in_flight)
        whole = n == len(files) or passed is not None and passed * batch <= per_chunk.agg(F.sum("n")).first()[0]
        if whole:
            rows = C.valid_branch(routed if passed is None else routed.where(F.col(chunk_col) < passed))
            return DryRun(rows, n, len(files), -1 if passed is None else passed)
        n = min(len(files), n * GROWTH)
