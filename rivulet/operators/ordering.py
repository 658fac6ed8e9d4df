"""Row order without an index: gap-free row numbers and chunk numbering.

A global ``row_number() OVER (ORDER BY x)`` runs in one task.  Here the rows are
range partitioned and sorted by the order column, the tie-breaks and, last,
their place in the input, so that ties keep their input order and a value that
many rows share is spread over tasks.  A row's number is the number of rows in
the partitions before its own (one count for each partition) plus its place in
its partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_PLACE_BITS = 33  # monotonically_increasing_id: the partition above, the place in it below


def with_row_index(df: DataFrame, order_col: str, name: str = "row_index",
                   tiebreak: list[str] | None = None, partitions: int | None = None) -> DataFrame:
    """0-based position of every row in ``order_col`` order (ties by ``tiebreak``, then input order).

    Any orderable type; nulls come first.  ``partitions`` defaults to
    ``spark.sql.shuffle.partitions``.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = "_".join(["at", *df.columns])  # names that no column has
    rest = [c for c in df.columns if c != name]
    order = [F.col(order_col), *(F.col(c) for c in tiebreak or []), F.col(own)]
    dealt = (df.withColumn(own, F.monotonically_increasing_id())
             .repartitionByRange(n, *order).sortWithinPartitions(*order)
             .withColumn(own, F.monotonically_increasing_id()))
    placed = materialize(dealt, "row-index")
    part, known = F.shiftright(own, _PLACE_BITS), f"{own}_part"
    sizes = placed.groupBy(part.alias(known)).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy(known).rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    offsets = sizes.select(known, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(f"{own}_before"))
    return (placed.join(offsets, part == F.col(known))
            .withColumn(name, (F.col(f"{own}_before") + F.col(own).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))).cast("long"))
            .select(*rest, name))


def chunk_numbers(df: DataFrame, order_col: str, batch_size: int, name: str = "chunk_id",
                  **kw) -> DataFrame:
    """Chunk id of each row: ``floor(position / batch_size)`` in ``order_col`` order."""
    idx = with_row_index(df, order_col, name=name, **kw)
    return idx.withColumn(name, F.floor(F.col(name) / F.lit(batch_size)).cast("long"))
