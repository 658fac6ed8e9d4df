"""Column contracts, quarantine routing and dry-run caps.

A contract is a plain dict::

    {"required_columns": [...], "dtypes": {"col": "double", ...}}

Casting uses ``try_cast`` so that one bad cell never fails a job under ANSI
mode; every failed cast is recorded instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import SURROGATE_COLUMN

# pandas-style dtype names accepted in contracts -> Spark SQL types
_DTYPE_ALIASES = {
    "int64": "bigint", "int32": "int", "int": "bigint", "long": "bigint",
    "float64": "double", "float": "double", "float32": "float",
    "object": "string", "str": "string", "string": "string",
    "bool": "boolean", "boolean": "boolean", "double": "double",
    "bigint": "bigint",
}

REASONS_COL = "_reasons"
ROUTE_COL = "_route"
VALID, QUARANTINED = "valid", "quarantine"


def spark_type(dtype: str) -> str:
    return _DTYPE_ALIASES.get(dtype.lower(), dtype)


def normalise_header(name: str) -> str:
    """``strip()`` first, then delete double and single quotes."""
    return str(name).strip().replace('"', "").replace("'", "")


def normalise_headers(df: DataFrame) -> DataFrame:
    """Rename every column by :func:`normalise_header`; fail on collisions."""
    new = [normalise_header(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new, strict=True):
        if n in seen:
            raise ValueError(f"header collision after normalising: {seen[n]!r} and {old!r} -> {n!r}")
        seen[n] = old
    return df.toDF(*new)


def drop_surrogate(df: DataFrame, name: str = SURROGATE_COLUMN) -> DataFrame:
    """Drop a surrogate row-number column if present (no-op otherwise)."""
    return df.drop(name) if name in df.columns else df


def blind_projection(df: DataFrame, target: str) -> DataFrame:
    """Strip the label so downstream scoring is blind to it."""
    return df.drop(target) if target in df.columns else df


def missing_columns(df: DataFrame, contract: Mapping | None,
                    tolerate: Sequence[str] = ()) -> list[str]:
    if not contract:
        return []
    required = contract.get("required_columns", [])
    return [c for c in required if c not in df.columns and c not in tolerate]


def require_columns(df: DataFrame, contract: Mapping | None,
                    tolerate: Sequence[str] = ()) -> DataFrame:
    """Raise ``ValueError`` listing required columns that are absent.

    Checked at analysis time: a violation stops the job before any data moves.
    ``tolerate`` lists columns allowed to be missing (e.g. the label at scoring).
    """
    missing = missing_columns(df, contract, tolerate)
    if missing:
        raise ValueError(f"required columns are absent: {missing}")
    return df


def cast_failed(raw: Column, cast: Column) -> Column:
    """A value was present but did not survive the cast."""
    return raw.isNotNull() & cast.isNull()


def soft_cast(df: DataFrame, contract: Mapping | None,
              errors_col: str = "_cast_errors") -> DataFrame:
    """Row-level contract cast: bad cells become null and are named in ``errors_col``."""
    dtypes = dict((contract or {}).get("dtypes", {}))
    present = [c for c in dtypes if c in df.columns]
    if not present:
        return df.withColumn(errors_col, F.array().cast("array<string>"))
    casts = {c: F.col(c).try_cast(spark_type(dtypes[c])) for c in present}
    flags = [F.when(cast_failed(F.col(c), casts[c]), F.lit(c)) for c in present]
    out = df.withColumn(errors_col, F.filter(F.array(*flags), lambda x: x.isNotNull()))
    return out.withColumns(casts)


def contract_violations(df: DataFrame, contract: Mapping | None) -> DataFrame:
    """Per contracted column: ``(column, dtype, n_violations)`` in one scan."""
    dtypes = dict((contract or {}).get("dtypes", {}))
    present = [c for c in dtypes if c in df.columns]
    aggs = [
        F.count_if(cast_failed(F.col(c), F.col(c).try_cast(spark_type(dtypes[c])))).alias(f"v{i}")
        for i, c in enumerate(present)
    ]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', '{spark_type(dtypes[c])}', v{i}" for i, c in enumerate(present))
    return wide.selectExpr(f"stack({len(present)}, {pairs}) AS (column, dtype, n_violations)")


def cast_whole_columns(df: DataFrame, contract: Mapping | None) -> DataFrame:
    """Reference-style cast: a column with any bad cell stays uncast (one pass to decide)."""
    dtypes = dict((contract or {}).get("dtypes", {}))
    counts = {r["column"]: r["n_violations"] for r in contract_violations(df, contract).collect()}
    casts = {c: F.col(c).cast(spark_type(t)) for c, t in dtypes.items()
             if c in df.columns and counts.get(c, 0) == 0}
    return df.withColumns(casts) if casts else df


def validate(df: DataFrame, contract: Mapping | None, tolerate: Sequence[str] = ()) -> DataFrame:
    """Required-column check + row-level soft cast (the reference's contract)."""
    return soft_cast(require_columns(df, contract, tolerate), contract)


def with_reasons(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Attach ``_reasons``: names of the failing rules (a rule is a *failure* predicate)."""
    flags = [F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()]
    reasons = F.filter(F.array(*flags), lambda x: x.isNotNull()) if flags else F.array().cast("array<string>")
    return df.withColumn(REASONS_COL, reasons)


def quarantine_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Row-unit routing: ``_route`` is 'valid' when no rule fails."""
    out = with_reasons(df, rules)
    return out.withColumn(ROUTE_COL, F.when(F.size(REASONS_COL) == 0, F.lit(VALID))
                          .otherwise(F.lit(QUARANTINED)))


def quarantine_chunks(df: DataFrame, rules: Mapping[str, Column], chunk_col: str) -> DataFrame:
    """Chunk-unit routing: one failing row sends its whole chunk to quarantine.

    The window is partitioned by chunk, and a chunk is bounded by the batch
    size, so no task ever holds more than one batch.
    """
    out = with_reasons(df, rules)
    bad_chunk = F.max((F.size(REASONS_COL) > 0).cast("int")).over(Window.partitionBy(chunk_col))
    return out.withColumn(ROUTE_COL, F.when(bad_chunk == 1, F.lit(QUARANTINED)).otherwise(F.lit(VALID)))


def valid_branch(routed: DataFrame) -> DataFrame:
    return routed.where(F.col(ROUTE_COL) == VALID).drop(ROUTE_COL, REASONS_COL)


def quarantine_branch(routed: DataFrame) -> DataFrame:
    """Dead-letter rows keep their key and get a readable ``reason``."""
    return (routed.where(F.col(ROUTE_COL) == QUARANTINED)
            .withColumn("reason", F.array_join(F.array_sort(REASONS_COL), ";"))
            .drop(ROUTE_COL, REASONS_COL))


def etl_counts(routed: DataFrame) -> DataFrame:
    """``(processed, quarantined)`` counts of a routed frame in one aggregate."""
    return routed.agg(F.count_if(F.col(ROUTE_COL) == VALID).alias("processed"),
                      F.count_if(F.col(ROUTE_COL) == QUARANTINED).alias("quarantined"))


def dry_run_chunks(routed: DataFrame, chunk_col: str, limit: int) -> DataFrame:
    """Chunk-grain dry-run cap on the valid branch of a table that has its chunk numbers.

    Valid chunks are taken in chunk order while the rows already taken are
    below ``limit`` (quarantined chunks do not count), so a chunk that crosses
    the limit is kept whole.  Ranges of chunk numbers, each four times wider,
    are counted until the cap is met, so a scan that can skip by the chunk
    column reads no more; the result is a plain filter.
    """
    valid = valid_branch(routed)
    low, high = valid.agg(F.min(chunk_col), F.max(chunk_col)).first()
    if low is None or limit <= 0:
        return valid.limit(0)
    total, start, width, last = 0, low, 4, high
    while start <= high:
        part = valid.where(F.col(chunk_col).between(start, start + width - 1))
        head = part.groupBy(chunk_col).agg(F.count(F.lit(1)).alias("n")).orderBy(chunk_col).limit(int(limit)).collect()
        for r in head:
            total += r["n"]
            if total >= limit:
                return valid.where(F.col(chunk_col) <= r[chunk_col])
        start, width = start + width, width * 4
    return valid.where(F.col(chunk_col) <= last)
