"""Column-expression helpers shared by the operators.

Everything here builds JVM-side expressions (no Python UDFs), so the work stays
inside whole-stage codegen.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The missing-value tokens a pandas CSV read turns into NaN by
# default (public pandas behaviour), in the order pandas documents them.
NULL_TOKENS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

def _hex_step(m: int) -> int:
    """Hex digits folded per Horner step, so that ``16**step * m`` stays below 2**63."""
    if not 0 < m < 2**59:
        raise ValueError("modulus must be in (0, 2**59)")
    return min(7, (63 - m.bit_length()) // 4)


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_text(c: str | Column) -> Column:
    """Text form of a key, as Python's ``str(int)`` / ``str(text)`` would give."""
    return col_of(c).cast("string")


def hex_mod(hex_col: Column, m: int, n_digits: int) -> Column:
    """``int(hex, 16) % m`` for a fixed-width lower-case hex string.

    Horner evaluation in steps of a few digits keeps every intermediate below
    2**63, so 128/160-bit digests reduce exactly with 64-bit arithmetic.
    """
    width = _hex_step(m)
    if m & (m - 1) == 0:
        # power of two: only the trailing ceil(log16 m) hex digits matter
        d = max(1, (m.bit_length() - 1 + 3) // 4)
        tail = F.conv(F.substring(hex_col, n_digits - d + 1, d), 16, 10).cast("long")
        return F.pmod(tail, F.lit(m))
    acc: Column = F.lit(0).cast("long")
    pos = 1
    while pos <= n_digits:
        step = min(width, n_digits - pos + 1)
        piece = F.conv(F.substring(hex_col, pos, step), 16, 10).cast("long")
        acc = F.pmod(acc * F.lit(16**step) + piece, F.lit(m))
        pos += step
    return acc


def hex_mod_sql(hex_sql: str, m: int, n_digits: int) -> str:
    """DuckDB text of :func:`hex_mod` (used by the oracle queries)."""
    if m & (m - 1) == 0:
        d = max(1, (m.bit_length() - 1 + 3) // 4)
        return f"(('0x' || substr({hex_sql}, {n_digits - d + 1}, {d}))::BIGINT % {m})"
    acc, width = "0::BIGINT", _hex_step(m)
    pos = 1
    while pos <= n_digits:
        step = min(width, n_digits - pos + 1)
        piece = f"('0x' || substr({hex_sql}, {pos}, {step}))::BIGINT"
        acc = f"(({acc}) * {16**step} + {piece}) % {m}"
        pos += step
    return acc


def unit_hash(key: str | Column, seed: int | str) -> Column:
    """Deterministic uniform value in [0, 1) from ``md5(seed || '|' || key)``."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), key_text(key)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(2.0**32)


def unit_hash_sql(key_sql: str, seed: int | str) -> str:
    return (f"(('0x' || substr(md5('{seed}|' || CAST({key_sql} AS VARCHAR)), 1, 8))"
            f"::BIGINT / CAST(4294967296 AS DOUBLE))")


def order_hash(key: str | Column, seed: int | str) -> Column:
    """Seeded pseudo-random order key (for basis / holdout sampling)."""
    return F.md5(F.concat(F.lit(f"{seed}|"), key_text(key)))


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def linear(features: Sequence[str | Column], coef: Sequence[float], intercept: float) -> Column:
    z: Column = F.lit(float(intercept))
    for f, w in zip(features, coef, strict=True):
        z = z + F.lit(float(w)) * col_of(f)
    return z


def safe_div(num: Column, den: Column) -> Column:
    """``num / den`` with 0 for a zero or null denominator (zero_division=0)."""
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def null_if_token(c: str | Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    col = col_of(c)
    return F.when(col.isin(list(tokens)), F.lit(None).cast("string")).otherwise(col)


def nan_to_null(c: str | Column) -> Column:
    col = col_of(c)
    return F.when(F.isnan(col), F.lit(None)).otherwise(col)


def bloom_geometry(n_items: int, p: float) -> tuple[int, int]:
    """Optimal (m bits, k hashes) with the integer truncation of the reference."""
    m = int(-(n_items * math.log(p)) / (math.log(2) ** 2))
    k = int((m / n_items) * math.log(2))
    if k < 1:
        raise ValueError(f"Bloom geometry gives no hash functions (n={n_items}, p={p})")
    return m, k


def r6(c: str | Column) -> Column:
    """Round a derived double to 6 places (oracle comparisons)."""
    return F.round(col_of(c), 6)
