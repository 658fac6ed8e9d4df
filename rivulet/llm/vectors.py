"""Vectors of whole numbers and their exact inner products, shared by the two vector operators.

``whole_vectors`` scales, floors and cleans a table of vectors; ``matrix``
turns an Arrow list column into numpy; ``products`` multiplies exactly;
``best`` keeps the highest products of each query with ties in id order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Below this magnitude sums of whole doubles are exact.
EXACT = 2.0 ** 53
#: Relative slack of every bound that is compared with an exact product.
SLACK = 1e-9
#: A score below every score, and an id that sorts after every id (null ids come last in ties).
LEAST = np.iinfo(np.int64).min
LAST = np.iinfo(np.int64).max


def whole_vectors(frame: DataFrame, scale: int, id_col: str = "vec_id", vector_col: str = "embedding",
                  keep: dict[str, Column] | None = None) -> DataFrame:
    """``vec_id, vec, norm`` and the columns of ``keep``: each component x becomes floor(scale * x).

    Rows whose vector is null or holds a null, NaN or infinite component take
    no part.  An empty vector is a vector of zeros.
    """
    bad = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = frame.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vec"),
                        *[c.alias(n) for n, c in (keep or {}).items()]).where(F.col("vec").isNotNull() & ~bad)
    whole = rows.withColumn("vec", F.transform("vec", lambda v: F.floor(v * F.lit(float(scale)))))
    square = F.aggregate("vec", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    return whole.withColumn("norm", F.sqrt(square))


def matrix(column: pa.Array | pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """A list column as an int64 matrix; shorter vectors are filled with zeros on the right."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    width = max(width or 0, int(sizes.max(initial=0)))
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def same_width(*parts: np.ndarray) -> list[np.ndarray]:
    """Matrices filled with zeros on the right to one width."""
    width = max(p.shape[1] for p in parts)
    return [p if p.shape[1] == width else np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts]


def exact_type(a: np.ndarray, b: np.ndarray) -> type:
    """float64 where every product of rows of ``a`` and ``b`` is exact in it, else int64 (exact as far as a long goes)."""
    if not a.size or not b.size:
        return np.float64
    large = np.abs(a.astype(np.float64)).sum(axis=1).max() * np.abs(b.astype(np.float64)).max()
    return np.float64 if large < EXACT else np.int64


def lengths(rows: np.ndarray) -> np.ndarray:
    """Euclidean length of each row."""
    return np.sqrt(np.square(rows.astype(np.float64)).sum(axis=1))


def ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Ids as int64, null as ``LAST``."""
    return column.fill_null(LAST).to_numpy().astype(np.int64, copy=False)


def id_array(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=values == LAST)


def best(scores: np.ndarray, names: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's ``k`` highest scores of at least ``least``, ties to the smaller name."""
    cut = least.astype(scores.dtype)
    if scores.shape[1] > k:
        cut = np.maximum(cut, np.partition(scores, -k, axis=1)[:, -k])
    r, c = np.nonzero(scores >= cut[:, None])
    return ranked(r, scores[r, c], names[c], k, c)


def ranked(group: np.ndarray, score: np.ndarray, name: np.ndarray, k: int, *more: np.ndarray):
    """``group`` and ``more`` of each group's first ``k`` entries by score (highest first), then name."""
    order = np.lexsort((name, -score, group))
    g = group[order]
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    place = np.arange(len(g)) - np.repeat(first, np.diff(np.r_[first, len(g)]))
    order = order[place < k]
    return (group[order], *[m[order] for m in more])
