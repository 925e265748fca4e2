"""What operators on vectors share: which vectors count, and how many lengths occur."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

_MOST_LENGTHS = 64


def floored(vector: str, scale: int, offset: int = 0) -> Column:
    """``floor(scale * c) + offset`` of every component, in double precision, as long.

    Null for vectors that are null or empty, that hold a null or non-finite
    component, or one whose product is 2^62 or more and would not fit.
    """
    c = F.col(vector)
    fits = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < F.lit(2.0**62)))
    whole = F.transform(c, lambda x: F.floor(x.cast("double") * F.lit(float(scale))) + F.lit(offset).cast("long"))
    return F.when(c.isNotNull() & (F.size(c) > 0) & F.coalesce(fits, F.lit(False)), whole)


def lengths(vectors: DataFrame, column: str) -> list[tuple[int, int]]:
    """(length, rows) of the vectors that occur; more than 64 lengths are an error."""
    found = (
        vectors.groupBy(F.size(column).alias("length")).count().orderBy("length").limit(_MOST_LENGTHS + 1).collect()
    )
    if len(found) > _MOST_LENGTHS:
        raise ValueError(f"vectors of more than {_MOST_LENGTHS} lengths in {column!r}")
    return [(r["length"], r["count"]) for r in found]


def matrix(column: pa.Array | pa.ChunkedArray, kind=np.int64) -> np.ndarray:
    """Rows of one length as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0), kind)
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)
