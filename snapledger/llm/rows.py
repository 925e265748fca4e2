"""Keys of whole rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def row_key(*columns: Column, seed: int = 0) -> Column:
    """32 hexadecimal digits that tell rows of these columns apart.

    Two hashes of 64 bits, since at 10^11 rows one would repeat by chance. The
    null flag of each column is hashed with it: the hash passes over nulls, and
    (null, x) would have the key of (x, null).
    """
    parts = [part for c in columns for part in (c.isNull(), c)]
    halves = [F.lpad(F.hex(F.xxhash64(F.lit(2 * seed + k), *parts)), 16, "0") for k in (0, 1)]
    return F.concat(*halves)
