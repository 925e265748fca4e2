"""Exact-size random samples and display limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from snapledger import fixed


def sample_rows(df: DataFrame, n: int = fixed.SAMPLE_ROWS, seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows without replacement, or all when the table is smaller.

    Planned as a top-n over hashes of the seed and the whole row: each task keeps
    ``n`` rows, and no full sort takes place. A seed gives the same sample however
    the table is partitioned. Map columns, which cannot be hashed, are passed over.
    """
    hashed = [F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return df.orderBy(F.xxhash64(F.lit(seed), *hashed)).limit(n)


def preview(df: DataFrame, rows: int | None = fixed.DISPLAY_ROWS) -> DataFrame:
    """The first rows for display; ``None`` when the query has its own limit."""
    return df if rows is None else df.limit(rows)
