"""Row numbers without gaps inside groups that may be very large."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def number_within(df: DataFrame, groups: list[str], order: list[str], name: str, parts) -> DataFrame:
    """Adds ``name``: 0, 1, ... within each group, in no particular overall order.

    ``df`` is read twice, so it should be a stored table. Rows are dealt by a hash
    of ``order`` to ``parts`` (an expression) parts of their group; each part is
    numbered in ``order`` from where the parts before it end. Only the counts of
    the parts meet in one task per group. Equal rows are numbered in either order.
    """
    split = df.withColumn("_part", F.pmod(F.xxhash64(*order), parts).cast("long"))
    keys = [*groups, "_part"]
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        split.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    own = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return (
        split.withColumn("_own", own)
        .join(starts, keys)
        .withColumn(name, (F.col("_start") + F.col("_own")).cast("long"))
        .drop("_part", "_own", "_start")
    )
