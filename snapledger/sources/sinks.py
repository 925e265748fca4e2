"""Report tables and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from snapledger.functions.casting import void_to_string
from snapledger.sources.reports import ReportFolder


def write_report(df: DataFrame | list[DataFrame], path: str, partition_by: str | None = None) -> DataFrame:
    """Make ``df``, or the tables of a list in turn, the next version of the report at ``path`` and return it read back.

    The versions before it stay until ``ReportFolder.clean``; see there.
    """
    spark = (df[0] if isinstance(df, list) else df).sparkSession
    return ReportFolder(spark, path).replace(df, partition_by)


def export_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV part files, each with a header line."""
    void_to_string(df).write.option("header", True).csv(path)


def export_parquet(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def export(df: DataFrame, fmt: str, path: str) -> None:
    sinks = {"csv": export_csv, "parquet": export_parquet}
    if fmt not in sinks:
        raise ValueError(f"format must be one of {sorted(sinks)}, not {fmt!r}")
    sinks[fmt](df, path)
