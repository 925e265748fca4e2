"""Disk held by shuffles."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_files_removed(spark: SparkSession):
    """Within, each query's shuffle files go when it ends; its results are in stored tables by then."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)
