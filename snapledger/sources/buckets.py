"""Bucketed Parquet folders, partitioned by one column.

Files of a bucket hold the keys of one hash value, so two tables with the same
buckets are joined on the key without an exchange. Spark keeps the buckets of a
table in its catalog; here that entry lives only as long as a read or a write,
and the folders named by a manifest are what lasts.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, types as T

from snapledger.session import CODEC, shuffles_dropped

# Buckets hold all dates of a key. Joins on key and date can use them only where
# the planner accepts a part of the join keys.
_PART_OF_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def _new_name() -> str:
    return f"snapledger_{uuid.uuid4().hex}"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, partition: str, arranged: bool = False) -> None:
    """Write ``df`` to a new folder. ``arranged`` says that each task holds few
    buckets, else rows are first dealt by key, so that a bucket is one file a date."""
    name = _new_name()
    if not arranged:
        df = df.repartition(buckets, f"`{key}`")
    try:
        with shuffles_dropped(df.sparkSession):
            (
                df.write.format("parquet").partitionBy(partition).bucketBy(buckets, key).sortBy(key)
                .option("path", path).option("compression", CODEC).saveAsTable(name)
            )
    finally:
        # The table is external: dropping it leaves the files.
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


@contextmanager
def bucketed_table(
    spark: SparkSession, folders: dict[str, str], schema: T.StructType, key: str, buckets: int, partition: str, root: str
):
    """A table over ``folders`` (by value of ``partition``) that knows its buckets; it ends with the context."""
    name = _new_name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (`{partition}`) "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{root}'"
    )
    before = spark.conf.get(_PART_OF_KEYS, None)
    spark.conf.set(_PART_OF_KEYS, "false")
    try:
        if folders:
            places = " ".join(f"PARTITION (`{partition}` = '{v}') LOCATION '{p}'" for v, p in folders.items())
            spark.sql(f"ALTER TABLE {name} ADD {places}")
        yield spark.table(name)
    finally:
        spark.conf.unset(_PART_OF_KEYS) if before is None else spark.conf.set(_PART_OF_KEYS, before)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
