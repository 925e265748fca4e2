"""Session settings and shared scratch space for intermediate tables."""

from __future__ import annotations

import logging
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Of Parquet files this package writes for itself; a tenth to a third smaller than the default.
CODEC = "zstd"

# Session settings the report plans are written for.
SETTINGS = {
    # Dates and naive timestamps only; UTC keeps casts between them neutral.
    "spark.sql.session.timeZone": "UTC",
    # Parquet text is several times larger in memory than in the file. Without
    # this the planner takes the file size for the size of a broadcast.
    "spark.sql.sources.fileCompressionFactor": "4",
}


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    A local session that names none uses a folder beside its warehouse.
    """
    path = spark.conf.get(_CHECKPOINT_DIR, None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder every executor can reach")
        path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        spark.conf.set(_CHECKPOINT_DIR, path)
    return f"{path.rstrip('/')}/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def open_files(spark: SparkSession, most: int = 64):
    """A write inside keeps up to ``most`` files of a task open, one for each value it is
    divided by. Without this, or beyond it, every task first sorts its rows by that
    value, and spills what does not fit its memory."""
    with _setting(spark, _OPEN_FILES, str(most)):
        yield


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """A write inside removes its shuffle files when it ends. Otherwise they stay until the
    driver happens to collect garbage, and those of all steps of a report are on disk at once."""
    with _setting(spark, _DROP_SHUFFLES, "true"):
        yield


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def stage(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts lineage in a way that outlives executors, keeps a source from being
    read twice, and gives the planner the true size of the table: a join with
    it is broadcast only when that size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and is shuffled otherwise. With
    ``partition_by``, the last column, each of its values has a folder; a task
    keeps a file open for each of a few values and sorts only beyond that.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with open_files(spark), shuffles_dropped(spark):
        df.write.parquet(path, partitionBy=partition_by, compression=CODEC)
    log.info("staged %s at %s", name, path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


def discard(staged: DataFrame) -> None:
    """Remove the files of a table that :func:`stage` made; nothing may read it any more."""
    spark = staged.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(staged._staged_at)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
