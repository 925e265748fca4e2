"""CSV and Parquet files or dataset folders as named tables."""

from __future__ import annotations

import logging
import uuid
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, types as T

log = logging.getLogger(__name__)

# Suffixes read, in loading order: a later one replaces an earlier of the same stem.
SUFFIXES = (".parquet", ".pq", ".csv")


def _split_name(path: str) -> tuple[str, str]:
    name = unquote(path.rstrip("/").rsplit("/", 1)[-1])
    stem, dot, suffix = name.rpartition(".")
    return (stem, dot + suffix) if stem else (name, "")


def table_name(path: str) -> str:
    return _split_name(path)[0]


def read_file(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame | None:
    """Read one table by suffix; None for a suffix that is not supported.

    CSV types are inferred unless ``schema`` is given; inference is an extra pass
    over the file, so give the schema of large files.
    """
    suffix = _split_name(path)[1]
    if suffix == ".csv":
        reader = spark.read.option("header", True)
        reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
        return reader.csv(path)
    if suffix in (".parquet", ".pq"):
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(path)
    log.info("not a table file, skipped: %s", path)
    return None


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(hadoop)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that is there in full or not at all; it must not exist yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    temporary = spark._jvm.org.apache.hadoop.fs.Path(hadoop.getParent(), f"_{uuid.uuid4().hex}")
    out = fs.create(temporary, False)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(hadoop) or not fs.rename(temporary, hadoop):
        fs.delete(temporary, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    return "\n".join(r[0] for r in spark.read.option("wholetext", True).text(path).collect())


def remove(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(hadoop, True)


def modified_at(spark: SparkSession, path: str) -> datetime:
    """When a file or folder was last changed, in UTC."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return datetime.fromtimestamp(fs.getFileStatus(hadoop).getModificationTime() / 1000, timezone.utc)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Entries of a folder on any Hadoop file system, sorted by name."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return sorted(s.getPath().toString() for s in fs.listStatus(hadoop))


def list_tables(spark: SparkSession, folder: str) -> list[str]:
    """Data files of a folder in loading order."""
    entries = list_folder(spark, folder)
    return [p for suffix in SUFFIXES for p in entries if _split_name(p)[1] == suffix]


def load_files(
    spark: SparkSession, paths: list[str], names: list[str] | None = None
) -> dict[str, DataFrame]:
    """Named tables from files; ``names`` renames them in order, the rest keep
    their stem. Unsupported suffixes are skipped."""
    names = list(names or [])
    tables: dict[str, DataFrame] = {}
    for i, path in enumerate(paths):
        df = read_file(spark, path)
        if df is not None:
            tables[names[i] if i < len(names) else table_name(path)] = df
    return tables


def load_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return load_files(spark, list_tables(spark, folder))
