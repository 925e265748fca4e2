"""Token counts through a cache keyed by content and tokenizer version.

Each text has a digest (a null text is the empty text), each tokenizer another.
Counts stored under both are looked up; texts that have none are encoded once
per distinct text, whatever the number of copies, and appended to the cache.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from snapledger.llm.encoding import encode_column, version_digest

_CACHE_SCHEMA = "tokenizer string, content string, n_tokens long"


class DigestCache:
    """A Parquet folder of counts. It only grows; a failed append leaves it as it was."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def stored(self, tokenizer: str) -> DataFrame:
        """Counts of one tokenizer version, one row per content digest.

        Two runs may append the same text; both counts are equal, so either row serves.
        """
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return self.spark.createDataFrame([], _CACHE_SCHEMA).drop("tokenizer")
        kept = self.spark.read.schema(_CACHE_SCHEMA).parquet(self.path)
        kept = kept.where(F.col("tokenizer") == tokenizer)
        return kept.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))

    def append(self, counts: DataFrame, tokenizer: str) -> None:
        counts.select(F.lit(tokenizer).alias("tokenizer"), "content", "n_tokens").write.mode(
            "append"
        ).parquet(self.path)


def count_tokens(
    docs: DataFrame, path: str, cache: DigestCache, id_col="doc_id", text_col="text"
) -> DataFrame:
    """doc_id, content (digest), n_bytes (UTF-8), n_tokens; one row per row of ``docs``.

    ``path`` is a file of the tokenizers library. No begin, end or other tokens
    are added, nothing is cut or padded, and special strings inside a text count
    as the library counts them by default. Null and empty texts count 0 bytes
    and 0 tokens. Repeated rows and null ids keep a row each; an empty table
    gives no rows; other columns of ``docs`` are ignored.

    Copies are dropped in each task before texts are shuffled, so a text that a
    third of the rows share moves once per task.
    """
    tokenizer = version_digest(path)
    texts = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).withColumn("content", F.sha2("text", 256))

    def encode(batches):
        for batch in batches:
            ids = encode_column(path, batch.column("text"))
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("content"), counts], ["content", "n_tokens"])

    misses = (
        texts.select("content", "text")
        .dropDuplicates(["content"])
        .join(cache.stored(tokenizer), "content", "left_anti")
    )
    cache.append(misses.mapInArrow(encode, "content string, n_tokens long"), tokenizer)
    return texts.select("doc_id", "content", F.octet_length("text").cast("long").alias("n_bytes")).join(
        cache.stored(tokenizer), "content", "left"
    )
