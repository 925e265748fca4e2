"""The training-data pipeline: stages over the documents table, in order.

Each stage takes (spark, documents, folder of the given tables) and returns the
documents that go on, with the columns of ``documents``; the last returns the
pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snapledger.llm import jaccard_join, mixing, packing, quality, toxicity
from snapledger.llm.encoding import vocabulary_path
from snapledger.llm.shipping import ship_package
from snapledger.session import new_path

TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under a model of trusted text is usual for their language."""
    # Smaller chunks than by default: the workers of earlier stages keep some of their memory.
    return quality.good_documents(docs, _table(spark, sf_dir, "labels"), quantile=0.999, chunk_chars=2_000_000)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.3."""
    return toxicity.harmless_documents(docs, _table(spark, sf_dir, "labels"), threshold=0.3)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more."""
    ship_package(spark)
    return jaccard_join.one_of_each_group(docs, size=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weigh 3, 1, 2, repeating, and share 150 % of all words in at most two passes; copies repeat rows."""
    return mixing.mix_documents(docs, weights=[3.0, 1.0, 2.0], share=1.5, most_passes=2.0)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 ids with their sequence and place."""
    ship_package(spark)
    found = packing.pieces(
        docs, vocabulary_path(TOKENIZER), capacity=1024, end_id=2, keep_tables=False, chunk_chars=500_000
    )
    return packing.pack(found, capacity=1024)


STAGES = [
    ("quality", keep_good),
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

# No SQL: models are trained and random draws made on the way.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
