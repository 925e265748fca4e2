"""The registered queries of this subpackage: each takes (spark, folder of the given tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapledger.llm import (
    alignment, embeddings, exact_search, fingerprints, jaccard_join, mixing, packing, quality, sequence_files, sharding,
    token_counts, toxicity, whitening,
)
from snapledger.llm.encoding import vocabulary_path
from snapledger.llm.oracle import ORACLE
from snapledger.llm.shipping import ship_package
from snapledger.session import new_path

__all__ = ["ORACLE", "QUERIES"]

QUERIES = {}

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
TOKEN_LIMIT = 1024


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


@query
def op1_embedding_near_dedup(spark, sf):
    return embeddings.near_duplicates(table(spark, sf, "embeddings"), threshold=0.98)


@query
def op2_best_fit_packing(spark, sf):
    found = packing.pieces(table(spark, sf, "documents"), vocabulary_path(TOKENIZER), capacity=1024, end_id=2)
    return packing.pack(found, capacity=1024).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query
def op6_token_counts(spark, sf):
    # A cache of its own, so that the query counts every text it is given.
    cache = token_counts.DigestCache(spark, new_path(spark, "token-counts"))
    counts = token_counts.count_tokens(table(spark, sf, "documents"), vocabulary_path(TOKENIZER), cache)
    return counts.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    )


@query
def op10_sequence_files(spark, sf):
    folder = new_path(spark, "sequences")
    manifest = sequence_files.write_sequences(
        table(spark, sf, "documents"), vocabulary_path(TOKENIZER), folder, length=TOKEN_LIMIT, end_id=0
    )
    return sequence_files.read_documents(spark, folder, manifest)


@query
def op3_ngram_jaccard_join(spark, sf):
    return jaccard_join.similar_documents(table(spark, sf, "documents"), size=4, percent=85)


@query
def op4_source_mix(spark, sf):
    plan = mixing.plan_mix(table(spark, sf, "documents"), weights=[3.0, 1.0, 2.0], share=1.5, most_passes=2.0)
    return plan.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "shards"
    )


@query
def op9_shards(spark, sf):
    shards = sharding.shard_documents(table(spark, sf, "documents"), n_shards=8)
    return shards.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op5_fingerprints(spark, sf):
    rows = fingerprints.with_next(table(spark, sf, "documents"))
    n_chars = F.length("text").cast("long")
    cut = F.floor(n_chars / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), (n_chars - cut).cast("int")), F.substring("next_text", F.lit(1), cut)
    )
    rows = rows.withColumns({"n_chars": n_chars, "edited": edited}).drop("text", "next_text")
    rows = rows.withColumn("edited_signatures", fingerprints.signatures(F.col("edited")))
    own = F.col("signatures")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.fingerprint_text(own).alias("fingerprint"),
        fingerprints.fingerprint_text(F.col("edited_signatures")).alias("edited_fingerprint"),
        fingerprints.likeness(own, F.col("edited_signatures")).alias("near_edited"),
        fingerprints.likeness(own, F.col("next_signatures")).alias("near_next"),
    )


@query
def op7_toxicity(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    weights = toxicity.train(docs, labels.where(fold != 2))
    scored = toxicity.score(docs, weights)
    return scored.select(
        "doc_id",
        F.coalesce(fold == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op8_quality_classifier(spark, sf):
    return quality.judge_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op11_tokenizer_alignment(spark, sf):
    aligned = alignment.align_documents(
        table(spark, sf, "documents"), vocabulary_path(TOKENIZER), vocabulary_path(PIECES)
    )
    return aligned.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"),
    )


@query
def op12_embedding_whitening(spark, sf):
    whitened = whitening.whiten(table(spark, sf, "embeddings"), components=16, scale=64, offset=1_000_000)
    each = F.posexplode(F.arrays_zip("z", "explained")).alias("at", "of")
    return whitened.select("id", "n", "deviation", "identity_error", each).select(
        F.col("id").alias("vec_id"),
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        F.nanvl("of.z", F.lit(None).cast("double")).alias("whitened"),
        F.col("of.explained").alias("explained"),
        "identity_error",
    )


@query
def op13_exact_top_k(spark, sf):
    return exact_search.exact_top_k(table(spark, sf, "embeddings"), F.col("id") % 50 == 0, k=5, scale=256)
