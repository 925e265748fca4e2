"""Toxicity scores from FTRL-proximal logistic regression over hashed word features.

Features of a text are the hashed n-grams of its words, the skip-grams of words
with one word between them, and the beginnings of its words, each present or not.
The weights are learned by the per-coordinate FTRL-proximal rule, whose L1 term
leaves most of them at zero, on shards of labelled rows at once, whose states are
then averaged. What is left is a short list of weights, which goes to every task.
"""

from __future__ import annotations

import hashlib
import logging
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from snapledger.llm.memory import give_back
from snapledger.session import stage

log = logging.getLogger(__name__)

BITS = 20  # 2**BITS weights
# The usual names of the rule's parameters.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 1.5, 0.1

_WORD = re.compile(r"[^\W_]+")
_KEEP_WORDS = 60_000
_STEMS = (4, 5)
_CODES: dict[str, np.ndarray] = {}


def _codes(word: str) -> tuple[int, ...]:
    """64-bit hashes of a word and of its beginnings."""
    stems = [word] + [f"{n}^{word[:n]}" for n in _STEMS if len(word) > n]
    while len(stems) <= len(_STEMS):
        stems.append(stems[-1])
    return tuple(int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "little") for s in stems)


def features(text: str | None) -> np.ndarray:
    """Distinct feature numbers of a whole text, a constant one among them."""
    words = _WORD.findall((text or "").lower())
    for word in set(words).difference(_CODES):
        _CODES[word] = _codes(word)
    m = np.array([*map(_CODES.__getitem__, words)], np.uint64).reshape(-1, 1 + len(_STEMS))
    if len(_CODES) > _KEEP_WORDS:
        _CODES.clear()
    word = m[:, 0]
    mix = np.uint64(0x9E3779B97F4A7C15)
    pairs = word[:-1] * mix + word[1:]
    skips = (word[:-2] * mix + word[2:]) * mix
    found = np.concatenate([m.ravel(), pairs, skips, np.zeros(1, np.uint64)])
    return np.unique(((found * mix) >> np.uint64(64 - BITS)).astype(np.int64))


def forget_words() -> None:
    """Drop the worker's table of known words, at the end of a task."""
    _CODES.clear()
    give_back()


class Ftrl:
    """The state of the rule: a sum of gradients and a sum of their squares per coordinate."""

    def __init__(self, z: np.ndarray, n: np.ndarray):
        self.z, self.n = z, n

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        over = np.abs(z) - L1
        return np.where(over > 0, -np.sign(z) * over / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    def learn(self, at: np.ndarray, label: float, weight: float) -> None:
        w = self.weights(at)
        gradient = weight * (1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label)
        n = self.n[at]
        sigma = (np.sqrt(n + gradient * gradient) - np.sqrt(n)) / ALPHA
        self.z[at] += gradient - sigma * w
        self.n[at] = n + gradient * gradient


def train(
    docs: DataFrame, labels: DataFrame, most_rows: int = 24_000, shard_rows: int = 3_000, epochs: int = 3, seed: int = 0,
    id_col="doc_id", text_col="text", label_col="toxic",
) -> np.ndarray:
    """Weights learned from rows of ``docs`` that ``labels`` marks 0 or 1.

    Labelled rows are few enough to be bounded: of those that ``docs`` holds at most
    ``most_rows``, the first by a hash of the id. Their list is then small and goes to the documents, so that
    texts that are not learned from do not move. Ids that have both labels, rows
    with a null id or another label are left out; without rows all weights are 0.
    """
    marked = (
        labels.select(F.col(id_col).cast("long").alias("label_id"), F.col(label_col).cast("double").alias("label"))
        .where("label_id is not null and label in (0, 1)")
        .groupBy("label_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
    )
    # Ids only: labels of documents that are elsewhere must not use up the bound.
    held = docs.select(F.col(id_col).cast("long").alias("label_id")).where("label_id is not null")
    marked = marked.join(held, "label_id", "left_semi")
    chosen = stage(
        marked.orderBy(F.xxhash64("label_id", F.lit(seed)), "label_id").limit(most_rows).select("label_id", "label"),
        "toxicity-labels",
    )
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # At most most_rows pairs of numbers.
    rows = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "label")

    # A shard learns enough by itself, so the average is of models that agree.
    shards = -(-chosen.count() // shard_rows) or 1
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(shards)))

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        examples = [*zip(map(features, table.column("text").to_pylist()), table.column("label").to_pylist())]
        model = Ftrl(np.zeros(1 << BITS), np.zeros(1 << BITS))
        order = np.random.default_rng(seed)
        for _ in range(epochs):
            for i in order.permutation(len(examples)).tolist():
                model.learn(*examples[i], 1.0)
        at = np.flatnonzero(model.n)
        return pa.table({"at": pa.array(at, pa.int64()), "z": model.z[at], "n": model.n[at]})

    learned = dealt.groupBy("shard").applyInArrow(learn, "at long, z double, n double")
    # At most 2**BITS coordinates, whatever the data. The average is over the shards that
    # saw a coordinate: a rare word must not lose to shards without it.
    found = learned.groupBy("at").agg(F.avg("z").alias("z"), F.avg("n").alias("n")).toArrow()
    model = Ftrl(np.zeros(1 << BITS), np.zeros(1 << BITS))
    at = found.column("at").to_numpy()
    model.z[at] = found.column("z").to_numpy()
    model.n[at] = found.column("n").to_numpy()
    return model.weights()


def with_score(docs: DataFrame, weights: np.ndarray, text_col="text", name="score") -> DataFrame:
    """``docs`` with a last column ``name``: the score (0 to 1) of each whole text, and of nothing else.

    Null and empty texts have the score of the constant feature. All other columns
    pass through; ``name`` must not be one of them. An empty table gives no rows.
    """
    if name in docs.columns:
        raise ValueError(f"{name} is already a column")
    used = np.flatnonzero(weights)
    # At most 2**BITS pairs of numbers; a few hundred after training.
    compact = docs.sparkSession.sparkContext.broadcast((used, weights[used]))
    at_text = docs.columns.index(text_col)

    def run(batches):
        at, values = compact.value
        dense = np.zeros(1 << BITS)
        dense[at] = values
        for batch in batches:
            sums = [dense[features(t)].sum() for t in batch.column(at_text).to_pylist()]
            scores = 1 / (1 + np.exp(-np.clip(np.array(sums, np.float64), -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, name])
        forget_words()

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def score(docs: DataFrame, weights: np.ndarray, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, score: one row per row of ``docs``; see ``with_score``. Other columns are ignored."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return with_score(texts, weights).select("doc_id", "score")


def harmless_documents(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col="doc_id", text_col="text", **training
) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns; all rows if nothing was learned."""
    weights = train(docs, labels, id_col=id_col, text_col=text_col, **training)
    if not weights.any():
        log.warning("no label of any document taught anything: all documents pass unscored")
        return docs
    scored = with_score(docs, weights, text_col, "_toxicity")
    return scored.where(F.col("_toxicity") < threshold).select(*docs.columns)
