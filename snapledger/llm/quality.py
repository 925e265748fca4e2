"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is of characters: its n-grams are the last ``ORDER`` characters at each
place of a text. Texts are packed into chunks of bounded size. A chunk names its
distinct n-grams once; counts of trusted text, the model's tables and the
probabilities that the chunks ask for are tables keyed by n-gram and joined by it,
so that no task ever holds the model. A document's perplexity is held against a
quantile of the perplexities of trusted documents of its language and about its
length, as those of short texts vary far more than those of long ones.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from snapledger.llm.memory import give_back
from snapledger.llm.rows import row_key
from snapledger.llm.shuffles import shuffle_files_removed
from snapledger.session import stage

ORDER = 4
_START = "\x02"  # stands before a text, ORDER - 1 times
_CHUNK_DOCS = 50_000
_RUN_CHARS = 500_000  # characters whose n-grams are numbered at once
_READ_ROWS = 512  # rows of a batch that are Python objects at once
_CODEC = pa.Codec("zstd", compression_level=9)


# --- chunks ----------------------------------------------------------------
def _chunked(rows, chunk_chars):
    """Cuts rows (..., length) of one task into chunks; yields (chunk, rows)."""
    part, number, held, chars = TaskContext.get().partitionId(), 0, [], 0
    for row in rows:
        held.append(row)
        chars += row[-1]
        if chars >= chunk_chars or len(held) >= _CHUNK_DOCS:
            yield (part << 24) + number, held
            number, held, chars = number + 1, [], 0
    if held:
        yield (part << 24) + number, held


def _rows(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, _READ_ROWS):
            yield from zip(*(c.to_pylist() for c in batch.slice(start, _READ_ROWS).columns))


def _pack_chunks(batches, chunk_chars: int):
    """One row per chunk, its texts compressed."""
    for chunk, rows in _chunked(_rows(batches), chunk_chars):
        ids, langs, hashes, texts, lengths = zip(*rows)
        raw = "".join(texts).encode("utf-8", "surrogatepass")
        row = {
            "chunk": pa.array([chunk], pa.int64()),
            "doc_ids": pa.array([ids], pa.list_(pa.int64())),
            "langs": pa.array([langs], pa.list_(pa.string())),
            "hashes": pa.array([hashes], pa.list_(pa.binary())),
            "lengths": pa.array([lengths], pa.list_(pa.int32())),
            "size": pa.array([len(raw)], pa.int64()),
            "digest": pa.array([hashlib.blake2b(raw, digest_size=16).hexdigest()], pa.string()),
            "texts": pa.array([_CODEC.compress(raw, asbytes=True)], pa.binary()),
        }
        yield pa.RecordBatch.from_pydict(row)


def _packed(chunk_chars: int):
    return lambda batches: _pack_chunks(batches, chunk_chars)


_PACKED = "chunk long, doc_ids array<long>, langs array<string>, hashes array<binary>, lengths array<int>, size long, digest string, texts binary"


def _check(chunk: int, digest: str, expected: str | None) -> None:
    """Texts are packed anew by each pass. Rows that arrive in another order make other chunks."""
    if digest != expected:
        raise RuntimeError(f"chunk {chunk} differs from that of an earlier pass: the order of the rows is not fixed; stage them")


def _runs(lengths: np.ndarray, size: int, texts: bytes):
    """Cuts a chunk into runs of whole documents, which bounds the arrays over its places.

    Yields (slice of documents, distinct n-grams, the number of each place's, first place of each document)."""
    text = _CODEC.decompress(texts, size, asbytes=True).decode("utf-8", "surrogatepass")
    ends = np.cumsum(lengths)
    start = place = 0
    while start < len(lengths):
        stop = max(start + 1, int(np.searchsorted(ends, place + _RUN_CHARS, "right")))
        last = int(ends[stop - 1])
        yield slice(start, stop), *_grams(lengths[start:stop], text[place:last])
        start, place = stop, last


def _grams(lengths: np.ndarray, text: str):
    """The distinct n-grams of documents laid end to end, the number of each place's, and the first place of each document."""
    flat = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    before = ORDER - 1
    # Every text has the start mark in front, ORDER - 1 times.
    codes = np.full(len(flat) + before * len(lengths), ord(_START), np.uint32)
    places = np.arange(len(flat), dtype=np.int32)
    places += np.repeat(before * np.arange(1, len(lengths) + 1, dtype=np.int32), lengths)
    codes[places] = np.where(flat == 0, 0xFFFD, flat)
    del flat
    letters = pd.factorize(codes)[0].astype(np.int32)
    n_letters = int(letters.max(initial=0)) + 1
    key, span = letters[places - before].astype(np.int64), n_letters
    for back in range(before - 1, -1, -1):
        if span * n_letters >= 1 << 62:
            key, names = pd.factorize(key)
            span = len(names)
        key *= n_letters
        key += letters[places - back]
        span *= n_letters
    number = pd.factorize(key)[0].astype(np.int32)
    del key, letters
    # Each n-gram is spelled from the first place where it stands.
    n = int(number.max(initial=-1)) + 1
    at = np.empty(n, np.int32)
    at[number[::-1]] = places[::-1]
    spelled = np.stack([codes[at - back] for back in range(before, -1, -1)], 1) if n else np.zeros((0, ORDER), np.uint32)
    grams = np.ascontiguousarray(spelled).view(f"<U{ORDER}").ravel().tolist()
    return grams, number, np.cumsum(lengths) - lengths


def _asked(batches):
    """Of each chunk its distinct n-grams, and how often each stands in trusted texts."""
    for batch in batches:
        for chunk, lengths, size, digest, texts, expected, trusted in _rows([batch]):
            _check(chunk, digest, expected)
            lengths = np.array(lengths, np.int64)
            chosen = np.zeros(len(lengths), bool)
            chosen[trusted or []] = True
            parts = []
            for run, grams, number, _ in _runs(lengths, size, texts):
                count = np.bincount(number[np.repeat(chosen[run], lengths[run])], minlength=len(grams))
                parts.append(pa.table({"gram": pa.array(grams, pa.string()), "n": pa.array(count, pa.int64())}))
                del grams, number, count
            whole = pa.concat_tables(parts).group_by("gram", use_threads=False).aggregate([("n", "sum")])
            named = pa.table(
                {"chunk": pa.array([chunk] * whole.num_rows, pa.int64()), "gram": whole["gram"], "n": whole["n_sum"]}
            )
            yield from named.combine_chunks().to_batches()
            del parts, whole, named
    give_back()


_SCORED = pa.schema(
    [
        ("chunk", pa.int64()),
        ("pos", pa.int32()),
        ("doc_id", pa.int64()),
        ("lang", pa.string()),
        ("row_hash", pa.binary()),
        ("length", pa.int32()),
        ("perplexity", pa.float64()),
    ]
)


def _scored(packed: pa.Table, answers: pa.Table) -> pa.Table:
    """The perplexity of every document of a chunk."""
    known = dict(zip(answers.column("gram").to_pylist(), answers.column("logp").to_pylist()))
    out = []
    for chunk, ids, langs, hashes, lengths, size, digest, texts, expected in _rows(packed.to_batches()):
        _check(chunk, digest, expected)
        lengths = np.array(lengths, np.int64)
        sums = np.zeros(len(lengths))
        full = lengths > 0
        for run, grams, number, firsts in _runs(lengths, size, texts):
            logp = np.array([known[g] for g in grams], np.float64)[number]  # every n-gram has been asked for
            if full[run].any():
                sums[run][full[run]] = np.add.reduceat(logp, firsts[full[run]])
            del grams, number, logp
        mean = np.divide(sums, lengths, out=np.full(len(lengths), np.nan), where=full)
        perplexity = pa.array(np.exp(-mean), mask=~full)
        out.append(
            pa.table(
                {
                    "chunk": pa.array([chunk] * len(ids), pa.int64()),
                    "pos": pa.array(range(len(ids)), pa.int32()),
                    "doc_id": pa.array(ids, pa.int64()),
                    "lang": pa.array(langs, pa.string()),
                    "row_hash": pa.array(hashes, pa.binary()),
                    "length": pa.array(lengths, pa.int32()),
                    "perplexity": perplexity,
                }
            )
        )
    return pa.concat_tables(out) if out else _SCORED.empty_table()


# --- the model -------------------------------------------------------------
def _discounts(counts: list[DataFrame]) -> list[list[float]]:
    """D1, D2, D3+ of each order, from how many n-grams have the counts 1 to 4."""
    of = lambda k: F.count(F.when(F.col("c") == k, 1)).alias(f"n{k}")
    found = []
    for table in counts:
        n1, n2, n3, n4 = table.agg(*map(of, range(1, 5))).first()
        y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        ratios = [(n1, n2), (n2, n3), (n3, n4)]
        raw = [k - (k + 1) * y * b / a if a else k * y for k, (a, b) in enumerate(ratios, 1)]
        found.append([min(max(d, 0.0), float(k)) for k, d in enumerate(raw, 1)])
    return found


def log_probabilities(asked: DataFrame, trusted: DataFrame) -> DataFrame:
    """gram, logp for the distinct n-grams ``asked`` (gram), from ``trusted`` counts (gram, n).

    An n-gram's discounted share of its context, plus what the discounts freed
    times the probability one character shorter. Below the full order the counts
    are of different characters in front. The shortest falls back on an even
    chance of all characters. Every step is a join on n-gram or context.
    """
    counts = [stage(trusted.where("n > 0").groupBy("gram").agg(F.sum("n").alias("c")), "gram-counts")]
    wanted = [stage(asked.select("gram").distinct(), "grams-asked")]
    shorter = F.substring("gram", 2, ORDER).alias("gram")
    for _ in range(ORDER - 1):
        counts.append(stage(counts[-1].groupBy(shorter).agg(F.count("*").alias("c")), "gram-counts"))
        wanted.append(stage(wanted[-1].select(shorter).distinct(), "grams-asked"))
    discounts = _discounts(counts)
    n_letters = wanted[-1].count() + 1
    lower = None
    for order in range(1, ORDER + 1):
        table, (d1, d2, d3) = counts[ORDER - order], discounts[ORDER - order]
        context = F.substring("gram", 1, order - 1).alias("context")
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        contexts = table.groupBy(context).agg(
            F.sum("c").alias("total"), (F.sum(cut) / F.sum("c")).alias("freed")
        )
        ask = wanted[ORDER - order].withColumn("context", context)
        if order == 1:
            ask = ask.withColumn("low", F.lit(1.0 / n_letters))
        else:
            ask = ask.withColumn("rest", F.substring("gram", 2, ORDER)).join(
                lower.select(F.col("gram").alias("rest"), F.col("p").alias("low")), "rest"
            )
        share = F.coalesce((F.col("c") - cut) / F.col("total"), F.lit(0.0))
        lower = stage(
            ask.join(table, "gram", "left")
            .join(contexts, "context", "left")
            .select("gram", (share + F.coalesce("freed", F.lit(1.0)) * F.col("low")).alias("p")),
            "gram-probabilities",
        )
    return lower.select("gram", F.log("p").alias("logp"))


# --- the operator ----------------------------------------------------------
def judge_quality(
    docs: DataFrame, labels: DataFrame, quantile: float = 0.999,
    id_col="doc_id", text_col="text", lang_col="lang", label_col="quality", chunk_chars: int = 4_000_000,
) -> DataFrame:
    """doc_id, lang, row_hash, perplexity, threshold, keep: one row per row of ``docs``.

    Trusted are the documents whose id has only labels of 1 in ``labels``; all of
    them are learned from. Lengths are banded by powers of two characters. A
    document is kept if its perplexity is at most the ``quantile`` of the trusted
    ones of its language in its band and the two beside it, or in all bands if
    those three hold none; a null language is one of its own. A language without
    trusted text has no threshold and keeps its documents. A null or empty text has
    no perplexity and is not kept. Rows that repeat an id, or have none, are judged
    each; an empty table gives no rows; other columns are ignored. Rows must come
    in the same order each time ``docs`` is read, as from files; else it is an error.
    Texts are packed in chunks of ``chunk_chars`` characters, which bounds what a
    task holds and does not affect results.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(lang_col).alias("lang"),
        F.unhex(_row_hash(id_col, lang_col, text_col)).alias("row_hash"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumn("length", F.length("text"))
    marked = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).alias("label"))
    good = marked.where("label is not null").groupBy("doc_id").agg(F.min("label").alias("label")).where("label = 1")
    packed = rows.mapInArrow(_packed(chunk_chars), _PACKED)
    band = F.length(F.bin(F.col("length").cast("long")))
    with shuffle_files_removed(spark):
        # Each use of the packed texts runs the same plan; the digests of the first prove that it gave the same chunks.
        chunks = stage(packed.select("chunk", "digest", "doc_ids"), "chunks")
        # A table of its own, one short row a chunk: the planner then knows how small it is.
        expected = stage(chunks.select("chunk", F.col("digest").alias("expected")), "chunk-digests")
        index = chunks.select("chunk", F.posexplode("doc_ids").alias("pos", "doc_id"))
        trusted = stage(index.join(good.select("doc_id"), "doc_id").select("chunk", "pos"), "trusted")
        lists = trusted.groupBy("chunk").agg(F.sort_array(F.collect_list("pos")).alias("trusted"))
        asked = stage(
            packed.select("chunk", "lengths", "size", "digest", "texts")
            .join(expected, "chunk", "left")
            .join(lists, "chunk", "left")
            .mapInArrow(_asked, "chunk long, gram string, n long"),
            "chunk-grams",
        )
        answers = log_probabilities(asked, asked.select("gram", "n"))
        answered = asked.select("chunk", "gram").join(answers, "gram")
        scores = stage(
            packed.join(expected, "chunk", "left")
            .groupBy("chunk")
            .cogroup(answered.groupBy("chunk"))
            .applyInArrow(_scored, "chunk long, pos int, doc_id long, lang string, row_hash binary, length int, perplexity double"),
            "perplexities",
        )
        near = F.array(band - 1, band, band + 1, F.lit(None))  # null: all bands of the language
        limits = stage(
            scores.join(trusted, ["chunk", "pos"])
            .where("perplexity is not null")
            .select("lang", "perplexity", F.explode(near).alias("band"))
            .groupBy("lang", "band")
            .agg(F.percentile_approx("perplexity", quantile, 100_000).alias("threshold")),
            "thresholds",
        )
    banded = limits.where("band is not null").select(
        F.col("lang").alias("of"), F.col("band").alias("near"), F.col("threshold").alias("banded")
    )
    whole = limits.where("band is null").select(F.col("lang").alias("of_all"), F.col("threshold").alias("whole"))
    keep = F.coalesce(F.col("perplexity") <= F.coalesce("threshold", F.lit(float("inf"))), F.lit(False))
    return (
        scores.join(banded, F.col("lang").eqNullSafe(F.col("of")) & (band == F.col("near")), "left")
        .join(whole, F.col("lang").eqNullSafe(F.col("of_all")), "left")
        .withColumn("threshold", F.coalesce("banded", "whole"))
        .select("doc_id", "lang", F.hex("row_hash").alias("row_hash"), "perplexity", "threshold", keep.alias("keep"))
    )


def _row_hash(id_col, lang_col, text_col):
    return row_key(F.col(id_col), F.col(lang_col), F.col(text_col))


def good_documents(
    docs: DataFrame, labels: DataFrame, quantile: float = 0.999,
    id_col="doc_id", text_col="text", lang_col="lang", label_col="quality", chunk_chars: int = 4_000_000,
) -> DataFrame:
    """The rows of ``docs`` that ``judge_quality`` keeps, with all their columns.

    A verdict depends on language and text, so rows equal in id, language and
    text share it.
    """
    judged = judge_quality(docs, labels, quantile, id_col, text_col, lang_col, label_col, chunk_chars)
    kept = stage(judged.where("keep").select(F.col("row_hash").alias("_row_hash")), "kept-rows")
    keyed = docs.withColumn("_row_hash", _row_hash(id_col, lang_col, text_col))
    return keyed.join(kept, "_row_hash", "left_semi").select(*docs.columns)
