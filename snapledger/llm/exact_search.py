"""Exact search for the k greatest inner products, by histograms of the scores.

Every query is scored against every row in cells: a block of queries and a block
of rows meet in one task. Scores are never kept. A pass over them returns
counts by interval; the counts of all cells give the interval of each query's
k-th score, which the next pass divides again until it is one score. A last pass
returns the rows above it and, of those equal to it, the smallest ids.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from snapledger.llm.vectors import floored, lengths, matrix
from snapledger.session import stage

_TILE = 64  # queries scored at once
_EXACT = 2.0**52  # differences of whole numbers below it are exact in double precision
_MOST = 2.0**61


def _cells(vectors: DataFrame, state: DataFrame, blocks: int, chunks: int):
    """Queries with their state and rows, dealt so that each pair meets in one cell (p, q)."""

    def block(word: str, n: int):
        return F.pmod(F.xxhash64("id", F.lit(word)), F.lit(n)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    given = vectors.select(
        every(blocks).alias("p"), block("given", chunks).alias("q"), "id", "x",
        F.lit(None).cast("long").alias("low"), F.lit(None).cast("int").alias("need"),
    )
    asking = state.join(vectors, "id").select(
        block("asks", blocks).alias("p"), every(chunks).alias("q"), "id", "x", "low", "need"
    )
    return asking.unionByName(given).groupBy("p", "q")


def _tiles(table: pa.Table, exact: bool):
    """The scores of a cell, some queries at a time; a query's own row has the least number."""
    need = table.column("need")
    asking, given = table.filter(need.is_valid()), table.filter(need.is_null())
    kind = np.float64 if exact else np.int64
    least = -np.inf if exact else np.iinfo(np.int64).min
    a, b = matrix(asking.column("x"), kind), matrix(given.column("x"), kind)
    a_id, b_id = (t.column("id").to_numpy() for t in (asking, given))
    low, need = asking.column("low").to_numpy(), asking.column("need").to_numpy()
    for i in range(0, len(a) if len(b) else 0, _TILE):
        some = slice(i, i + _TILE)
        scores = a[some] @ b.T
        scores[a_id[some, None] == b_id[None, :]] = least
        yield scores, least, a_id[some], b_id, low[some, None], need[some]


def _histogram(span: int, width: int, bins: int, k: int, exact: bool):
    """Counts by query and interval of ``width`` within the ``span`` from its low score on.
    Intervals under a cell's own k-th score cannot hold the k-th of all."""

    def run(table: pa.Table) -> pa.Table:
        ids, places, counts = [], [], []
        for scores, least, a_id, _, low, _ in _tiles(table, exact):
            # What lies above the interval of an earlier pass is counted already.
            inside = (scores >= low) & (scores - low < span) & (scores != least)
            scores = np.where(inside, scores, least)
            if scores.shape[1] > k:
                kth = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k, None]
                kth_bin = np.where(kth == least, 0, (np.where(kth == least, low, kth) - low) // width)
                inside &= scores >= low + kth_bin * width
            row, column = np.nonzero(inside)
            place = (scores[row, column] - low[row, 0]) // width
            found, n = np.unique(row * bins + place.astype(np.int64), return_counts=True)
            ids.append(a_id[found // bins])
            places.append(found % bins)
            counts.append(n)
        return pa.table(
            {
                "id": pa.array(np.concatenate(ids) if ids else [], pa.int64()),
                "bin": pa.array(np.concatenate(places) if ids else [], pa.int64()),
                "n": pa.array(np.concatenate(counts) if ids else [], pa.int64()),
            }
        )

    return run


def _winners(exact: bool):
    """Rows above each query's k-th score, and of the rows that equal it the smallest ids, as many as can be needed."""

    def run(table: pa.Table) -> pa.Table:
        ids, others, values = [], [], []
        for scores, least, a_id, b_id, low, need in _tiles(table, exact):
            row, column = np.nonzero((scores >= low) & (scores != least))
            score = scores[row, column].astype(np.int64)
            other = b_id[column]
            tied = score == low[row, 0]
            order = np.lexsort((other, tied, row))
            row, other, score, tied = row[order], other[order], score[order], tied[order]
            # Ties stand last in their query's rows; the first ``need`` of them go on.
            start = np.searchsorted(row, row) + np.bincount(row[~tied], minlength=len(a_id))[row]
            keep = ~tied | (np.arange(len(row)) - start < need[row])
            ids.append(a_id[row[keep]])
            others.append(other[keep])
            values.append(score[keep])
        columns = zip(("query_id", "vec_id", "score"), (ids, others, values))
        return pa.table({name: pa.array(np.concatenate(v) if v else [], pa.int64()) for name, v in columns})

    return run


def exact_top_k(
    rows: DataFrame,
    is_query,
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_queries: int = 8192,
    block_rows: int = 4096,
    bins: int = 4096,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of each row for which ``is_query`` holds.

    ``is_query`` is a condition on the column ``id``. The score is the inner
    product of the vectors' components times ``scale``, rounded down; equal scores
    rank by the smaller id. A query with fewer than k other rows gets them all.
    A task scores about ``block_queries`` against ``block_rows``; a pass divides
    the range of scores by ``bins``. None of the three affects the result.

    Rows with a null id and vectors that are null, empty, or hold a null or
    non-finite component take no part, nor do vectors whose rounded length would
    let a score reach 2^61. Vectors meet only those of their own length; more
    than 64 lengths are an error. Of rows that repeat an id the least vector
    counts. An empty table gives no rows; other columns are ignored.
    """
    spark = rows.sparkSession
    vectors = (
        rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
        .select("id", floored("v", scale).alias("x"))
        .where("id is not null and x is not null")
        .groupBy("id")
        .agg(F.min("x").alias("x"))
    )
    square = F.aggregate("x", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    vectors = stage(vectors.withColumn("square", square).where(F.col("square") < _MOST), "search-vectors")
    found = [
        _search(vectors.where(F.size("x") == length), n, is_query, k, block_queries, block_rows, bins)
        for length, n in lengths(vectors, "x")
        if n > 1
    ]
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        reduce(DataFrame.unionByName, found)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _search(vectors: DataFrame, n: int, is_query, k: int, block_queries: int, block_rows: int, bins: int) -> DataFrame:
    """Candidates of every query among vectors of one length: at least its k best."""
    queries = vectors.where(is_query).select("id")
    most, asking = vectors.agg(F.max("square"), F.count_if(is_query)).first()
    exact = most < _EXACT
    # No score lies outside: a product is at most the greater of the two squares.
    bound = math.floor(most * (1 + 1e-12)) + 1
    blocks, chunks = -(-max(asking, 1) // block_queries), -(-n // block_rows)
    vectors = vectors.select("id", "x")
    state = queries.select(
        "id", F.lit(-bound).cast("long").alias("low"), F.lit(min(k, n - 1)).cast("int").alias("need")
    )
    width = 2 * bound + 1
    while width > 1:
        span, width = width, -(-width // bins)
        counts = _cells(vectors, state, blocks, chunks).applyInArrow(
            _histogram(span, width, bins, k, exact), "id long, bin long, n long"
        )
        down = Window.partitionBy("id").orderBy(F.desc("bin"))
        reached = (
            counts.groupBy("id", "bin")
            .agg(F.sum("n").alias("n"))
            .withColumn("upto", F.sum("n").over(down))
            .join(state, "id")
            .where("upto >= need and upto - n < need")
        )
        state = stage(
            reached.select(
                "id",
                (F.col("low") + F.col("bin") * F.lit(width)).alias("low"),
                (F.col("need") - (F.col("upto") - F.col("n"))).cast("int").alias("need"),
            ),
            "search-state",
        )
    return _cells(vectors, state, blocks, chunks).applyInArrow(
        _winners(exact), "query_id long, vec_id long, score long"
    )
