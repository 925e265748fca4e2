"""Near-duplicate vectors: spherical k-means cells, blocked products inside them.

Equal vectors of a label are one vector with a count. k-means only decides which
vectors meet; the result does not depend on it. A vector is at home in the cell
of its nearest centre. A vector within the angle of a vector at home in another
cell lies at most that angle beyond the plane between the two centres, so it is
a guest of every cell whose plane is that near, and no pair is missed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from snapledger.llm.components import components
from snapledger.session import stage

_CELL_ROWS = 2048  # vectors to a centre, on average
_MOST_CENTRES = 1024
_ROUNDS = 4
_BLOCK_ROWS = 256


def _units(column: pa.Array) -> np.ndarray:
    """Rows of unit length in double precision; scaled first, so that no square overflows or vanishes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    m = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def usable_vectors(rows: DataFrame, id_col="vec_id", vector_col="embedding", label_col="label") -> DataFrame:
    """rep, label, vector, n: one row per different vector of a label, ``rep`` its least id.

    Left out: rows without id or label, and vectors that are null, empty, zero or
    have a null or non-finite component.
    """
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return (
        rows.select(
            F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")
        )
        .where("id is not null and label is not null and vector is not null")
        .where(F.coalesce(sound, F.lit(False)) & F.exists("vector", lambda x: x != 0))
        .groupBy("label", "vector")
        .agg(F.min("id").alias("rep"), F.count("*").alias("n"))
    )


def spherical_kmeans(vectors: DataFrame, k: int, dimension: int, rounds: int = _ROUNDS, seed: int = 0) -> np.ndarray:
    """Centres of unit length. Every round goes through all vectors; a task returns one sum per centre."""
    start = vectors.select("vector", F.xxhash64("rep", F.lit(seed)).alias("h")).orderBy("h").limit(k)
    centres = _units(pa.array([r.vector for r in start.collect()], pa.list_(pa.float64()))).reshape(-1, dimension)

    def sums(batches, centres):
        total, count = np.zeros_like(centres), np.zeros(len(centres), np.int64)
        for batch in batches:
            m = _units(batch.column("vector"))
            if len(m):
                nearest = np.argmax(m @ centres.T, axis=1)
                np.add.at(total, nearest, m)
                count += np.bincount(nearest, minlength=len(centres))
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(list(total[used]), pa.list_(pa.float64()))], ["k", "total"]
        )

    for _ in range(rounds):
        fixed = centres
        found = (
            vectors.select("vector")
            .mapInArrow(lambda batches: sums(batches, fixed), "k long, total array<double>")  # noqa: B023
            .select("k", F.posexplode("total").alias("i", "x"))
            .groupBy("k", "i")
            .agg(F.sum("x").alias("x"))
            .groupBy("k")
            .agg(F.sort_array(F.collect_list(F.struct("i", "x")))["x"].alias("total"))
            .collect()
        )
        moved = centres.copy()
        for row in found:
            norm = np.linalg.norm(row.total)
            if norm > 0:
                moved[row.k] = np.array(row.total) / norm
        centres = moved
    return np.unique(centres, axis=0)


def _assign(centres: np.ndarray, threshold: float):
    """For each vector its home cell and the cells it is a guest of."""
    apart = np.linalg.norm(centres[:, None, :] - centres[None, :, :], axis=2)
    reach = math.sin(math.acos(threshold)) + 1e-9

    def run(batches):
        for batch in batches:
            m = _units(batch.column("vector"))
            n = len(m)
            products = m @ centres.T if n else np.zeros((0, len(centres)))
            home = np.argmax(products, axis=1) if n else np.zeros(0, np.int64)
            beyond = products[np.arange(n), home][:, None] - products
            guest = beyond <= reach * apart[home] + 1e-9
            guest[np.arange(n), home] = False
            row, cell = np.nonzero(guest)
            take = np.concatenate([np.arange(n), row])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(pa.array(take)) for c in ("rep", "label", "vector", "n")),
                    pa.array(np.concatenate([home, cell]), pa.int64()),
                    pa.array(np.arange(len(take)) < n),
                ],
                ["rep", "label", "vector", "n", "cell", "home"],
            )

    return run


def _compare(threshold: float):
    """One block of a cell's own vectors against one block of all its vectors."""

    def run(table: pa.Table) -> pa.Table:
        asks = table.filter(table.column("asks"))
        given = table.filter(table.column("given"))
        a, b = _units(asks.column("vector")), _units(given.column("vector"))
        a_rep, b_rep = asks.column("rep").to_numpy(), given.column("rep").to_numpy()
        n = given.column("n").to_numpy()
        links = np.zeros(len(a), np.int64)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        parent = {}

        def root(x):
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        for i in range(0, len(a) if len(b) else 0, 256):
            near = a[i : i + 256] @ b.T >= threshold
            near &= a_rep[i : i + 256, None] != b_rep[None, :]
            links[i : i + 256] = near @ n
            row, column = np.nonzero(near)
            found.append((a_rep[i + row], b_rep[column]))
            if len(row):
                # Of the links, a spanning forest of this block goes on.
                kept = []
                for x, y in zip(*(v.tolist() for v in found.pop())):
                    p, q = root(x), root(y)
                    if p != q:
                        parent[max(p, q)] = min(p, q)
                        kept.append((x, y))
                if kept:
                    found.append(tuple(np.array(kept, np.int64).T))
        u, v = (np.concatenate(c) for c in zip(*found))
        none = np.full(len(u), 0, np.int64)
        return pa.table(
            {
                "rep": pa.array(np.concatenate([a_rep, u]), pa.int64()),
                "links": pa.array(np.concatenate([links, none]), pa.int64()),
                "other": pa.array(np.concatenate([a_rep, v]), pa.int64()),
            }
        )

    return run


def near_duplicates(
    rows: DataFrame, threshold: float, id_col="vec_id", vector_col="embedding", label_col="label", seed: int = 0
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``rows``.

    Two vectors of one label link when their cosine, in double precision, is at
    least ``threshold``. ``n_links`` counts the other rows linked directly, copies
    included; ``component_id`` is the least id reachable; ``kept`` marks that row.
    Vectors that ``usable_vectors`` leaves out link with nothing and are kept, as
    is each row with a null id, which has a null component. Vectors of different
    lengths link with nothing. Rows that repeat an id link as their vectors do
    and count separately. An empty table gives no rows; other columns are ignored.

    A cell of any size is cut into blocks, and each pair of blocks is compared in
    a task of its own that returns counts and a spanning forest, never all pairs.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    vectors = stage(usable_vectors(rows, id_col, vector_col, label_col), "vectors")
    kinds = dict(vectors.dtypes)
    links = None
    # One pass per length of vector that occurs; usually one.
    for (dimension,) in vectors.select(F.size("vector")).distinct().collect():
        of_length = vectors.where(F.size("vector") == dimension)
        k = min(_MOST_CENTRES, -(-of_length.count() // _CELL_ROWS))
        centres = spherical_kmeans(of_length, k, dimension, seed=seed)
        assigned = stage(
            of_length.mapInArrow(
                _assign(centres, threshold),
                f"rep long, label {kinds['label']}, vector {kinds['vector']}, n long, cell long, home boolean",
            ),
            "cells",
        )
        counts = assigned.groupBy("label", "cell").agg(
            F.ceil(F.count(F.when(F.col("home"), 1)) / _BLOCK_ROWS).alias("asking"),
            F.ceil(F.count("*") / _BLOCK_ROWS).alias("giving"),
        )
        sized = assigned.join(stage(counts.where("asking > 0"), "cell-counts"), ["label", "cell"])
        own = F.pmod(F.xxhash64("rep", F.lit("ask")), F.col("asking"))
        mine = F.pmod(F.xxhash64("rep", F.lit("give")), F.col("giving"))
        every = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
        # A row asks in its own row of block pairs and is given in its own column.
        both = F.struct(own.alias("p"), mine.alias("q"), F.lit(True).alias("asks"), F.lit(True).alias("given"))
        ask = F.transform(
            F.filter(every("giving"), lambda q: q != mine),
            lambda q: F.struct(own.alias("p"), q.alias("q"), F.lit(True).alias("asks"), F.lit(False).alias("given")),
        )
        give = F.transform(
            F.filter(every("asking"), lambda p: ~F.col("home") | (p != own)),
            lambda p: F.struct(p.alias("p"), mine.alias("q"), F.lit(False).alias("asks"), F.lit(True).alias("given")),
        )
        places = F.when(F.col("home"), F.concat(F.array(both), ask, give)).otherwise(give)
        compared = (
            sized.withColumn("place", F.explode(places))
            .select("label", "cell", "place.*", "rep", "vector", "n")
            .groupBy("label", "cell", "p", "q")
            .applyInArrow(_compare(threshold), "rep long, links long, other long")
        )
        links = compared if links is None else links.unionByName(compared)
    all_ids = rows.select(F.col(id_col).cast("long").alias("vec_id"))
    if links is None:
        return all_ids.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
            F.lit(True).alias("kept"),
        )
    links = stage(links, "links")
    linked = components(links, "rep", "other")
    totals = links.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = stage(
        vectors.select("rep", "label", "n")
        .join(totals, "rep", "left")
        .join(linked, F.col("rep") == F.col("node"), "left")
        .select(
            "rep",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        ),
        "vector-classes",
    )
    named = rows.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("l"), F.col(vector_col).alias("v")
    )
    same = (F.col("l") == F.col("label")) & (F.col("v") == F.col("vector")) & F.col("vec_id").isNotNull()
    members = stage(
        named.join(vectors.select("label", "vector", "rep"), same, "left").select("vec_id", "rep"), "vector-members"
    )
    return (
        members.join(classes, "rep", "left")
        .withColumn("component_id", F.coalesce("component_id", "vec_id"))
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            "component_id",
            F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"),
        )
    )
