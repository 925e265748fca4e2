"""Packing documents into fixed-length sequences with a grouping genetic algorithm.

Documents become pieces of at most one sequence. Full pieces need no search. The
others are dealt at random to blocks of bounded size. A best fit of each block
gives sequences without a gap, which nothing can improve: they stay, and the
pieces of the others are dealt anew to fewer blocks, while that leaves clearly
fewer. What is left is searched: each block is a bin-packing problem of its own,
solved on several islands that exchange their best packings. Its better-filled
sequences stay, and the others are dealt and searched again until one block holds
them. An individual is a packing; crossover moves whole well-filled bins.
"""

from __future__ import annotations

import bisect
import random
import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from snapledger.llm.encoding import forget_encoders, batches as runs, encoder
from snapledger.session import stage

_BLOCK = 2048  # pieces in a block, on average
_SHRINK = 0.8  # best fit goes on while it leaves at most this share of the pieces
_ISLANDS = 2
_EPOCHS = 2  # migrations happen between them
_GENERATIONS = 20
_POPULATION = 10
_ELITES = 2
_STARTS = 3  # best fits a first population begins with
_LEVEL = 1 << 56  # sequence ids of one dealing lie below this
_BINS = 1 << 24  # more than a block has bins

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKINGS = "array<struct<bins: int, fill: double, assign: array<int>>>"


# --- documents to pieces ---------------------------------------------------
def pieces(
    docs: DataFrame, path: str, capacity=1024, end_id=2, id_col="doc_id", text_col="text", keep_tables=True,
    chunk_chars=4_000_000,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32.

    A document is its whole text's ids, then ``end_id``; a null or empty text is
    the end alone. Documents over ``capacity`` are cut into pieces of exactly
    that, but for the first, which takes what is left over. Rows with a null or
    repeated id are cut each. ``keep_tables`` leaves a worker's tables of known
    parts to its next task; without it a task costs more time and its worker
    holds nothing afterwards. Texts are encoded ``chunk_chars`` at a time: a part is
    looked up once a chunk, and 4 million characters take about 100 MB more than 500,000.
    """

    def cut(batches):
        try:
            yield from cut_all(batches)
        finally:
            if not keep_tables:
                forget_encoders()

    end = end_id.to_bytes(4, "little")

    def cut_all(batches):
        tool = encoder(path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in runs(texts, chunk_chars):
                ids, bounds = tool.encode_flat(texts[a:b])
                n = np.diff(bounds) + 1
                first = (n - 1) % capacity + 1
                counts = -(-n // capacity)
                doc = np.repeat(np.arange(b - a), counts)
                number = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = np.where(number == 0, 0, first[doc] + (number - 1) * capacity)
                length = np.where(number == 0, first[doc], capacity)
                # The end is not among the ids: it follows those of a document's last piece.
                last = number == counts[doc] - 1
                at = 4 * (bounds[doc] + start)
                view = memoryview(ids).cast("B")
                sums = [zlib.crc32(view[p:q]) for p, q in zip(at.tolist(), (at + 4 * (length - last)).tolist())]
                for i in np.flatnonzero(last).tolist():
                    sums[i] = zlib.crc32(end, sums[i])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a).take(pa.array(doc)),
                        pa.array(number, pa.int32()),
                        pa.array(start),
                        pa.array(length),
                        pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        cut, _PIECES
    )


# --- one block -------------------------------------------------------------
class Packing:
    """``assign[i]`` is the bin of item ``i``; ``fills`` are the sums of the bins."""

    def __init__(self, assign: np.ndarray, sizes: np.ndarray, capacity: int):
        # Number the bins without gaps.
        self.assign = np.unique(assign, return_inverse=True)[1].astype(np.int32)
        self.fills = np.bincount(self.assign, weights=sizes).astype(np.int64)
        self.bins = len(self.fills)
        self.fill = float(np.mean((self.fills / capacity) ** 2)) if self.bins else 1.0

    def key(self):
        return self.bins, -self.fill


def best_fit(sizes: np.ndarray, items, assign: np.ndarray, fills: dict[int, int], capacity: int) -> None:
    """Put items, in the order given, into the fullest bin that holds them; open bins as needed."""
    room = sorted((capacity - fill, b) for b, fill in fills.items())
    fresh = max(fills, default=-1) + 1
    for i in items:
        size = int(sizes[i])
        at = bisect.bisect_left(room, (size, -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b, fresh = capacity, fresh, fresh + 1
        assign[i] = b
        if left > size:
            bisect.insort(room, (left - size, b))


def pack_in_order(sizes: np.ndarray, order, capacity: int) -> Packing:
    assign = np.zeros(len(sizes), np.int32)
    best_fit(sizes, order, assign, {}, capacity)
    return Packing(assign, sizes, capacity)


def crossover(a: Packing, b: Packing, sizes: np.ndarray, capacity: int, rng: random.Random) -> Packing:
    """Inject well-filled bins of ``b`` into ``a``.

    Bins of ``a`` that hold an injected item go; their other items are displaced
    and enter the bins that are left by best fit, largest first.
    """
    if a.bins < 2 or b.bins < 2:
        return a
    by_fill = np.argsort(-b.fills, kind="stable")
    pool = by_fill[: max(1, b.bins // 2)].tolist()
    chosen = rng.sample(pool, max(1, min(len(pool), b.bins // 12)))
    injected = np.zeros(b.bins, bool)
    injected[chosen] = True
    moved = injected[b.assign]
    gone = np.zeros(a.bins, bool)
    gone[a.assign[moved]] = True
    # The emptiest bin of the first parent is always re-packed.
    gone[int(np.argmin(a.fills))] = True
    assign = a.assign.copy()
    assign[moved] = b.assign[moved] + a.bins
    displaced = np.flatnonzero(gone[a.assign] & ~moved)
    displaced = displaced[np.argsort(-sizes[displaced], kind="stable")]
    fills = {int(k): int(a.fills[k]) for k in np.flatnonzero(~gone)}
    fills.update((int(k) + a.bins, int(b.fills[k])) for k in chosen)
    best_fit(sizes, displaced.tolist(), assign, fills, capacity)
    return Packing(assign, sizes, capacity)


def mutate(a: Packing, sizes: np.ndarray, capacity: int, rng: random.Random) -> Packing:
    """Empty some bins, the least filled among them, and best-fit their items in random order."""
    gone = np.zeros(a.bins, bool)
    gone[rng.sample(range(a.bins), max(1, a.bins // 12))] = True
    gone[int(np.argmin(a.fills))] = True
    assign = a.assign.copy()
    displaced = np.flatnonzero(gone[a.assign]).tolist()
    rng.shuffle(displaced)
    best_fit(sizes, displaced, assign, {int(k): int(a.fills[k]) for k in np.flatnonzero(~gone)}, capacity)
    return Packing(assign, sizes, capacity)


def evolve(sizes: np.ndarray, elites: list, capacity: int, rng: random.Random) -> list[Packing]:
    """One epoch on one island; the first packings are ``elites`` and mutants of them, or at first of
    best fits by size, in falling order and nearly so. The best individual is never lost."""
    population = [Packing(np.asarray(e, np.int32), sizes, capacity) for e in elites]
    if not population:
        for noise in np.linspace(0, 0.2, _STARTS):
            keys = sizes * np.array([rng.uniform(1 - noise, 1 + noise) for _ in range(len(sizes))])
            population.append(pack_in_order(sizes, np.argsort(-keys, kind="stable").tolist(), capacity))
    while len(population) < _POPULATION:
        population.append(mutate(rng.choice(population), sizes, capacity, rng))
    least = -(-int(sizes.sum()) // capacity)
    for _ in range(_GENERATIONS):
        population.sort(key=Packing.key)
        if population[0].bins <= least:
            break
        parents = population[: max(2, _POPULATION // 2)]
        children = []
        while len(children) < _POPULATION - _ELITES:
            a, b = rng.sample(parents, 2)
            children.append(crossover(a, b, sizes, capacity, rng))
        population = population[:_ELITES] + children
    return sorted(population, key=Packing.key)[:_ELITES]


def offsets(assign: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The place of each item in its bin, in item order, without gaps."""
    order = np.argsort(assign, kind="stable")
    ends = np.cumsum(sizes[order])
    starts = ends - sizes[order]
    firsts = np.flatnonzero(np.diff(assign[order], prepend=-1))
    base = np.repeat(starts[firsts], np.diff(np.append(firsts, len(order))))
    out = np.empty(len(order), np.int64)
    out[order] = starts - base
    return out


# --- all blocks ------------------------------------------------------------
def pack(found: DataFrame, capacity=1024, seed=0) -> DataFrame:
    """Adds sequence_id and offset to pieces (see ``pieces``); one row each.

    Pieces of full length are sequences of their own. No sequence holds more than
    ``capacity`` ids and offsets have no gaps. Repeated rows are separate pieces.
    An empty table gives no rows. Runs over the same pieces in the same order agree.

    Blocks are dealt by a hash of the row's number, so no key can make one block
    large. Each dealing is a job over what the one before left: at most the share
    ``_SHRINK`` of it, or half once blocks are searched. Every table goes the same
    way: best fit until it leaves more than that share, then the search until one
    block holds what is left.
    """
    rows = stage(found, "pieces").withColumn("row", F.monotonically_increasing_id())
    full = rows.where(F.col("length") == capacity).withColumns(
        {"sequence_id": -1 - F.col("row"), "offset": F.lit(0).cast("long")}
    )
    rest, level = rows.where(F.col("length") < capacity), 0
    n, done, search = rest.count(), [full], False
    while n and not (search and n <= _BLOCK):
        solve = _search if search else _fill_blocks
        packed = stage(solve(_deal(rest, n, seed, level), n, capacity, seed, level), f"packed-{level}")
        done.append(packed.where("stays").drop("stays"))
        left = packed.where("not stays")
        before, n, level = n, left.count(), level + 1
        rest = left.select(*rows.columns)
        search = search or n > _SHRINK * before
    done.append(_search(_deal(rest, n, seed, level), n, capacity, seed, level).drop("stays"))
    return reduce(DataFrame.unionByName, done).drop("row")


def _blocks(n: int) -> int:
    return -(-n // _BLOCK) or 1


def _deal(rest: DataFrame, n: int, seed: int, level: int) -> DataFrame:
    return rest.withColumn("block", F.pmod(F.xxhash64("row", F.lit(seed), F.lit(level)), F.lit(_blocks(n))))


def _sequence_id(level: int, block, bins):
    return block * _BINS + bins + level * _LEVEL


def better_half(packing: Packing) -> np.ndarray:
    """Of each item, whether its bin is one of the fullest, which hold at least half of the items."""
    order = np.argsort(-packing.fills, kind="stable")
    counts = np.bincount(packing.assign, minlength=packing.bins)[order]
    stays = np.zeros(packing.bins, bool)
    stays[order] = (np.cumsum(counts) - counts) * 2 < counts.sum()
    return stays[packing.assign]


def _fill_blocks(dealt: DataFrame, n: int, capacity: int, seed: int, level: int) -> DataFrame:
    """A best fit of each block; the pieces of sequences without a gap stay.

    A task reads its blocks one after another and holds one of them.
    """

    def fill(table: pa.Table) -> pa.RecordBatch:
        sizes = table.column("length").to_numpy()
        best = pack_in_order(sizes, np.argsort(-sizes, kind="stable").tolist(), capacity)
        block = table.column("block").to_numpy()
        new = {
            "sequence_id": _sequence_id(level, block, best.assign.astype(np.int64)),
            "offset": offsets(best.assign, sizes),
            "stays": best.fills[best.assign] == capacity,
        }
        for name, values in new.items():
            table = table.append_column(name, pa.array(values))
        return table.drop_columns("block").combine_chunks().to_batches()[0]

    def run(batches):
        held = []
        for batch in batches:
            block = batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for a, b in zip(cuts, cuts[1:]):
                if held and a < b and held[0].column("block")[0].as_py() != block[a]:
                    yield fill(pa.Table.from_batches(held))
                    held = []
                if a < b:
                    held.append(batch.slice(a, b - a))
        if held:
            yield fill(pa.Table.from_batches(held))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema if f.name != "block")
    return (
        dealt.repartition("block")
        .sortWithinPartitions("block", "row")
        .mapInArrow(run, f"{kinds}, sequence_id long, offset long, stays boolean")
    )


def _search(dealt: DataFrame, n: int, capacity: int, seed: int, level: int) -> DataFrame:
    """The genetic search on every block: epochs on islands, with migration between them.
    The pieces of the better-filled sequences stay."""
    spark = dealt.sparkSession
    item = F.struct("row", "doc_id", "piece", "start", "length", "ids_crc32")
    blocks = stage(dealt.groupBy("block").agg(F.sort_array(F.collect_list(item)).alias("items")), "blocks")
    sizes = blocks.select("block", F.col("items.length").alias("sizes"))
    state = sizes.withColumn("islands", F.array().cast(f"array<struct<island: int, elites: {_PACKINGS}>>"))

    def epoch(number):
        def run(batches):
            for batch in batches:
                out = []
                for block, island, lengths, islands in zip(*(c.to_pylist() for c in batch.columns)):
                    # An island starts with its own elites and its neighbour's best.
                    by_island = {x["island"]: x["elites"] for x in islands}
                    start = [e["assign"] for e in by_island.get(island, [])]
                    start += [e["assign"] for e in by_island.get((island - 1) % _ISLANDS, [])[:1]]
                    rng = random.Random(f"{seed}/{block}/{island}/{number}")
                    best = evolve(np.asarray(lengths, np.int64), start, capacity, rng)
                    out.append((block, island, [{"bins": p.bins, "fill": p.fill, "assign": p.assign} for p in best]))
                kind = pa.list_(
                    pa.struct([("bins", pa.int32()), ("fill", pa.float64()), ("assign", pa.list_(pa.int32()))])
                )
                block, island, elites = zip(*out) if out else ([], [], [])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block, pa.int64()), pa.array(island, pa.int32()), pa.array(elites, kind)],
                    ["block", "island", "elites"],
                )

        return run

    # The work is in the search, not in bytes, so the number of tasks is given.
    n_tasks = min(-(-_blocks(n) * _ISLANDS // 4), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    for number in range(_EPOCHS):
        evolved = (
            state.select("block", F.explode(F.lit([*range(_ISLANDS)])).alias("island"), "sizes", "islands")
            .repartition(n_tasks, "block", "island")
            .mapInArrow(epoch(number), f"block long, island int, elites {_PACKINGS}")
        )
        # Migration: the islands of a block meet; at most _ISLANDS rows a block.
        met = evolved.groupBy("block").agg(F.collect_list(F.struct("island", "elites")).alias("islands"))
        state = sizes.join(met, "block")

    def finish(batches):
        for batch in batches:
            out = []
            for block, lengths, islands in zip(*(c.to_pylist() for c in batch.columns)):
                best = min(
                    (e for x in sorted(islands, key=lambda x: x["island"]) for e in x["elites"]),
                    key=lambda e: (e["bins"], -e["fill"]),
                )
                best = Packing(np.asarray(best["assign"], np.int32), np.asarray(lengths, np.int64), capacity)
                out.append((block, best.assign, offsets(best.assign, np.asarray(lengths)), better_half(best)))
            block, assign, places, stays = zip(*out) if out else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block, pa.int64()),
                    pa.array(assign, pa.list_(pa.int32())),
                    pa.array(places, pa.list_(pa.int64())),
                    pa.array(stays, pa.list_(pa.bool_())),
                ],
                ["block", "bins", "places", "stays"],
            )

    solved = state.select("block", "sizes", "islands").mapInArrow(
        finish, "block long, bins array<int>, places array<long>, stays array<boolean>"
    )
    return (
        blocks.join(solved, "block")
        .select("block", F.inline(F.arrays_zip("items", "bins", "places", "stays")))
        .select(
            "items.*",
            _sequence_id(level, F.col("block"), F.col("bins")).alias("sequence_id"),
            F.col("places").alias("offset"),
            "stays",
        )
    )
