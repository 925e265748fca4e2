"""Dealing indivisible groups of documents to shards by best-fit-decreasing bin packing.

Equal texts form a group and stay together. Groups of one size are
interchangeable, so the packing works on the sizes and how often each occurs: it
is the packing of every single group, and what it holds at once grows with the
number of different sizes (at most the square root of twice all bytes), not with
the number of groups.
"""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from snapledger.llm.numbering import number_within
from snapledger.session import stage

_PART_ROWS = 4096


# --- the packing -----------------------------------------------------------
class _Node:
    __slots__ = ("key", "left", "priority", "right")

    def __init__(self, key, priority):
        self.key, self.priority, self.left, self.right = key, priority, None, None


class RoomTree:
    """Open shards as (room left, shard), in a tree kept balanced by random priorities."""

    def __init__(self):
        self.root, self.random = None, random.Random(0)

    def add(self, key: tuple[int, int]) -> None:
        low, high = self._split(self.root, key)
        self.root = self._merge(self._merge(low, _Node(key, self.random.random())), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the shard with the least room that is at least ``size``."""
        node, found = self.root, None
        while node:
            if node.key[0] >= size:
                node, found = node.left, node.key
            else:
                node = node.right
        if found:
            low, high = self._split(self.root, found)
            self.root = self._merge(low, self._split(high, (found[0], found[1] + 1))[1])
        return found

    def _split(self, node, key):
        """Nodes below ``key``, and the others."""
        if node is None:
            return None, None
        if node.key < key:
            node.right, high = self._split(node.right, key)
            return node, high
        low, node.left = self._split(node.left, key)
        return low, node

    def _merge(self, low, high):
        if not low or not high:
            return low or high
        if low.priority > high.priority:
            low.right = self._merge(low.right, high)
            return low
        high.left = self._merge(low, high.left)
        return high


def best_fit_decreasing(sizes: list[tuple[int, int]], capacity: int) -> tuple[list, int]:
    """Pack ``sizes`` (size, number of groups); returns runs (size, first, count, shard) and the shards.

    ``first`` counts the groups of a size that came before. The tightest shard
    stays the tightest while groups of the same size enter it, so a whole run of
    them enters at once. A group larger than ``capacity`` has a shard of its own.
    """
    tree, runs, shards = RoomTree(), [], 0
    for size, count in sorted(sizes, reverse=True):
        first = 0
        while first < count:
            found = tree.take_tightest(size)
            if found is None:
                found, shards = (max(capacity, size), shards), shards + 1
            room, shard = found
            n = min(count - first, room // size)
            runs.append((size, first, n, shard))
            tree.add((room - n * size, shard))
            first += n
    return runs, shards


def least_capacity(sizes: list[tuple[int, int]], n_shards: int) -> int:
    """The smallest capacity found by bisection with which ``n_shards`` shards are enough."""
    total = sum(size * n for size, n in sizes)
    low = max(-(-total // n_shards), max((size for size, _ in sizes), default=0))
    high = low
    while best_fit_decreasing(sizes, high)[1] > n_shards:
        low, high = high + 1, high + max(1, high // 64)
    while low < high:
        middle = (low + high) // 2
        if best_fit_decreasing(sizes, middle)[1] > n_shards:
            low = middle + 1
        else:
            high = middle
    return high


def even_shards(sizes: list[tuple[int, int]], n_shards: int) -> list:
    """Runs (size, first, count, shard) that fill ``n_shards`` shards as evenly as whole groups allow.

    Each group above the even share of what is left has a shard of its own, the
    largest first; the rest is packed at the least capacity for the other shards.
    """
    rest, total = sorted(sizes), sum(size * n for size, n in sizes)
    runs, used = [], 0
    # Fewer groups than shards can be above the even share, so some shards stay for the rest.
    while rest and rest[-1][0] * (n_shards - used) > total:
        size, n = rest.pop()
        runs += [(size, k, 1, used + k) for k in range(n)]
        used, total = used + n, total - n * size
    packed, _ = best_fit_decreasing(rest, least_capacity(rest, n_shards - used)) if rest else ([], 0)
    return runs + [(size, first, n, used + shard) for size, first, n, shard in packed]


# --- the operator ----------------------------------------------------------
def shard_documents(
    docs: DataFrame, n_shards: int | None = None, capacity: int | None = None, id_col="doc_id", text_col="text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot.

    With ``capacity`` (bytes), as few shards as best-fit decreasing needs; with
    ``n_shards``, so many of near equal sizes as far as groups allow: a group above
    the even share has a shard of its own, and the others share the rest evenly. ``size`` is the text's UTF-8 bytes
    plus 1; a null text counts as the empty text and is in its group. ``slot``
    numbers the rows of a shard from 0. Repeated rows are rows of their own, null
    ids are kept, an empty table gives no rows, other columns are ignored.
    """
    if (n_shards is None) == (capacity is None):
        raise ValueError("give either n_shards or capacity")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.sha2(text, 256).alias("content"),
        ),
        "shard-rows",
    )
    groups = stage(rows.groupBy("content").agg(F.sum("size").alias("group_size")), "shard-groups")
    sizes = groups.groupBy("group_size").agg(F.count("*").alias("n"))

    def pack(batches):
        held = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))]
        runs = even_shards(held, n_shards) if capacity is None else best_fit_decreasing(held, capacity)[0]
        columns = zip(*runs) if runs else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["group_size", "first", "count", "shard"]
        )

    runs = stage(
        sizes.repartition(1).mapInArrow(pack, "group_size long, first long, count long, shard long"),
        "shard-runs",
    )
    sized = stage(
        groups.join(sizes.select("group_size", F.ceil(F.col("n") / _PART_ROWS).alias("parts")), "group_size"),
        "shard-sizes",
    )
    numbered = number_within(sized, ["group_size"], ["content"], "place", F.col("parts"))
    within = (F.col("place") >= F.col("first")) & (F.col("place") < F.col("first") + F.col("count"))
    placed = stage(
        numbered.join(runs.withColumnRenamed("group_size", "of"), (F.col("group_size") == F.col("of")) & within)
        .select("content", F.col("shard").cast("int").alias("shard")),
        "shard-places",
    )
    sharded = stage(rows.join(placed, "content"), "sharded")
    parts = F.lit(-(-sharded.count() // (_PART_ROWS * (n_shards or 1))) or 1)
    slotted = number_within(sharded, ["shard"], ["doc_id", "content"], "slot", parts)
    return slotted.select("doc_id", "size", "text_crc32", "shard", "slot")
