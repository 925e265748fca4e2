"""Joining documents whose sets of word n-grams have a high Jaccard similarity.

1. Every whole text becomes its set of n-grams, as 64-bit hashes. Texts with equal
   sets are one set from then on.
2. Two sets at or above the threshold differ in few elements. Cut into more parts
   (by a hash of the element) than that number, they agree in one part at least.
   Sets of about one length use the same number of parts; each meets the sets of
   its own length class and of the next. Sets that agree in a part are candidates
   and are gathered, by connected components, into neighbourhoods. Large ones,
   which common passages chain together, are gathered anew by rare elements.
3. In a neighbourhood the sets, in one order of their elements, are stored in a
   prefix tree. A traversal for one set shares the overlap of each path among all
   sets below it, and leaves a subtree when the lengths that remain rule it out.
   Links found there make the classes. A neighbourhood of any size is cut into
   blocks, and each pair of blocks is joined in a task of its own.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from snapledger.llm.components import components
from snapledger.session import stage

_BLOCK_ELEMENTS = 20_000
_FLUSH = 2_000_000  # part hashes held by a task before it hands them on
_KEEP_WORDS = 60_000

_WORDS: dict[bytes, int] = {}
_MIX = np.uint64(0x9E3779B97F4A7C15)


# --- sets ------------------------------------------------------------------
def _word_hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def _scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers without structure (the finishing steps of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of a whole text.

    Words are runs of bytes other than space and tab to carriage return, with A-Z
    in lower case. A text with fewer words is one n-gram; without words it has none.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    for word in set(words).difference(_WORDS):
        _WORDS[word] = _word_hash(word)
    codes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    if len(_WORDS) > _KEEP_WORDS:
        _WORDS.clear()
    n = max(1, len(words) - size + 1)
    hashes = np.full(n, min(size, len(words)), np.uint64)
    for i in range(min(size, len(words))):
        hashes = _scramble(hashes * _MIX + codes[i : i + n])
    return np.unique(hashes)


# --- candidates ------------------------------------------------------------
_PARTS_FROM = 128  # shorter sets are found by pairs of elements
_PART_ELEMENTS = 3  # parts of fewer are too common to tell anything


def _class_bounds(percent: int) -> np.ndarray:
    """First length of each class of lengths: within a class, and not much beyond, sets can link."""
    bounds, last = [1], _PARTS_FROM
    while last < 1 << 40:
        bounds.append(last)
        last = max(last + 1, -(-last * 100 // percent))
    return np.array(bounds, np.int64)


def _most_apart(longest: int, percent: int) -> int:
    """The most elements in which two linked sets, neither longer than ``longest``, can differ.

    100 i >= p (a + b - i) gives a + b - 2 i <= (a + b) (100 - p) / (100 + p).
    """
    return 2 * longest * (100 - percent) // (100 + percent)


def part_hashes(elements: np.ndarray, percent: int, bounds: np.ndarray) -> np.ndarray:
    """Two linked sets have a hash in common.

    Sets of a class share a way of being cut into parts, five more than linked
    sets can have differences, so they agree in five parts at least, and mostly in
    a third of all. A set is cut in the way of its class, and in that of the next
    for longer partners. Parts of one or two elements are left out, since many
    unrelated sets share those. For a link to be missed, all parts without a
    difference must be so small: below one in 10^7 for sets of 128 elements that
    barely link, and far lower for longer or closer ones.

    Sets below the first class are found without that: by order of hash, linked
    ones share two of the first elements that are not needed to reach the
    threshold, plus two. All pairs of those are emitted; and the single elements
    of sets so short that one shared element may be enough.
    """
    n = len(elements)
    own = int(np.searchsorted(bounds, n, "right")) - 1
    found = []
    if own == 0:
        needed = -(-percent * n // 100)
        first = elements[: n - needed + 2]
        i, j = np.triu_indices(len(first), 1)
        found.append(_scramble(_scramble(first[i]) + first[j] * _MIX))
        if needed < 2:
            found.append(elements)
    for scheme in (own, own + 1):
        # A set of the next class is at most 100/percent as long.
        if scheme == 0 or (scheme > own and 100 * n < percent * int(bounds[scheme])):
            continue
        parts = np.uint64(_most_apart(int(bounds[scheme + 1]) - 1, percent) + 5)
        part = (_scramble(elements ^ np.uint64(scheme)) % parts).astype(np.int64)
        order = np.argsort(part, kind="stable")
        firsts = np.flatnonzero(np.diff(part[order], prepend=-1))
        sums = np.add.reduceat(_scramble(elements + _MIX)[order], firsts)
        names = part[order][firsts].astype(np.uint64) * _MIX + np.uint64(scheme)
        full = np.diff(np.append(firsts, n)) >= _PART_ELEMENTS
        found.append(_scramble(sums ^ _scramble(names))[full])
    return np.concatenate(found) if found else elements[:0]


class _Parts:
    """What a task has found: each hash with its least document, and the links to that one."""

    def __init__(self):
        self.hashes, self.ids, self.held = [], [], 0

    def add(self, document: int, hashes: np.ndarray) -> bool:
        self.hashes.append(hashes)
        self.ids.append(np.full(len(hashes), document, np.int64))
        self.held += len(hashes)
        return self.held >= _FLUSH

    def take(self) -> pa.RecordBatch:
        """Rows (part, id, other): a part's least document, or a link that is settled here."""
        hashes = np.concatenate([np.zeros(0, np.uint64), *self.hashes])
        ids = np.concatenate([np.zeros(0, np.int64), *self.ids])
        self.__init__()
        order = np.lexsort((ids, hashes))
        hashes, ids = hashes[order], ids[order]
        first = np.ones(len(hashes), bool)
        first[1:] = hashes[1:] != hashes[:-1]
        least = ids[np.flatnonzero(first)[np.cumsum(first) - 1]] if len(ids) else ids
        pairs = np.unique(np.stack([ids[~first], least[~first]], 1), axis=0)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        # A settled link has a part of its own.
        alone = _scramble(_scramble(pairs[:, 0].astype(np.uint64)) + pairs[:, 1].astype(np.uint64))
        part = np.concatenate([hashes[first], alone]).astype(np.int64)
        other = pa.array(
            np.concatenate([ids[first], pairs[:, 1]]),
            mask=np.concatenate([np.ones(first.sum(), bool), np.zeros(len(pairs), bool)]),
        )
        return pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(np.concatenate([ids[first], pairs[:, 0]])), other], ["part", "id", "other"]
        )


def _digest(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n, digest of the set (null for the empty set); a row per row of ``docs`` (doc_id, text)."""

    def run(batches):
        for batch in batches:
            n, digests = [], []
            for text in batch.column("text").to_pylist():
                elements = shingle_set(text, size)
                n.append(len(elements))
                digests.append(_digest(elements) if len(elements) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digests, pa.binary())],
                ["doc_id", "n", "digest"],
            )

    return docs.mapInArrow(run, "doc_id long, n long, digest binary")


def candidate_links(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """a, b: documents that agree in a part, each linked to the least of the part; no link is stated twice.

    Each task keeps one row per part, so a part that very many documents share
    comes to one row per task before anything is shuffled.
    """

    def run(batches):
        bounds, parts, seen = _class_bounds(percent), _Parts(), set()
        for batch in batches:
            for document, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                elements = shingle_set(text, size)
                if document is None or not len(elements):
                    continue
                digest = _digest(elements)
                if digest in seen:  # its set is known, and equal sets are one later
                    continue
                seen.add(digest)
                if parts.add(document, part_hashes(elements, percent, bounds)):
                    yield parts.take()
        yield parts.take()

    found = docs.mapInArrow(run, "part long, id long, other long")
    by_id = Window.partitionBy("part").orderBy("id")
    linked = found.withColumn("first", F.first("id").over(by_id))
    return (
        linked.select(F.col("id").alias("a"), F.coalesce("other", "first").alias("b")).where("a <> b").distinct()
    )


# --- the prefix tree -------------------------------------------------------
class _Node:
    """A run of elements on the path from the root, and the sets that end after it."""

    __slots__ = ("children", "depth", "elements", "ends", "last", "longest", "shortest")

    def __init__(self, elements: list, depth: int):
        self.elements, self.depth, self.children, self.ends = elements, depth, [], []


class PrefixTree:
    """Sets as sorted lists of ranks; common beginnings are stored once."""

    def __init__(self, sets: list[list[int]]):
        self.root = _Node([], 0)
        path, previous = [self.root], []
        for i in sorted(range(len(sets)), key=sets.__getitem__):
            ranks = sets[i]
            common = 0
            for x, y in zip(previous, ranks):
                if x != y:
                    break
                common += 1
            below = None
            while path[-1].depth > common:
                below = path.pop()
            top = path[-1]
            if top.depth < common:  # the run below divides
                cut = common - top.depth
                middle = _Node(below.elements[:cut], common)
                middle.children.append(below)
                below.elements = below.elements[cut:]
                top.children[-1] = middle
                path.append(middle)
                top = middle
            if len(ranks) > common:
                leaf = _Node(ranks[common:], len(ranks))
                top.children.append(leaf)
                path.append(leaf)
                top = leaf
            top.ends.append(i)
            previous = ranks
        self._measure()

    def _measure(self):
        order, stack = [], [self.root]
        while stack:
            node = stack.pop()
            order.append(node)
            stack += node.children
        for node in reversed(order):
            lengths = [node.depth] if node.ends else []
            node.shortest = min(lengths + [c.shortest for c in node.children], default=0)
            node.longest = max(lengths + [c.longest for c in node.children], default=0)
            node.last = node.elements[-1] if node.elements else -1
            node.elements = frozenset(node.elements)

    def search(self, ranks: list[int], percent: int):
        """The stored sets whose Jaccard similarity to ``ranks`` is at least ``percent`` / 100."""
        n, own = len(ranks), frozenset(ranks)
        stack = [(self.root, 0)]
        while stack:
            node, overlap = stack.pop()
            overlap += len(own & node.elements)
            # What either side still has bounds what they can still share.
            left = min(n - bisect_right(ranks, node.last), node.longest - node.depth)
            if (100 + percent) * (overlap + left) < percent * (n + node.shortest):
                continue
            if node.ends and (100 + percent) * overlap >= percent * (n + node.depth):
                yield from node.ends
            for child in node.children:
                if percent * child.shortest <= 100 * n and 100 * child.longest >= percent * n:
                    stack.append((child, overlap))


def _join(size: int, percent: int):
    """Links among the documents of one group, as a spanning forest.

    Rows: node, text, side. With two sides, only links between them are sought.
    Documents that are known to be in one class (``known``) need no link.
    """

    def run(table: pa.Table) -> pa.Table:
        nodes, sides = table.column("node").to_pylist(), table.column("side").to_pylist()
        sets = [shingle_set(text, size) for text in table.column("text").to_pylist()]
        # One order for the group: elements of many sets first, which makes common paths long.
        elements, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        rank = np.empty(len(elements), np.int64)
        rank[np.lexsort((elements, -count))] = np.arange(len(elements))
        cuts = np.cumsum([len(s) for s in sets])[:-1]
        ranks = [np.sort(r).tolist() for r in np.split(rank[place], cuts)]
        parent = {}

        def root(x):
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        def joined(x, y):
            x, y = root(x), root(y)
            parent[max(x, y)] = min(x, y)
            return x != y

        for node, known in zip(nodes, table.column("known").to_pylist()):
            joined(node, known)
        stored = [i for i, side in enumerate(sides) if side == min(sides)]
        asked = stored if len(stored) == len(sides) else [i for i, side in enumerate(sides) if side != min(sides)]
        tree = PrefixTree([ranks[i] for i in stored])
        links = []
        for i in asked:
            for j in tree.search(ranks[i], percent):
                a, b = nodes[i], nodes[stored[j]]
                if a != b and joined(a, b):
                    links.append((a, b))
        a, b = zip(*links) if links else ([], [])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _with_blocks(near: DataFrame) -> DataFrame:
    """Adds the number of blocks of each neighbourhood, by the elements of all its sets."""
    blocks = near.groupBy("nearby").agg(F.ceil(F.sum("n") / _BLOCK_ELEMENTS).alias("blocks"))
    return stage(near.join(stage(blocks, "nearby-blocks"), "nearby"), "nearby-nodes")


def rare_links(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """a, b: documents (node, text) that share one of their rarest elements, each linked to the least that has it.

    In order of how many of these documents have an element, linked sets share
    one of the first that are not needed to reach the threshold, plus one. Common
    passages come last in that order, and what no other document has comes first,
    so unrelated documents are rarely linked.
    """

    def run(batches):
        for batch in batches:
            found = [shingle_set(t, size).astype(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(found, pa.list_(pa.int64()))], ["node", "elements"]
            )

    sets = docs.mapInArrow(run, "node long, elements array<long>")
    spread = stage(
        sets.select("node", F.size("elements").alias("n"), F.explode("elements").alias("element")), "elements"
    )
    holders = spread.groupBy("element").agg(F.count("*").alias("holders")).where("holders > 1")
    shared = spread.join(stage(holders, "holders"), "element")
    own = Window.partitionBy("node")
    # Elements that one document has come first and need no rows.
    place = F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("holders", "element"))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    # An element of n sets is dealt to about sqrt(n) parts; the first of each part
    # then meet, so no task holds more than about sqrt(n) of its rows at a time.
    parts = F.ceil(F.sqrt("holders") / 8)
    in_part = Window.partitionBy("element", "part").orderBy("node")
    linked = stage(
        shared.withColumn("place", place)
        .where(F.col("place") <= prefix)
        .withColumns({"parts": parts, "part": F.pmod(F.xxhash64("node"), parts)})
        .withColumn("first", F.first("node").over(in_part))
        .select("element", "parts", "node", "first"),
        "rare-elements",
    )
    heads = linked.where("parts > 1 and node = first")
    least = F.first("node").over(Window.partitionBy("element").orderBy("node"))
    links = linked.select(F.col("node").alias("a"), F.col("first").alias("b"))
    links = links.unionByName(heads.select(F.col("node").alias("a"), least.alias("b")))
    return links.where("a <> b").distinct()


# --- the operator ----------------------------------------------------------
def similar_documents(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col="doc_id", text_col="text"
) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of ``docs``.

    Two documents link when the Jaccard similarity of their sets of ``size``-word
    n-grams is at least ``percent`` / 100; ``component_id`` is the least id
    reachable by links. Texts with fewer words are one n-gram; null texts, empty
    texts and texts without words have the empty set and link with nothing. Ids
    are integers; rows that repeat an id are one document with several sets; rows
    with a null id link with nothing and have a null component. An empty table
    gives no rows; other columns are ignored.

    Elements are 64-bit hashes; two different n-grams of a pair fall together with
    a chance of about (their number)^2 / 2^65.
    """
    if not 0 < percent <= 100 or size < 1:
        raise ValueError("percent must be in (0, 100], size at least 1")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sets = stage(shingle_sets(texts, size), "shingle-sets")
    kept = sets.where("doc_id is not null and digest is not null")
    reps = stage(kept.groupBy("digest").agg(F.min("doc_id").alias("rep")), "set-reps")
    # Equal sets are one: their documents' links are those of the least.
    members = stage(kept.join(reps, "digest").select("doc_id", "n", "rep"), "set-members")

    found = stage(candidate_links(texts, size, percent), "candidates")
    moved = members.select("doc_id", "rep")
    links = (
        found.join(moved.select(F.col("doc_id").alias("a"), F.col("rep").alias("u")), "a")
        .join(moved.select(F.col("doc_id").alias("b"), F.col("rep").alias("v")), "b")
        .select("u", "v")
    )
    near = components(links, "u", "v").withColumnRenamed("component", "nearby")
    lengths = members.where("doc_id = rep").groupBy(F.col("rep").alias("node")).agg(F.max("n").alias("n"))
    near = stage(near.join(lengths, "node"), "nearby")
    near = _with_blocks(near)
    # The list of nodes grows with the documents: a shuffle at every size, no broadcast.
    wanted = near.select("nearby", "node", "n", "blocks").hint("merge")
    gathered = stage(texts.join(wanted, F.col("doc_id") == F.col("node")).drop("doc_id"), "nearby-texts")
    # Neighbourhoods of several blocks are mostly chains through common passages.
    chained = gathered.where("blocks > 1")
    closer = rare_links(chained.select("node", "text"), size, percent)
    closer = components(closer, "a", "b").withColumnRenamed("component", "nearby")
    closer = _with_blocks(stage(closer.join(lengths, "node"), "closer"))
    again = chained.select("node", "n", "text").join(closer.select("nearby", "node", "blocks"), "node")
    gathered = gathered.where("blocks = 1").unionByName(stage(again, "closer-texts"))
    near = near.where("blocks = 1").unionByName(closer)

    # First inside blocks, dealt in two ways: that settles the neighbourhoods of one
    # block, and most of the large ones whose documents are all alike.
    at = lambda n: F.pmod(F.xxhash64("node", F.lit(n)), F.col("blocks"))
    dealt = F.when(F.col("blocks") > 1, F.array(at(0), F.col("blocks") + at(1))).otherwise(F.array(at(0)))
    inside = (
        gathered.withColumn("p", F.explode(dealt))
        .select("nearby", "p", "node", "text", F.lit(0).alias("side"), F.col("node").alias("known"))
        .groupBy("nearby", "p")
        .applyInArrow(_join(size, percent), "a long, b long")
    )
    inside = stage(inside, "links-inside")

    # Then between blocks, where more than one class is left.
    large = near.where("blocks > 1")
    classes = components(inside, "a", "b")
    known = large.join(classes, "node", "left").withColumn("known", F.coalesce("component", "node"))
    known = stage(known.select("nearby", "node", "known"), "known")
    open_ones = known.groupBy("nearby").agg(F.min("known").alias("x"), F.max("known").alias("y")).where("x <> y")
    home = at(0)
    pairs = F.transform(
        F.filter(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda q: q != home),
        lambda q: F.struct(
            F.least(home, q).alias("p"), F.greatest(home, q).alias("q"), (home > q).cast("int").alias("side")
        ),
    )
    across = (
        gathered.where("blocks > 1")
        .join(stage(known.join(open_ones.select("nearby"), "nearby").select("node", "known"), "open-nodes"), "node")
        .withColumn("pair", F.explode(pairs))
        .select("nearby", "pair.*", "node", "text", "known")
        .groupBy("nearby", "p", "q")
        .applyInArrow(_join(size, percent), "a long, b long")
    )
    classes = components(inside.unionByName(stage(across, "links-across")), "a", "b")
    classes = stage(classes, "classes")
    # By the digest again, as rows that repeat an id may have other sets.
    named = sets.join(reps, "digest", "left").join(classes, F.col("rep") == F.col("node"), "left")
    return named.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id")
    )


def one_of_each_group(docs: DataFrame, size: int = 5, percent: int = 80, id_col="doc_id", text_col="text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``similar_documents`` leaves one of each class.

    That is the least id of a class, and one row of it where rows repeat the id
    (any of them, if they differ). Rows with a null id are in no class; all stay.
    """
    classes = similar_documents(docs, size, percent, id_col, text_col)
    kept = stage(
        classes.where("doc_id = component_id").select(F.col("doc_id").alias("_kept_id")).distinct(), "kept-ids"
    )
    named = docs.withColumn("_kept_id", F.col(id_col).cast("long"))
    stay = named.where("_kept_id is not null").join(kept, "_kept_id", "left_semi").dropDuplicates(["_kept_id"])
    return stay.select(*docs.columns).unionByName(docs.where(F.col(id_col).isNull()))
