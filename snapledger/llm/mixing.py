"""Mixing sources to target weights through a multivariate-hypergeometric splitting tree.

Sources share the mix by weight; none gives more than a stated number of passes.
Each source's documents are dealt by hash into blocks and the blocks put in a
random order. What a source owes is so many whole passes plus the first blocks of
that order, the last of them in part, which makes its exact block quota. A binary
tree over the output shards splits the quotas: at each node the left half draws
its blocks without replacement from all that are there. Each shard then takes the
next blocks of every source's order, so shares are disjoint, and shuffles them.

Everything is random by hashes of a seed: runs over the same rows agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from snapledger.llm.rows import row_key
from snapledger.session import stage

# Fixed value: the characters that separate words, as in the pattern [^\x20\x09-\x0D]+.
SEPARATORS = " \t\n\x0b\f\r"

_BLOCK_ROWS = 256  # rows of a block, on average
# Shards draw runs of blocks, longer where there are more of them, since one row
# holds a draw. Which documents are taken does not depend on it.
_MOST_DRAWS = 1 << 20
_RANGE_BITS = 12


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ``SEPARATORS``; null has none."""
    marked = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x")
    return F.coalesce(F.length(F.translate(marked, SEPARATORS, "")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: list[float], share: float, most_passes: float) -> DataFrame:
    """source, n, source_size, target, number: one row per source.

    Weights repeat over the sources in code point order, null last. The targets
    share ``share`` times all sizes by weight, but for the sources whose part
    would be over ``most_passes`` times their size: those stop there and the
    others share what is left. In order of size by weight the sources that stop
    come first, so the level of the others is found in one pass.
    """
    totals = sized.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    # One row per source meets in one task here.
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    number = F.row_number().over(in_order)
    weighted = totals.withColumn("number", number).withColumns(
        {
            "weight": F.element_at(
                F.array(*map(F.lit, weights)), (F.pmod(F.col("number") - 1, F.lit(len(weights))) + 1).cast("int")
            ).cast("double"),
            "most": F.col("source_size") * F.lit(float(most_passes)),
        }
    )
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), "number")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    levels = weighted.withColumn("level", left / F.sum("weight").over(onward)).withColumn(
        "rank", F.row_number().over(by_ratio)
    )
    reached = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("rank"))
    level = F.min(F.struct(F.coalesce(reached, F.lit(1 << 30)).alias("r"), "level")).over(whole)["level"]
    return levels.withColumn("target", F.least("most", F.col("weight") * level)).select(
        "source", "n", "source_size", "target", "number"
    )


def _uniform(*parts) -> Column:
    """In [0, 1), from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def _draw_left(quotas: Column, total: Column, slots: Column, seed: int, node: Column) -> Column:
    """How many blocks of each source the left child gets: a multivariate-hypergeometric draw.

    Blocks are gone through one by one; each goes left with the probability of
    slots left over blocks left, so exactly ``slots`` of them do.
    """

    def source(state, quota):
        n = quota["blocks"]
        each = F.when(n > 0, F.sequence(F.lit(1).cast("long"), n)).otherwise(F.array().cast("array<long>"))
        start = F.struct(
            state["slots"].alias("slots"), state["blocks"].alias("blocks"), F.lit(0).cast("long").alias("got")
        )

        def block(s, k):
            goes = (
                _uniform(F.lit(seed), node, quota["number"], k) * s["blocks"] < s["slots"]
            ).cast("long")
            return F.struct(
                (s["slots"] - goes).alias("slots"), (s["blocks"] - 1).alias("blocks"), (s["got"] + goes).alias("got")
            )

        after = F.aggregate(each, start, block)
        return F.struct(
            after["slots"].alias("slots"),
            after["blocks"].alias("blocks"),
            F.concat(
                state["drawn"], F.array(F.struct(quota["number"].alias("number"), after["got"].alias("blocks")))
            ).alias("drawn"),
        )

    zero = F.struct(
        slots.cast("long").alias("slots"),
        total.cast("long").alias("blocks"),
        F.array().cast("array<struct<number:int,blocks:bigint>>").alias("drawn"),
    )
    return F.aggregate(quotas, zero, source)["drawn"]


def split_quotas(quotas: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """number, shard, blocks: each source's block quota split exactly among the shards.

    Shards get equal numbers of blocks, to one. One row holds the quotas of all
    sources at a node; a level of the tree is one projection.
    """
    nodes = quotas.agg(
        F.sort_array(F.collect_list(F.struct("number", "blocks"))).alias("quotas"),
        F.coalesce(F.sum("blocks"), F.lit(0)).alias("all"),
    ).withColumns({"low": F.lit(0), "high": F.lit(n_shards), "total": F.col("all")})
    places = lambda shard: F.floor(shard * F.col("all") / n_shards)
    for _ in range((n_shards - 1).bit_length()):
        middle = F.floor((F.col("low") + F.col("high") + 1) / 2).cast("int")
        node = F.struct("low", "high")
        slots = (places(F.col("middle")) - places(F.col("low"))).cast("long")
        drawn = _draw_left("quotas", F.col("total"), F.col("slots"), seed, node)
        rest = F.zip_with(
            "quotas",
            "left",
            lambda a, b: F.struct(a["number"].alias("number"), (a["blocks"] - b["blocks"]).alias("blocks")),
        )
        children = F.array(
            F.struct(F.col("left").alias("quotas"), "all", "low", F.col("middle").alias("high"), F.col("slots").alias("total")),
            F.struct(
                rest.alias("quotas"), "all", F.col("middle").alias("low"), "high",
                (F.col("total") - F.col("slots")).alias("total"),
            ),
        )
        nodes = (
            nodes.withColumn("middle", middle)
            .withColumn("slots", slots)
            .withColumn("left", drawn)
            .select(F.inline(F.filter(children, lambda c: c["low"] < c["high"])))
        )
    return nodes.select(F.col("low").alias("shard"), F.inline("quotas")).select("number", "shard", "blocks")


def in_random_order(blocks: DataFrame, seed: int) -> DataFrame:
    """``blocks`` (number, block, words) with ``rank`` (from 0) and ``words_before`` in each source's order.

    The order is that of a hash. It is cut into equal ranges of the hash, and only
    the totals of a source's ranges meet in one task.
    """
    hashed = stage(
        blocks.withColumn("hash", F.xxhash64(F.lit(seed), "number", "block")).withColumn(
            "range", F.shiftright("hash", 64 - _RANGE_BITS)
        ),
        "mix-hashed",
    )
    ranges = Window.partitionBy("number").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        hashed.groupBy("number", "range")
        .agg(F.count("*").alias("n"), F.sum("words").alias("w"))
        .select(
            "number", "range",
            F.coalesce(F.sum("n").over(ranges), F.lit(0)).alias("n_start"),
            F.coalesce(F.sum("w").over(ranges), F.lit(0)).alias("w_start"),
        )
    )
    order = Window.partitionBy("number", "range").orderBy("hash", "block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return (
        hashed.join(starts, ["number", "range"])
        .withColumn("rank", F.col("n_start") + F.row_number().over(order) - 1)
        .withColumn("words_before", F.col("w_start") + F.coalesce(F.sum("words").over(before), F.lit(0)))
        .select("number", "block", "words", "rank", "words_before")
    )


def plan_mix(
    docs: DataFrame,
    weights: list[float],
    share: float,
    most_passes: float,
    n_shards: int = 8,
    seed: int = 0,
    id_col="doc_id",
    text_col="text",
    source_col="source",
) -> DataFrame:
    """doc_id, row_hash, size, source_size, target, copies, shards (one per copy); a row per row of ``docs``.

    ``size`` is the number of words, 0 for a null or empty text. A null source is
    a source of its own, last in order. Each source takes its target to the
    nearest whole document it can; no document is taken more often than
    ``most_passes`` rounded up. Rows equal in all three columns have equal
    hashes and are taken alike. Sources without words have target 0. An empty
    table gives no rows. Other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text")
    )
    sized = stage(
        rows.select("doc_id", "source", word_count(F.col("text")).alias("size"), row_hash("doc_id", "source", "text", seed)),
        "mix-sizes",
    )
    targets = source_targets(sized, weights, share, most_passes)
    # A pass is all of a source's words; what is over is taken block by block.
    wanted = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(0).cast("int")
    sources = targets.withColumn("passes", passes).withColumn("owed", wanted - F.col("passes") * F.col("source_size"))
    sources = stage(sources.withColumn("n_blocks", F.ceil(F.col("n") / _BLOCK_ROWS).cast("long")), "mix-sources")

    numbered = sized.alias("d").join(
        sources.select("source", "number", "n_blocks").alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))
    ).select("d.*", "number", F.pmod(F.xxhash64("row_hash", F.lit("block")), F.col("n_blocks")).alias("block"))
    numbered = stage(numbered, "mix-rows")

    sized_blocks = numbered.groupBy("number", "block").agg(F.sum("size").alias("words"))
    blocks = (
        in_random_order(sized_blocks, seed)
        .join(sources.select("number", "passes", "owed"), "number")
        .withColumn("room", F.col("owed") - F.col("words_before"))
        .withColumn("whole", (F.col("room") > 0) & (F.col("words") <= F.col("room")))
        .withColumn("part", (F.col("room") > 0) & (F.col("words") > F.col("room")))
    )
    blocks = stage(blocks, "mix-blocks")

    # One block a source is taken in part: its largest documents first, as they fit.
    units = (
        numbered.join(blocks.where("part").select("number", "block", "room"), ["number", "block"])
        .groupBy("number", "block", "row_hash", "room")
        .agg(F.sum("size").alias("words"))
    )
    held = units.groupBy("number", "block", "room").agg(
        F.sort_array(F.collect_list(F.struct("words", "row_hash")), asc=False).alias("units")
    )
    empty = F.struct(
        F.col("room").alias("room"), F.array().cast("array<string>").alias("taken"), F.lit(None).cast("string").alias("next"),
        F.lit(None).cast("bigint").alias("next_words"),
    )

    def take(state, unit):
        fits = unit["words"] <= state["room"]
        return F.struct(
            F.when(fits, state["room"] - unit["words"]).otherwise(state["room"]).alias("room"),
            F.when(fits, F.concat(state["taken"], F.array(unit["row_hash"]))).otherwise(state["taken"]).alias("taken"),
            F.when(fits, state["next"]).otherwise(unit["row_hash"]).alias("next"),
            F.when(fits, state["next_words"]).otherwise(unit["words"]).alias("next_words"),
        )

    end = F.aggregate("units", empty, take)
    # The smallest that did not fit comes too if that ends nearer to the target.
    nearer = F.col("end.next_words") < 2 * F.col("end.room")
    taken = F.when(nearer, F.concat("end.taken", F.array("end.next"))).otherwise(F.col("end.taken"))
    partly = stage(
        held.withColumn("end", end).select("number", "block", F.explode(taken).alias("row_hash")), "mix-part"
    )

    # Exact quotas of blocks, split among the shards; then each shard's run of every source's order.
    drawn = blocks.withColumn("times", F.col("passes") + (F.col("whole") | F.col("part")).cast("int"))
    whole_table = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    quotas = stage(
        drawn.groupBy("number")
        .agg(F.sum("times").cast("long").alias("blocks"))
        .withColumn("run", F.greatest(F.lit(1), F.ceil(F.sum("blocks").over(whole_table) / _MOST_DRAWS)).cast("long")),
        "mix-quotas",
    )
    split = split_quotas(
        quotas.select("number", F.ceil(F.col("blocks") / F.col("run")).cast("long").alias("blocks")), n_shards, seed
    )
    runs = Window.partitionBy("number").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shares = stage(
        split.withColumn("first", F.coalesce(F.sum("blocks").over(runs), F.lit(0))).where("blocks > 0"), "mix-shares"
    )
    per_source = shares.groupBy("number").agg(F.sort_array(F.collect_list(F.struct("first", "shard"))).alias("runs"))
    n_blocks = sources.select("number", "n_blocks")
    placed = (
        drawn.where("times > 0")
        .join(n_blocks, "number")
        .join(per_source, "number")
        .join(quotas.select("number", "run"), "number")
        .withColumn("places", F.transform(F.sequence(F.lit(0), F.col("times") - 1), lambda p: p * F.col("n_blocks") + F.col("rank")))
        .select(
            "number", "block", "part",
            F.transform(
                "places",
                lambda p: F.element_at(F.filter("runs", lambda r: r["first"] <= F.floor(p / F.col("run"))), -1)["shard"],
            ).alias("shards"),
        )
    )
    placed = stage(placed, "mix-places")

    some = partly.withColumn("some", F.lit(True))
    full = (
        numbered.join(placed, ["number", "block"], "left")
        .join(some, ["number", "block", "row_hash"], "left")
        .join(sources.select("number", "source_size", "target"), "number")
    )
    # Of a block taken in part, the last copy has the chosen documents only.
    cut = F.coalesce(F.col("part"), F.lit(False)) & F.col("some").isNull()
    shards = F.when(cut, F.slice("shards", 1, F.size("shards") - 1)).otherwise(F.col("shards"))
    shards = F.coalesce(shards, F.array().cast("array<int>"))
    return full.withColumn("shards", shards).select(
        "doc_id", "row_hash", "size", "source_size", "target", F.size("shards").alias("copies"), "shards"
    )


def row_hash(id_col: str, source_col: str, text_col: str, seed: int) -> Column:
    return row_key(F.col(id_col), F.col(source_col), F.col(text_col), seed=seed).alias("row_hash")


def mix_documents(
    docs: DataFrame,
    weights: list[float],
    share: float,
    most_passes: float,
    n_shards: int = 8,
    seed: int = 0,
    id_col="doc_id",
    text_col="text",
    source_col="source",
) -> DataFrame:
    """The mix itself: rows of ``docs`` with all their columns, once per copy, dealt to shards and shuffled there.

    See ``plan_mix``; documents that the mix leaves out are gone. One partition
    or more holds each shard's rows, in the order of a hash.
    """
    chosen = (
        plan_mix(docs, weights, share, most_passes, n_shards, seed, id_col, text_col, source_col)
        .where("copies > 0")
        .groupBy(F.col("row_hash").alias("_row_hash"))
        .agg(F.first("shards").alias("_shards"))
    )
    hashed = docs.withColumn("_row_hash", row_hash(id_col, source_col, text_col, seed))
    copies = hashed.join(stage(chosen, "mix-chosen"), "_row_hash").withColumn("_shard", F.explode("_shards"))
    local = F.xxhash64(F.col("_row_hash"), F.lit("order"), F.col("_shard"))
    return (
        copies.withColumn("_order", local)
        .repartition("_shard", F.pmod("_order", F.lit(64)))
        .sortWithinPartitions("_shard", "_order")
        .select(*docs.columns)
    )
