"""SpotSigs document fingerprints: chains of content words that follow common words.

A text is lower-cased and reduced to words. A common word opens a spot, as does
the start of the text. The content words up to the next common word are cut into
consecutive chains of the chain length, the last one as long as words are left; a
signature is a chain led by its common word or the start mark. A text's
fingerprint is its set of signatures, hashed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Common words of the languages of the corpus.
COMMON_WORDS = {
    "en": "a an and are as at be but by for from has have he in is it its not of on or that the their they this to was were which will with you",
    "de": "als am auch auf aus bei das dem den der des die ein eine einem einen einer es für ich im ist mit nach nicht oder sich sie sind und von war wie wird zu zum zur",
    "fr": "au aux avec ce cette dans de des du elle en est et il ils je la le les leur mais ne nous ou par pas plus pour que qui sa se son sur un une vous",
    "es": "al como con del el ella en es esta este fue la las lo los más me mi no para pero por que se sin sobre son su sus un una y",
}
_CHAIN = 2  # content words in a signature


def signatures(text: Column, common_words: dict[str, str] = COMMON_WORDS, chain: int = _CHAIN) -> Column:
    """Sorted array of the 64-bit signature hashes of a whole text; a null text counts as empty.

    Every content word is in a chain. Texts without a signature, such as the empty
    text and those without words, have one of their exact characters, so that only
    equal ones are alike.
    """
    text = F.coalesce(text, F.lit(""))
    words = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    common = "|".join(sorted({w for group in common_words.values() for w in group.split()}))
    # A mark before each common word, and a word that leads what precedes the first.
    marked = F.regexp_replace(words, rf"(?<![^ ])(?=(?:{common})(?: |$))", "\u0001")
    marked = F.concat(F.lit("\u0002 "), marked)
    spots = F.transform(F.split(marked, "\u0001"), lambda spot: F.split(F.regexp_replace(F.rtrim(spot), " +", " "), " "))

    def chains(words: Column) -> Column:
        """The hashes of a spot's chains: none if its common word is followed by another at once."""
        n = F.size(words) - 1

        def chain_at(at):
            inside = [F.when(at + k <= n, F.get(words, at + k)) for k in range(chain)]
            return F.xxhash64(F.get(words, F.lit(0)), *inside)

        return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1)), F.lit(chain)), chain_at))

    hashes = F.flatten(F.transform(F.filter(spots, lambda w: F.size(w) > 1), lambda w: F.coalesce(chains(w), F.array().cast("array<bigint>"))))
    exact = F.array(F.xxhash64(F.lit("\u0001"), text))
    found = F.array_sort(F.array_distinct(hashes))
    return F.when(F.size(found) > 0, found).otherwise(exact)


def fingerprint_text(signature_array: Column) -> Column:
    """The fingerprint as text: the hashes in order, 16 hexadecimal digits each."""
    return F.array_join(F.transform(signature_array, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets, from 0 to 1."""
    both = F.size(F.array_intersect(a, b))
    return (both / (F.size(a) + F.size(b) - both)).cast("double")


def similar_pairs(fingerprints: DataFrame, threshold: float, id_col="doc_id", set_col="signatures") -> DataFrame:
    """low, high, likeness: pairs of different fingerprints that are at least ``threshold`` alike.

    One row stands for all rows of equal fingerprints, the one with the least id;
    ``representatives`` gives the membership. Sets are partitioned by length: each
    partition spans lengths within the threshold of each other, so a set meets
    only its own partition and the next one. Within them, only sets that share a
    signature in a prefix can be similar enough (signatures that few sets have
    come first), and lengths or places that rule it out end a comparison before
    the exact Jaccard. Empty tables, and null sets, give no pairs.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    sets = fingerprints.where(F.size(set_col) > 0).groupBy(F.col(set_col).alias("set")).agg(F.min(id_col).alias("id"))
    spread = sets.select("id", F.size("set").alias("n"), F.explode("set").alias("signature"))
    counts = spread.groupBy("signature").agg(F.count("*").alias("holders"))
    ordered = Window.partitionBy("id").orderBy("holders", "signature")
    prefix = F.col("n") - F.ceil(F.col("n") * F.lit(threshold)) + 1
    ranked = (
        # A signature of one set only cannot be shared, yet has its place in the order.
        spread.join(counts, "signature")
        .withColumn("place", F.row_number().over(ordered))
        .where(F.col("place") <= prefix)
        .where("holders > 1")
    )
    # Partition k holds lengths from 1/threshold^k to 1/threshold^(k+1).
    width = F.log(F.lit(1 / threshold))
    length = F.floor(F.log(F.col("n").cast("double")) / width).cast("int") if threshold < 1 else F.col("n")
    own = ranked.withColumn("partition", length)
    longer = own.select(*(F.col(c).alias(f"{c}_b") for c in ("id", "n", "place", "partition", "signature")))
    shorter = own.withColumn("partition", F.explode(F.array(F.col("partition"), F.col("partition") + 1)))
    overlap = F.lit(threshold / (1 + threshold)) * (F.col("n") + F.col("n_b"))
    reach = F.least(F.col("n") - F.col("place"), F.col("n_b") - F.col("place_b")) + 1
    # Shared signatures before this one are in both prefixes, so at most place - 1.
    reach = reach + F.least("place", "place_b") - 1
    candidates = (
        shorter.join(
            longer,
            (F.col("partition") == F.col("partition_b"))
            & (F.col("signature") == F.col("signature_b"))
            & (F.struct("n", "id") < F.struct(F.col("n_b").alias("n"), F.col("id_b").alias("id")))
            & (F.col("n") >= F.col("n_b") * threshold - 1e-9)
            & (reach >= overlap - 1e-9),
        )
        .select("id", "id_b")
        .distinct()
    )
    pairs = candidates.join(sets.select("id", F.col("set").alias("a")), "id").join(
        sets.select(F.col("id").alias("id_b"), F.col("set").alias("b")), "id_b"
    )
    return (
        pairs.withColumn("likeness", likeness(F.col("a"), F.col("b")))
        .where(F.col("likeness") >= threshold)
        .select(F.least("id", "id_b").alias("low"), F.greatest("id", "id_b").alias("high"), "likeness")
    )


def with_next(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, text and signatures of every row, and those of the row after it; the last is followed by the first.

    Order: ascending id, null ids last, rows of one id by a hash of their text.
    Columns: doc_id, text, signatures, next_text, next_signatures. A null text
    is the empty text. A single row is followed by itself.

    Ids are cut into ranges of about equal numbers of rows; the first row of each
    range goes to the range before it too, as a guest that ends it. So texts move
    once and no task holds more than a range. Rows of one id fall into one range.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    n_ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    unnamed = F.col("doc_id").isNull()
    # As many numbers as there are ranges.
    found = rows.agg(
        F.percentile_approx("doc_id", [i / n_ranges for i in range(n_ranges)], 10 * n_ranges).alias("cuts"),
        F.min("doc_id").alias("least"),
        F.min(F.when(unnamed, F.xxhash64("text"))).alias("least_unnamed"),
    ).first()
    cuts = sorted({*(found.cuts or []), found.least} - {None})
    # Range k from 1 starts with the k-th cut; rows without an id are range 0, which comes last.
    last = 0 if found.least_unnamed is not None else len(cuts)
    bounds = F.expr(f"array({', '.join(f'{c}L' for c in cuts)})").cast("array<long>")

    def step(at, s):
        inside = at + s <= len(cuts)
        return F.when(inside & (F.element_at(bounds, F.least(at + s, F.lit(len(cuts)))) <= F.col("doc_id")), at + s).otherwise(at)

    # Binary search: how many cuts are at or below the id.
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    place = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step) if cuts else F.lit(0)
    ranged = rows.withColumn("home", F.when(unnamed, F.lit(0)).otherwise(place))
    is_first = F.when(unnamed, F.xxhash64("text") == F.lit(found.least_unnamed)).otherwise(
        F.col("doc_id") == F.element_at(bounds, F.greatest("home", F.lit(1))) if cuts else F.lit(False)
    )
    previous = F.when(unnamed, F.lit(len(cuts))).when(F.col("home") == 1, F.lit(last)).otherwise(F.col("home") - 1)
    own = F.struct(F.col("home").alias("range"), F.lit(0).alias("guest"))
    guest = F.struct(previous.alias("range"), F.lit(1).alias("guest"))
    placed = ranged.withColumn("at", F.explode(F.when(is_first, F.array(own, guest)).otherwise(F.array(own))))
    order = Window.partitionBy("range").orderBy("guest", F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), "text")
    return (
        placed.select("doc_id", "text", "at.*")
        .withColumn("signatures", signatures(F.col("text")))
        .withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_signatures", F.lead("signatures").over(order))
        .where("guest = 0")
        .select("doc_id", "text", "signatures", "next_text", "next_signatures")
    )
