"""Column profile of a table, as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Relative standard error of an estimate is about 1.04 / sqrt(2^12), 1.6 %, once sketches are merged.
SKETCH_BITS = 12


def _is_ordered(t: T.DataType) -> bool:
    return isinstance(
        t, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
    )


def _plain(name: str, t: T.DataType) -> Column:
    """A value to hash: equal values of a column, and only those, give equal plain values."""
    c = F.col(f"`{name}`")
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return c + F.lit(0.0)
    if isinstance(t, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
        return F.when(c.isNotNull(), F.to_json(F.struct(c)))
    return c


def _hashed(df: DataFrame) -> DataFrame:
    """``df`` with a column ``__h0``, ``__h1``, ... for each of its own: the hash of the value,
    null for null. A sketch evaluates what it is given row by row without compiled code, so
    it is given columns that are ready."""
    hashes = {
        f"__h{i}": F.when(F.col(f"`{f.name}`").isNotNull(), F.xxhash64(F.lit(1), _plain(f.name, f.dataType)))
        for i, f in enumerate(df.schema)
    }
    return df.withColumns(hashes)


def _held(i: int) -> Column:
    """Values of a column that are not null, counted by their hashes: a second use keeps
    the planner from moving the hash into the sketch."""
    return F.count(f"__h{i}")


def _sketch(i: int) -> Column:
    """A sketch of the different values of a column of :func:`_hashed`, nulls left out."""
    return F.hll_sketch_agg(F.col(f"__h{i}"), SKETCH_BITS)


def _cell(i: int, f: T.StructField) -> list[Column]:
    """Position, two halves of the value, and the value itself where it is a text, which
    is hashed later. Whole numbers and dates are their own first half; anything else,
    long or short, is a 128-bit hash, so that a distinct count moves numbers of fixed
    width and never whole texts."""
    c = F.col(f"`{f.name}`")
    none = F.lit(None)
    if f.dataType == T.StringType():
        cells = (none.cast("long"), none.cast("long"), c.cast("string"))
    elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)):
        whole = F.unix_date(c) if isinstance(f.dataType, T.DateType) else c
        cells = (whole.cast("long"), F.when(c.isNotNull(), F.lit(0).cast("long")), none.cast("string"))
    else:
        cells = (*_halves(c, _plain(f.name, f.dataType)), none.cast("string"))
    return [F.lit(i).alias(f"i{i}"), *[v.alias(f"{name}{i}") for name, v in zip("abt", cells)]]


def _halves(c: Column, value: Column) -> tuple[Column, Column]:
    """Two hashes of ``value``, null where ``c`` is."""
    return tuple(F.when(c.isNotNull(), F.xxhash64(F.lit(seed), value)) for seed in (1, 2))


def _exact_uniques(df: DataFrame) -> DataFrame:
    """(position, UNIQUES), null counted as one value.

    Columns are unpivoted to narrow rows of fixed width, so one hash aggregate with
    partial aggregation serves all of them; several distinct counts in one
    aggregate would copy the whole row once per column. Cells are plain columns, not
    structs, and texts are hashed after the unpivot, by one expression for all columns.
    """
    cells = df.select(*[cell for i, f in enumerate(df.schema) for cell in _cell(i, f)])
    names = ", ".join(f"(i{i}, a{i}, b{i}, t{i})" for i in range(len(df.columns)))
    rows = df.sparkSession.sql(
        f"select __i, a, b, t from {{cells}} unpivot include nulls ((__i, a, b, t) for __column in ({names}))", cells=cells
    )
    texts = _halves(F.col("t"), F.col("t"))
    rows = rows.select("__i", *[F.coalesce(F.col(n), h).alias(n) for n, h in zip("ab", texts)])
    return rows.distinct().groupBy("__i").agg(F.count(F.lit(1)).alias("UNIQUES"))


def profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """One row per column: type, nulls, null share, distinct values, min and max.

    Minimum and maximum (as text) are given for numbers and times only. Shares of
    an empty table are 0. ``exact=False`` estimates the distinct counts in the
    same single pass that counts nulls, with the sketches of :func:`profile_parts`.
    """
    fields = list(df.schema)
    sums = [F.count(F.lit(1)).alias("__rows")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        nulls = F.count_if(c.isNull()) if exact else F.count(F.lit(1)) - _held(i)
        sums.append(nulls.alias(f"n{i}"))
        if _is_ordered(f.dataType):
            sums += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
        if not exact:
            sums.append((F.hll_sketch_estimate(_sketch(i)) + (nulls > 0).cast("long")).alias(f"u{i}"))

    def line(i: int, f: T.StructField) -> Column:
        nulls, rows = F.col(f"n{i}"), F.col("__rows")
        none = F.lit(None).cast("string")
        ordered = _is_ordered(f.dataType)
        share = F.when(rows > 0, F.round(nulls * 100.0 / rows, 4)).otherwise(0.0)
        cells = [
            F.lit(i).alias("POSITION"),
            F.lit(f.name).alias("COLUMN_NAME"),
            F.lit(f.dataType.simpleString()).alias("DATA_TYPE"),
            rows.alias("ROW_COUNT"),
            nulls.alias("NULLS"),
            share.alias("NULL_PCT"),
            (F.col(f"lo{i}").cast("string") if ordered else none).alias("MIN_VALUE"),
            (F.col(f"hi{i}").cast("string") if ordered else none).alias("MAX_VALUE"),
        ]
        if not exact:
            cells.append(F.col(f"u{i}").alias("UNIQUES"))
        return F.struct(*cells)

    lines = (df if exact else _hashed(df)).agg(*sums).select(
        F.explode(F.array(*[line(i, f) for i, f in enumerate(fields)])).alias("l")
    ).select("l.*")
    if exact:
        # One row per column of the schema: its size does not grow with the data.
        uniques = F.broadcast(_exact_uniques(df))
        lines = lines.join(uniques, F.col("POSITION") == F.col("__i"), "left").withColumn(
            "UNIQUES", F.coalesce("UNIQUES", F.lit(0).cast("long"))
        )
    return lines.select(
        "POSITION", "COLUMN_NAME", "DATA_TYPE", "ROW_COUNT", "NULLS", "NULL_PCT",
        "UNIQUES", "MIN_VALUE", "MAX_VALUE",
    )


def profile_total(lines: DataFrame) -> DataFrame:
    """The table line under a profile: all nulls and their share of all cells."""
    nulls, cells = F.sum("NULLS"), F.sum("ROW_COUNT")
    return lines.agg(
        nulls.alias("NULLS"),
        F.when(cells > 0, F.round(nulls * 100.0 / cells, 4)).otherwise(0.0).alias("NULL_PCT"),
    )


# --- profiles that can be merged ---------------------------------------------------
_BOUNDS = {"long": "long", "double": "double", "decimal": "decimal(38,18)", "time": "timestamp_ntz"}


def _bounds_of(t: T.DataType) -> str | None:
    """Which pair of columns keeps the least and greatest value of a type."""
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "long"
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return "double"
    if isinstance(t, T.DecimalType):
        return "decimal"
    return "time" if _is_ordered(t) else None


def profile_parts(df: DataFrame, by: str) -> DataFrame:
    """One row per value of ``by`` and column: rows, nulls, bounds and a sketch of the values.

    One pass with partial aggregation. Parts of different rows can be merged by
    :func:`merge_profiles` at any later time, without the rows.
    """
    fields = list(df.schema)
    sums = []
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        sums += [(F.count(F.lit(1)) - _held(i)).alias(f"n{i}"), _sketch(i).alias(f"s{i}")]
        if _bounds_of(f.dataType):
            sums += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]

    def line(i: int, f: T.StructField) -> Column:
        kept = _bounds_of(f.dataType)
        bounds = [
            (F.col(f"{side}{i}") if name == kept else F.lit(None)).cast(kind).alias(f"{side}_{name}")
            for name, kind in _BOUNDS.items() for side in ("lo", "hi")
        ]
        return F.struct(
            F.lit(i).alias("POSITION"), F.lit(f.name).alias("COLUMN_NAME"),
            F.lit(f.dataType.simpleString()).alias("DATA_TYPE"),
            F.col("__rows").alias("ROW_COUNT"), F.col(f"n{i}").alias("NULLS"), F.col(f"s{i}").alias("SKETCH"), *bounds,
        )

    grouped = _hashed(df).groupBy(F.col(f"`{by}`").alias("__by")).agg(F.count(F.lit(1)).alias("__rows"), *sums)
    lines = F.explode(F.array(*[line(i, f) for i, f in enumerate(fields)])).alias("l")
    return grouped.select(F.col("__by").alias(by), lines).select(f"`{by}`", "l.*")


def merge_profiles(parts: DataFrame) -> DataFrame:
    """The profile of all rows behind ``parts``, as :func:`profile` with estimated distinct counts.

    Columns are told apart by name; parts that lack a column count its rows as
    nulls. A column whose type has changed between parts shows the latest type by
    name order and keeps each type's bounds apart.
    """
    lows = [f"lo_{name}" for name in _BOUNDS]
    highs = [f"hi_{name}" for name in _BOUNDS]
    rest = [c for c in parts.columns if c not in {"POSITION", "COLUMN_NAME", "DATA_TYPE", "ROW_COUNT", "NULLS", "SKETCH", *lows, *highs}]
    whole = parts.groupBy(*rest).agg(F.max("ROW_COUNT").alias("n")).agg(F.sum("n").alias("ALL_ROWS"))
    merged = parts.groupBy("COLUMN_NAME").agg(
        F.max("POSITION").alias("POSITION"), F.max("DATA_TYPE").alias("DATA_TYPE"),
        F.sum("ROW_COUNT").alias("HELD"), F.sum("NULLS").alias("NULLS"),
        F.hll_sketch_estimate(F.hll_union_agg("SKETCH")).alias("VALUES"),
        *[F.min(c).alias(c) for c in lows], *[F.max(c).alias(c) for c in highs],
    )
    # One row: the number of all rows.
    merged = merged.withColumn("ROW_COUNT", whole.scalar())
    nulls = F.col("NULLS") + F.col("ROW_COUNT") - F.col("HELD")

    def text(columns: list[str]) -> Column:
        kinds = {c: F.col(c).cast("string") for c in columns}
        date = columns[-1]
        kinds[date] = F.when(F.col("DATA_TYPE") == "date", F.col(date).cast("date").cast("string")).otherwise(kinds[date])
        return F.coalesce(*kinds.values())

    return merged.select(
        "POSITION", "COLUMN_NAME", "DATA_TYPE", "ROW_COUNT", nulls.alias("NULLS"),
        F.round(nulls * 100.0 / F.col("ROW_COUNT"), 4).alias("NULL_PCT"),
        (F.col("VALUES") + (nulls > 0).cast("long")).alias("UNIQUES"),
        text(lows).alias("MIN_VALUE"), text(highs).alias("MAX_VALUE"),
    )
