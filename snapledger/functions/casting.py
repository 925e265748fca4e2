"""Casts that turn bad values into null instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from snapledger.functions.text import strip_text

# Java's number parser takes a type suffix ("1.0f") and hexadecimal floats;
# neither is a number in a report column.
_JAVA_ONLY_NUMBER = r"(?i)[0-9.][df]\s*$|x"


def to_date(c: Column) -> Column:
    return c.try_cast("date")


def to_timestamp(c: Column) -> Column:
    return c.try_cast("timestamp_ntz")


def to_double(c: Column, source: T.DataType | None = None) -> Column:
    if source is None or isinstance(source, T.StringType):
        text = c.cast("string")
        c = F.when(~text.rlike(_JAVA_ONLY_NUMBER), text)
    return c.try_cast("double")


def to_text(c: Column) -> Column:
    return strip_text(c.cast("string"))


def coerce(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns by a partial map name -> ``datetime | float | string``.

    Names the table lacks are skipped; values that do not parse become null.
    """
    cast = {
        "datetime": lambda name: to_timestamp(F.col(f"`{name}`")),
        "float": lambda name: to_double(F.col(f"`{name}`"), df.schema[name].dataType),
        "string": lambda name: to_text(F.col(f"`{name}`")),
    }
    present = set(df.columns)
    changes = {
        name: cast[word](name) for name, word in types.items() if name in present
    }
    return df.withColumns(changes) if changes else df


def void_to_string(df: DataFrame) -> DataFrame:
    """Give all-null (void) columns a type; read from the schema, no scan."""
    voids = [f.name for f in df.schema if isinstance(f.dataType, T.NullType)]
    if not voids:
        return df
    return df.withColumns({n: F.col(f"`{n}`").cast("string") for n in voids})
