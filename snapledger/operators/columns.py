"""Projections described by column lists."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F

from snapledger.functions.text import parse_column


def project(
    df: DataFrame, columns: Iterable[str], constants: dict[str, Column] | None = None
) -> DataFrame:
    """Select ``"SOURCE -> OUTPUT"`` columns; ``constants`` (by output name)
    supplies columns that are not read from the table, such as typed nulls."""
    constants = constants or {}
    selected = []
    for source, output in map(parse_column, columns):
        value = constants[output] if output in constants else F.col(f"`{source}`")
        selected.append(value.alias(output))
    return df.select(*selected)


def typed_null(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


def rename_all(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    return df.toDF(*[rule(c) for c in df.columns])


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Fail before any job runs when a required column is missing."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise KeyError(f"missing columns: {missing}")
    return df
