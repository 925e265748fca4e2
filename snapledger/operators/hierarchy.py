"""Flattening a fixed-depth hierarchy held as parent pointers."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from snapledger import fixed
from snapledger.functions.dates import recent_bound
from snapledger.functions.text import parse_column
from snapledger.operators.joins import left_lookup
from snapledger.operators.merge import latest_per_key
from snapledger.session import stage


def split_levels(
    items: DataFrame,
    snapshot: str | None = None,
    levels: Mapping[str, list[str]] = fixed.LEVEL_COLUMNS,
    kind: str = "ISSUE_TYPE",
    key: str = "ISSUE_KEY",
    parent: str = "PARENT_KEY",
) -> DataFrame:
    """The rows of all levels, staged in a folder for each level by one pass over ``items``.

    Only columns that a level uses are written for it. A filter on ``kind`` then
    reads that level's folder alone, and its size is known to the planner. For
    sources that are expensive to read once per level: joins, JDBC, wide text files.
    """
    source = F.col(f"`{kind}`")
    used: dict[str, list[str]] = {}
    for level, columns in levels.items():
        for name, _ in map(parse_column, columns):
            used.setdefault(name, []).append(level)
    # The structure's own columns are needed on every level.
    fixed_columns = [parent, key] + ([snapshot] if snapshot else [])
    rows = items.where(source.isin(list(levels))).select(
        *[F.col(f"`{c}`") for c in fixed_columns],
        *[
            F.when(source.isin(on), F.col(f"`{c}`")).alias(c)
            for c, on in used.items()
            if c not in {*fixed_columns, kind}
        ],
        source,
    )
    return stage(rows, "levels", partition_by=kind)


def flatten_hierarchy(
    items: DataFrame,
    snapshot: str | None = None,
    levels: Mapping[str, list[str]] = fixed.LEVEL_COLUMNS,
    kind: str = "ISSUE_TYPE",
    key: str = "ISSUE_KEY",
    parent: str = "PARENT_KEY",
    unique: bool = False,
    staged: bool = False,
    leaf_from: DataFrame | None = None,
    attach: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
) -> DataFrame:
    """One wide row per leaf. ``levels`` maps kind -> columns, leaf first.

    With ``snapshot`` parent and child must also agree on that column. A broken
    link leaves everything above it null. A key that occurs more than once on a
    level gives a row for each; ``unique`` first keeps one row per key and
    snapshot on every level, so that repeated keys do not multiply each other.
    ``staged`` reads ``items`` once (see :func:`split_levels`) and not once per level.
    ``leaf_from`` may name a table whose leaf rows are cheap to read by themselves:
    then only the levels above are staged, and the leaves are not written again.
    ``attach`` joins more columns to a level, before the levels below see it: its
    functions get the rows keyed by ``__id`` (and ``__day``) and return them keyed alike.

    The chain is joined from the root down, so the upper levels, each a fraction
    of the one below, are resolved among themselves and the leaf table is
    shuffled once rather than once per level. Left joins on a child's parent key
    may be regrouped like this because a missing child has no parent to match.
    Dated rows are dealt by the key alone and their dates compared where they meet:
    the dates of one key then lie side by side, and compress to little more than one.
    """
    day = [snapshot] if snapshot else []
    leaf = next(iter(levels))
    if staged:
        above = levels if leaf_from is None else {k: c for k, c in levels.items() if k != leaf}
        items = split_levels(items, snapshot, above, kind, key, parent)
    upper = None
    for level, columns in reversed(list(levels.items())):
        source = leaf_from if level == leaf and leaf_from is not None else items
        rows = source.where(F.col(kind) == level).select(
            F.col(key).alias("__id"),
            F.col(parent).alias("__up"),
            *[F.col(d).alias("__day") for d in day],
            *[F.col(s).alias(o) for s, o in map(parse_column, columns)],
        )
        if unique:
            rows = latest_per_key(rows, ["__id"] + ["__day" for _ in day], dealt_by=["__id"] if day else None)
        if upper is not None:
            beside = [("__day", "__day") for _ in day]
            rows = left_lookup(rows, upper.drop("__up"), [("__up", "__id")], spread_by="__id", beside=beside)
        if attach and level in attach:
            rows = attach[level](rows)
        upper = rows
    if snapshot:
        upper = upper.withColumnRenamed("__day", snapshot)
    return upper.drop("__id", "__up")


def recent_rows(
    df: DataFrame,
    as_of: datetime,
    days: int = fixed.RECENT_DAYS,
    snapshot: str = fixed.SNAPSHOT,
) -> DataFrame:
    """Snapshots not older than ``days``. Apply to the base table before
    :func:`flatten_hierarchy`: a date filter on the result reaches the leaf and
    its parent through the join keys, but not the levels above."""
    return df.where(F.col(snapshot) >= recent_bound(as_of, days))
