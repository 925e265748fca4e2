"""Left lookups with explicit rules for nulls, clashing names and hot keys.

Null keys: in a plain left join they match nothing, yet they all hash to one
partition. ``spread_by`` sends them to many. A hot key that is not null is left
to adaptive execution, which splits an oversized left-side partition of an outer
or anti join into several tasks, or to :mod:`snapledger.operators.skew`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _pairs(on) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else tuple(k) for k in on]


def left_lookup(
    left: DataFrame,
    right: DataFrame,
    on,
    suffix: str = "_right",
    null_safe: bool = False,
    spread_by: str | None = None,
    beside: list = (),
) -> DataFrame:
    """``left LEFT JOIN right``: all left columns, then the right's other columns.

    ``on`` holds names, or ``(left name, right name)`` pairs. Right columns whose
    name the left already has (Spark compares names without case) get ``suffix``;
    if a column of that name exists as well, it is an error.
    With ``null_safe`` a null key equals a null key; otherwise ``spread_by`` may
    name a left column that tells rows apart, for large tables with text keys that
    are often null.
    ``beside`` holds further keys, nulls as in the others, by which rows are not dealt but
    compared where the others have brought them. With the date there, the dated rows of
    one key stay side by side, and their shuffle takes a fraction of the bytes; a row is
    compared with all lookup rows of its other keys, so there should be few.
    """
    pairs, beside = _pairs(on), _pairs(beside)
    key_name = {r: f"__key_{i}" for i, (_, r) in enumerate([*pairs, *beside])}
    taken = {c.lower() for c in left.columns}
    new = [
        (c + suffix if c.lower() in taken else c).lower() for c in right.columns if c not in key_name
    ]
    clash = sorted({c for c in new if c in taken or new.count(c) > 1})
    if clash:
        raise ValueError(f"columns {clash} would occur twice; choose another suffix than {suffix!r}")
    right = right.select(
        *[
            F.col(f"`{c}`").alias(
                key_name.get(c) or (c + suffix if c.lower() in taken else c)
            )
            for c in right.columns
        ]
    )
    tests = []
    text = {f.name for f in left.schema if isinstance(f.dataType, T.StringType)}
    for l, r in pairs:
        lk, rk = F.col(f"`{l}`"), F.col(key_name[r])
        if null_safe:
            tests.append(lk.eqNullSafe(rk))
        elif spread_by and l in text:
            tests += [_spread_nulls(lk, F.col(f"`{spread_by}`")) == rk, lk.isNotNull()]
        else:
            tests.append(lk == rk)
    for l, r in beside:
        lk, rk = F.col(f"`{l}`"), F.col(key_name[r])
        # Not written as one equality, which the planner would deal rows by.
        tests.append(F.coalesce(lk == rk, lk.isNull() & rk.isNull()) if null_safe else lk.between(rk, rk))
    joined = left.join(right, reduce(Column.__and__, tests), "left")
    return joined.drop(*key_name.values())


def spread_key(key: Column, by: Column) -> Column:
    """What :func:`left_lookup` with ``spread_by`` deals its left rows by, for a table that is dealt by it before."""
    return _spread_nulls(key, by)


def _spread_nulls(key: Column, by: Column) -> Column:
    """The key, or for a null key a value that differs from row to row.

    The stand-in only decides where the row is sent: the join also demands a
    non-null key. It is a hash and not random, so a retried task repeats it.
    """
    return F.coalesce(key, F.concat(F.lit("\u0000"), F.xxhash64(by).cast("string")))


def fallback_lookup(
    df: DataFrame,
    first: DataFrame,
    second: DataFrame,
    first_on,
    second_on,
    values: list[str],
    suffix: str = "_sum",
    spread_by: str | None = None,
) -> DataFrame:
    """Look ``values`` up in ``first``; where that gives null, in ``second``.

    Both lookups are plain left joins: a null key never matches, and a lookup
    with several rows per key yields several rows. ``spread_by`` as in
    :func:`left_lookup`.
    """
    joined = left_lookup(df, first, first_on, suffix, spread_by=spread_by)
    joined = left_lookup(joined, second, second_on, suffix, spread_by=spread_by)
    return joined.withColumns(
        {v: F.coalesce(F.col(f"`{v}`"), F.col(f"`{v}{suffix}`")) for v in values}
    ).drop(*[v + suffix for v in values])


def assert_unique(lookup: DataFrame, on) -> DataFrame:
    """Strict mode: raise when a lookup has more than one row for a key.

    One aggregate with partial aggregation; a null key part cannot match a plain
    join and is ignored.
    """
    keys = [r for _, r in _pairs(on)]
    repeated = lookup.dropna(subset=keys).groupBy(*keys).count().where("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"lookup is not unique on {keys}")
    return lookup


def without_keys(df: DataFrame, keys_of: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``keys_of`` (null keys stay)."""
    return df.join(keys_of.select(*on).distinct(), on, "left_anti")
