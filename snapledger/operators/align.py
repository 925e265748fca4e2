"""Bringing two tables to one schema, and the unions built on that."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

_WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_NUMBERS = [*_WHOLE, T.FloatType, T.DoubleType]


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """Equal types stay; void takes the other side; numbers and date/timestamp
    widen; everything else meets at string."""
    if isinstance(a, T.NullType) and isinstance(b, T.NullType):
        return T.StringType()
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType) or a == b:
        return a
    kinds = (type(a), type(b))
    if all(k in _WHOLE for k in kinds):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if all(k in _NUMBERS for k in kinds):
        return T.DoubleType()
    if all(k in _WHOLE or k is T.DecimalType for k in kinds):
        return _wider_decimal(a, b)
    if all(k in _NUMBERS or k is T.DecimalType for k in kinds):
        return T.DoubleType()
    for stamp in (T.TimestampNTZType, T.TimestampType):
        if set(kinds) == {T.DateType, stamp}:
            return stamp()
    return T.StringType()


def _wider_decimal(a: T.DataType, b: T.DataType) -> T.DataType:
    def shape(t):
        return (t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (19, 0)

    whole, scale = (max(x) for x in zip(shape(a), shape(b)))
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()


def align(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Same columns, types and order: the left's columns, then the right's new ones.

    Names match as Spark's do, without case; the left's spelling stays.
    """
    spelled = {c.lower(): c for c in left.columns}
    right = right.toDF(*[spelled.get(c.lower(), c) for c in right.columns])
    types_l = {f.name: f.dataType for f in left.schema}
    types_r = {f.name: f.dataType for f in right.schema}
    target = {
        name: common_type(types_l.get(name, T.NullType()), types_r.get(name, T.NullType()))
        for name in dict.fromkeys([*types_l, *types_r])
    }

    def fit(df: DataFrame, own: dict[str, T.DataType]) -> DataFrame:
        out = []
        for name, to in target.items():
            if name not in own:
                c = F.lit(None).cast(to)
            elif own[name] == to:
                c = F.col(f"`{name}`")
            elif isinstance(own[name], T.NullType):
                c = F.col(f"`{name}`").cast(to)
            else:
                c = F.col(f"`{name}`").try_cast(to)
            out.append(c.alias(name))
        return df.select(*out)

    return fit(left, types_l), fit(right, types_r)


def union_aligned(left: DataFrame, right: DataFrame) -> DataFrame:
    left, right = align(left, right)
    return left.unionByName(right)


def union_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Aligned union without repeated rows (nulls compare equal).

    Shuffles every column of both sides. The report tables use
    ``current.distinct()`` plus a plain union instead, see ``plans``.
    """
    return union_aligned(left, right).distinct()
