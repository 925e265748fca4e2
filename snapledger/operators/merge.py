"""Keyed merge of dated snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from snapledger import fixed
from snapledger.functions.casting import to_date
from snapledger.operators.align import union_aligned
from snapledger.operators.columns import require_columns
from snapledger.operators.joins import without_keys


class ShrinkError(RuntimeError):
    """A merge would lose more rows than allowed."""


def check_retention(before: int, after: int, ratio: float = fixed.MIN_RETENTION) -> None:
    if after < ratio * before:
        raise ShrinkError(
            f"{after} rows after the merge, {before} before (at least {ratio:.0%} expected); "
            "use force to accept"
        )


def normalize_keys(
    df: DataFrame, key: str, snapshot: str = fixed.SNAPSHOT
) -> DataFrame:
    """Key as text, snapshot as date; both columns must exist. Keys are only cast:
    keys that differ in surrounding white space stay two keys."""
    require_columns(df, [key, snapshot])
    return df.withColumns(
        {key: F.col(f"`{key}`").cast("string"), snapshot: to_date(F.col(f"`{snapshot}`"))}
    )


def latest_per_key(
    df: DataFrame, keys: list[str], newest: str | list[str] = (), dealt_by: list[str] | None = None
) -> DataFrame:
    """One row per key; rows with a null key part are dropped.

    The row with the greatest ``newest`` columns wins; the remaining columns
    complete a total order, so the choice does not depend on partitioning. Spark
    keeps only the first row per key in each map task before the shuffle
    (``WindowGroupLimit ... Partial``), which bounds what a hot key sends.
    ``dealt_by`` names a part of the key to deal rows by before that. With the date left
    out, the dated rows of a key lie side by side in this shuffle and, sorted, in the
    next, and take a fraction of the bytes; repeats are then sent before they go.
    """
    df = df.dropna(subset=keys)
    if dealt_by:
        df = df.repartition(*[F.col(f"`{c}`") for c in dealt_by])
    newest = [newest] if isinstance(newest, str) else list(newest)
    rest = [
        f.name for f in df.schema
        if f.name not in {*keys, *newest}
        and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    order = [F.col(f"`{c}`").desc_nulls_last() for c in newest]
    order += [F.col(f"`{c}`").asc_nulls_first() for c in rest]
    if not order:
        return df.distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def merge_snapshots(
    cached: DataFrame,
    recent: DataFrame,
    key: str,
    snapshot: str = fixed.SNAPSHOT,
    newest: str | list[str] = (),
    cached_is_unique: bool = False,
    recent_is_unique: bool = False,
) -> DataFrame:
    """Recent rows replace cached rows of the same key and snapshot.

    The anti-join leaves no key on both sides, so each side is reduced to one row
    per key on its own and the union needs no further shuffle. ``..._is_unique``
    says that a side already holds one row per key.
    """
    keys = [key, snapshot]
    cached = normalize_keys(cached, key, snapshot)
    recent = normalize_keys(recent, key, snapshot)
    kept = without_keys(cached, recent, keys).select(*cached.columns)
    newest = [newest] if isinstance(newest, str) else newest

    def one_per_key(df: DataFrame, is_unique: bool) -> DataFrame:
        if is_unique:
            return df.dropna(subset=keys)
        return latest_per_key(df, keys, [c for c in newest if c in df.columns])

    return union_aligned(
        one_per_key(kept, cached_is_unique), one_per_key(recent, recent_is_unique)
    )
