"""Sprint versions such as ``26.1.2`` or ``26.1.IP`` held in free text.

A version becomes one comparable number, year * 10000 + increment * 100 +
sprint, with the planning sprint ``IP`` last. Whatever does not parse counts as
zero, so a name without a version has key 0 and prints as ``0.0.0``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from snapledger import fixed
from snapledger.functions.text import extract_or_null


def version_at_end(name: Column) -> Column:
    return extract_or_null(name, fixed.SPRINT_AT_END)


def version_anywhere(name: Column) -> Column:
    return extract_or_null(name, fixed.SPRINT_ANYWHERE)


def increment_of(name: Column) -> Column:
    """The leading ``26.1`` of the version found anywhere in the text."""
    return F.substring(version_anywhere(name), 1, fixed.INCREMENT_PREFIX)


def version_key(version: Column) -> Column:
    def part(i: int) -> Column:
        return F.split_part(version, F.lit("."), F.lit(i))

    def whole(i: int) -> Column:
        return F.coalesce(part(i).try_cast("bigint"), F.lit(0).cast("bigint"))

    sprint = F.when(
        part(3) == fixed.IP_LABEL, F.lit(fixed.IP_RANK).cast("bigint")
    ).otherwise(whole(3))
    return (whole(1) % 100) * 10000 + whole(2) * 100 + sprint


def key_version(key: Column) -> Column:
    """Inverse of :func:`version_key` (99 always prints as ``IP``)."""
    year, rest = F.call_function("div", key, F.lit(10000)), key % 10000
    sprint = key % 100
    return F.concat(
        year.cast("string"),
        F.lit("."),
        F.call_function("div", rest, F.lit(100)).cast("string"),
        F.lit("."),
        F.when(sprint == fixed.IP_RANK, F.lit(fixed.IP_LABEL)).otherwise(
            sprint.cast("string")
        ),
    )
