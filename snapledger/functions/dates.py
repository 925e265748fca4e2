"""Snapshot calendar. Nothing here reads the clock: "now" is an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from snapledger import fixed


def now_literal(as_of: dt.datetime) -> Column:
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def today_literal(as_of: dt.datetime) -> Column:
    return F.lit(as_of.date())


def recent_bound(as_of: dt.datetime, days: int = fixed.RECENT_DAYS) -> Column:
    """``as_of`` minus whole days. A timestamp, not a date: with a time of day in
    ``as_of`` the snapshot exactly ``days`` back lies outside the window."""
    return now_literal(as_of - dt.timedelta(days=days))


def snapshot_days(
    from_date: dt.date,
    n: int = fixed.LOOKBACK_WEEKS,
    day_of_week: int = fixed.MONDAY,
) -> list[dt.date]:
    """The last ``n`` dates falling on ``day_of_week`` (Monday = 0), newest first;
    ``from_date`` itself counts when it falls on that day."""
    day = from_date.date() if isinstance(from_date, dt.datetime) else from_date
    newest = day - dt.timedelta(days=(day.weekday() - day_of_week) % 7)
    return [newest - dt.timedelta(weeks=i) for i in range(n)]


def last_weekday(day: Column, day_of_week: int = fixed.MONDAY) -> Column:
    """Column form: the latest ``day_of_week`` up to and including ``day``."""
    return F.date_sub(day, F.pmod(F.weekday(day) - day_of_week, F.lit(7)))


def snapshot_day_array(
    day: Column, n: int = fixed.LOOKBACK_WEEKS, day_of_week: int = fixed.MONDAY
) -> Column:
    """Column form of :func:`snapshot_days`: an array of ``n`` dates per row."""
    newest = last_weekday(day, day_of_week)
    return F.array(*[F.date_sub(newest, 7 * i) for i in range(n)])
