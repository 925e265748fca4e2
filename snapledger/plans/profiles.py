"""Profiles of a stored history, kept by date and brought up to date from its manifest."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from snapledger.operators.profile import merge_profiles, profile_parts
from snapledger.sources.history import HistoryStore
from snapledger.sources.reports import ReportFolder


def update_profiles(store: HistoryStore, path: str) -> DataFrame:
    """Profile parts of every stored date, at ``path``; only dates whose folder has
    changed since the last version are read."""
    report = ReportFolder(store.spark, path)
    version, before = report.last()
    noted = before["inputs"] if before else {}
    folders = store.folders()
    stay = {day for day, folder in folders.items() if noted.get(day) == folder}
    changed = sorted(set(folders) - stay)
    if before is not None and not changed and set(noted) == set(folders):
        return report.read()
    rows = store.read([date.fromisoformat(day) for day in changed])
    return report.replace(profile_parts(rows, store.snapshot), store.snapshot, stay, version, folders)


def stored_profile(store: HistoryStore, path: str, days: list[date] | None = None) -> DataFrame:
    """The profile of the history, or of some of its dates, from the stored parts alone."""
    parts = update_profiles(store, path)
    return merge_profiles(parts if days is None else parts.where(parts[store.snapshot].isin(days)))
