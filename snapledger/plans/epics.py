"""The epics report and the release ranges derived from it."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, functions as F

from snapledger import fixed
from snapledger.functions.casting import coerce, to_date
from snapledger.functions.dates import now_literal, today_literal
from snapledger.functions.text import title_name
from snapledger.operators.align import union_aligned
from snapledger.operators.columns import rename_all
from snapledger.operators.fingerprint import date_checksums, table_checksum
from snapledger.operators.gapfill import fill_missing_snapshots, snapshot_copies
from snapledger.operators.hierarchy import flatten_hierarchy, recent_rows
from snapledger.operators.joins import assert_unique, fallback_lookup, left_lookup, spread_key
from snapledger.operators.releases import release_nulls, release_range
from snapledger.operators.rollup import rollup_estimates
from snapledger.operators.sprints import (
    observe_versions, sprint_summary, sprint_windows, summary_current, summary_range, warn_if_unparsed,
)
from snapledger.plans.incremental import by_groups, date_groups, find_changes, run_changes
from snapledger.session import stage
from snapledger.sources.history import HistoryStore
from snapledger.sources.reports import ReportFolder
from snapledger.sources.sinks import write_report

RANGE = ["MIN_SPRINT", "MAX_SPRINT"]
RELEASE_COLUMNS = ["Snapshot Date", "Feature Key", "Subcapability Key"]
# What a roll-up by date reads of a story.
ROLLUP_COLUMNS = ["FEATURE_ID", fixed.GROUP, "STORY_POINTS", "STATUS", "BEGIN_DATE", "END_DATE"]
CURRENT = ["CURRENT_SPRINT"]


def epic_current(
    issues: DataFrame, staged: bool = False, leaf_from: DataFrame | None = None, agile: DataFrame | None = None
) -> DataFrame:
    """One row per epic; with ``agile``, the rows :func:`join_agile` would make of them."""
    flat = flatten_hierarchy(issues, staged=staged, leaf_from=leaf_from, attach=_estimates(agile, False))
    return flat.select(fixed.EPIC_KEY, *fixed.FLAT_COLUMNS, *_estimate_columns(agile))


def epic_history(
    snapshots: DataFrame, staged: bool = False, leaf_from: DataFrame | None = None,
    agile: DataFrame | None = None, unique: bool = False,
) -> DataFrame:
    """One row per epic and date; with ``agile``, the rows :func:`join_agile` would make of them."""
    flat = flatten_hierarchy(
        snapshots, fixed.SNAPSHOT, unique=unique, staged=staged, leaf_from=leaf_from, attach=_estimates(agile, True)
    )
    return flat.select(fixed.SNAPSHOT, fixed.EPIC_KEY, *fixed.FLAT_COLUMNS, *_estimate_columns(agile))


def epic_history_unique(
    snapshots: DataFrame, staged: bool = False, leaf_from: DataFrame | None = None, agile: DataFrame | None = None
) -> DataFrame:
    """:func:`epic_history` with one row per epic and date (and, with ``agile``, group)."""
    return epic_history(snapshots, staged, leaf_from, agile, unique=True)


def _estimate_columns(agile: DataFrame | None) -> list[str]:
    return [] if agile is None else [c for c in agile.columns if c not in {"FEATURE_ID", fixed.SNAPSHOT}]


def _estimates(agile: DataFrame | None, by_snapshot: bool):
    """Joins a roll-up to the features and not to the wide rows of their epics, which
    would then have to be dealt a second time, by feature. The join is on the key the
    epics are joined on next, so its result stays where it is."""
    if agile is None:
        return None
    on, beside = [("__id", "FEATURE_ID")], [("__day", fixed.SNAPSHOT)] if by_snapshot else []
    return {fixed.FEATURE: lambda rows: left_lookup(rows, agile, on, "_agile", beside=beside)}


def agile_current(stories: DataFrame) -> DataFrame:
    return rollup_estimates(stories, ["FEATURE_ID", fixed.GROUP])


def agile_history(snapshots: DataFrame) -> DataFrame:
    return rollup_estimates(snapshots, ["FEATURE_ID", fixed.SNAPSHOT, fixed.GROUP])


def join_agile(
    epics: DataFrame, agile: DataFrame, by_snapshot: bool, strict: bool = False
) -> DataFrame:
    """Estimates of the epic's feature. The roll-up has a row per planning group,
    so a feature in several groups gives several rows; ``strict`` refuses that.
    Null keys never match."""
    on, beside = [("FEATURE_KEY", "FEATURE_ID")], [(fixed.SNAPSHOT, fixed.SNAPSHOT)] if by_snapshot else []
    if strict:
        assert_unique(agile, on + beside)
    return left_lookup(epics, agile, on, "_agile", spread_by=fixed.EPIC_KEY, beside=beside)


@dataclass
class SprintLookups:
    """Sprint range and current sprint, by snapshot and group and by group."""

    range_history: DataFrame
    range_current: DataFrame
    current_history: DataFrame
    current_current: DataFrame

    def check_unique(self) -> None:
        for lookup, on in (
            (self.range_history, fixed.SPRINT_GROUP),
            (self.current_history, fixed.SPRINT_GROUP),
            (self.range_current, [fixed.GROUP]),
            (self.current_current, [fixed.GROUP]),
        ):
            assert_unique(lookup, on)


def sprint_lookups(
    stories: DataFrame, snapshots: DataFrame, today: date, staged: bool = True,
    seen: dict[str, Observation] | None = None,
) -> SprintLookups:
    """All four lookups. History rows too are matched with the sprint containing
    ``today``, not their own snapshot date.

    Each story table is read once and combined before the shuffle to a summary of
    a few rows per group, which is staged. Its true size tells the planner whether
    the lookups may be broadcast; the tables they are joined to then stay put.
    With ``seen`` the distinct sprints are made first, and their names without a
    version are counted into it while the summaries are staged.
    """
    if seen is not None:
        snapshots, seen["dated sprints"] = observe_versions(sprint_windows(snapshots, fixed.SNAPSHOT))
        stories, seen["current sprints"] = observe_versions(sprint_windows(stories))
    keep = stage if staged else (lambda df, name: df)
    dated = keep(sprint_summary(snapshots, today), "sprints-history")
    plain = keep(sprint_summary(stories, today, [fixed.GROUP]), "sprints-current")
    return SprintLookups(
        summary_range(dated),
        summary_range(plain, [fixed.GROUP]),
        summary_current(dated),
        summary_current(plain, [fixed.GROUP]),
    )


def epic_columns(df: DataFrame, lookups: SprintLookups, as_of: datetime) -> DataFrame:
    """Derived columns, then Title Case names. The null snapshot date of current
    rows is kept: the release range depends on it."""
    now = now_literal(as_of)
    df = df.withColumns(
        {"LAST_UPDATED": now, "SNAPSHOT_DATE_ALT": F.coalesce(fixed.SNAPSHOT, now)}
    )
    df = fallback_lookup(
        df, lookups.range_history, lookups.range_current,
        fixed.SPRINT_GROUP, [fixed.GROUP], RANGE, spread_by=fixed.EPIC_KEY,
    )
    df = fallback_lookup(
        df, lookups.current_history, lookups.current_current,
        fixed.SPRINT_GROUP, [fixed.GROUP], CURRENT, spread_by=fixed.EPIC_KEY,
    )
    return rename_all(df, title_name)


def epics_marked(
    current: DataFrame,
    history: DataFrame,
    agile_now: DataFrame,
    agile_dated: DataFrame,
    lookups: SprintLookups,
    as_of: datetime,
    strict: bool = False,
    dates_from: DataFrame | None = None,
    known: list | None = None,
    staged: bool = False,
    estimated: bool = False,
) -> DataFrame:
    """The report with current rows still marked by a null snapshot date.

    ``history`` holds one row per epic and date and each roll-up one row per key
    and group, so joined history rows are distinct; so are joined current rows
    once the current rows are. No distinct over the union is needed. Current rows
    are read by the report, its copies and the release range; ``staged`` makes
    them distinct once for all three. ``estimated`` says that ``history`` holds the
    columns of ``agile_dated`` already (see :func:`epic_history`); then only the
    copies are joined to it. Feature keys must then be as ``coerce`` leaves them.
    """
    current = coerce(current, fixed.EPIC_TYPES).distinct()
    if staged:
        current = stage(current, "epics-current")
    # Dealt once to meet both roll-ups, before the copies are made of them.
    current = current.repartition(spread_key(F.col("FEATURE_KEY"), F.col(fixed.EPIC_KEY)))
    history = coerce(history, fixed.EPIC_TYPES)
    # History is dated by its key. A column that cannot be null says so to the planner,
    # which then drops this branch under a filter on the null date of current rows.
    day = to_date(F.col(fixed.SNAPSHOT))

    def dated(df: DataFrame) -> DataFrame:
        return df.where(day.isNotNull()).withColumn(fixed.SNAPSHOT, F.coalesce(day, today_literal(as_of)))

    if strict:
        lookups.check_unique()
    rows = join_agile(current, agile_now, by_snapshot=False, strict=strict)
    if estimated:
        copies = snapshot_copies(current, history, as_of, dates_from=dates_from, known=known)
        parts = [dated(history.withColumn(fixed.SYNTHETIC, F.lit(False)))]
        if copies is not None:
            parts.append(join_agile(dated(copies), agile_dated, by_snapshot=True, strict=strict))
    else:
        filled = fill_missing_snapshots(current, history, as_of, dates_from=dates_from, known=known)
        parts = [join_agile(dated(filled), agile_dated, by_snapshot=True, strict=strict)]
    for part in parts:
        rows = union_aligned(rows, part)
    return epic_columns(rows, lookups, as_of)


def _filled() -> Column:
    return F.coalesce("Snapshot Date", F.col("`Last Updated`").cast("date"))


def fill_snapshot(marked: DataFrame) -> DataFrame:
    """Date the current rows, once the release ranges have been derived."""
    return marked.withColumn("Snapshot Date", _filled())


def marked_releases(marked: DataFrame) -> DataFrame:
    """The release ranges of :func:`epics_marked`, joined where the roll-ups left its rows."""
    return release_range(marked, spread_by=title_name(fixed.EPIC_KEY))


class EpicsRun(NamedTuple):
    """The written tables, and counts by what was counted: rows and nulls of sprint
    names without a version, and of the columns the release range filters on."""

    epics: DataFrame
    releases: DataFrame
    diagnostics: dict[str, dict[str, int]]


@dataclass
class EpicsReport:
    """Sources, history and outputs of the report; sources as in
    :class:`snapledger.plans.stories.StoriesReport`. ``leaves_apart`` says that the
    epics of the issue tables are cheap to read by themselves, and need no copy."""

    stories: DataFrame
    story_snapshots: DataFrame
    issues: DataFrame
    issue_snapshots: DataFrame
    store: HistoryStore
    as_of: datetime
    leaves_apart: bool = False

    @staticmethod
    def store_at(spark, path: str) -> HistoryStore:
        return HistoryStore(spark, path, fixed.EPIC_KEY)

    def _leaves(self, issues: DataFrame) -> DataFrame | None:
        return issues if self.leaves_apart else None

    def update_history(self, force: bool = False) -> DataFrame:
        recent = recent_rows(self.issue_snapshots, self.as_of)
        return self.store.update(
            lambda: epic_history_unique(self.issue_snapshots, True, self._leaves(self.issue_snapshots)),
            lambda: epic_history_unique(recent, True, self._leaves(recent)),
            force,
        )

    def build(self, force: bool = False, strict: bool = False) -> tuple[DataFrame, DataFrame]:
        """(epics, release ranges). The release ranges need current rows only; the
        filter on the null snapshot date removes the history branch from their
        plan, so nothing has to be kept between the two tables."""
        marked = self._marked(self.update_history(force), self.story_snapshots, self._lookups(), strict)
        return fill_snapshot(marked), marked_releases(marked)

    def _lookups(self, seen: dict[str, Observation] | None = None) -> SprintLookups:
        return sprint_lookups(self.stories, self.story_snapshots, self.as_of.date(), seen=seen)

    def _marked(
        self, history: DataFrame, story_snapshots: DataFrame, lookups: SprintLookups, strict: bool
    ) -> DataFrame:
        return epics_marked(
            epic_current(self.issues, True, self._leaves(self.issues)),
            history,
            agile_current(self.stories),
            agile_history(story_snapshots),
            lookups,
            self.as_of,
            strict,
            known=self.store.days(),
            staged=True,
        )

    def run(
        self, epics_path: str, releases_path: str, force: bool = False, strict: bool = False
    ) -> EpicsRun:
        """Both tables written, and what was counted on the way: no pass of its own."""
        seen: dict = {}
        marked = self._marked(self.update_history(force), self.story_snapshots, self._lookups(seen), strict)
        epics, seen["report"] = self._counted(marked)
        return EpicsRun(
            write_report(epics, epics_path, "Snapshot Date"),
            write_report(marked_releases(marked), releases_path),
            _diagnostics(seen),
        )

    def _counted(self, marked: DataFrame, days: list | None = None) -> tuple[list[DataFrame], list[Observation]]:
        """The report in tables of some dates each, and what counts the nulls of each as it is written."""
        parts = by_groups(marked, _filled(), date_groups(self.store, self.as_of, days))
        seen = [Observation() for _ in parts]
        return [fill_snapshot(release_nulls(part, RELEASE_COLUMNS, one)) for part, one in zip(parts, seen)], seen

    def run_incremental(
        self, epics_path: str, releases_path: str, force: bool = False, strict: bool = False
    ) -> EpicsRun:
        """As :meth:`run`, but of the epics only the dates whose stored history,
        stories or sprints have changed since the last incremental version are
        read and written; see :mod:`snapledger.plans.incremental`. The release
        ranges, which have no dates, are always written. The diagnostics of the
        report count the rows written."""
        self.update_history(force)
        report = ReportFolder(self.store.spark, epics_path)
        seen: dict = {}
        lookups = self._lookups(seen)
        stories = self.story_snapshots.select(fixed.SNAPSHOT, *ROLLUP_COLUMNS)
        dated = [stories, lookups.range_history, lookups.current_history]
        changes = find_changes(
            report, self.store, self.as_of,
            [date_checksums(df, fixed.SNAPSHOT) for df in dated],
            [table_checksum(df) for df in (lookups.range_current, lookups.current_current)],
        )
        marked = None

        def build(days: list) -> list[DataFrame]:
            nonlocal marked
            snapshots = self.story_snapshots.where(to_date(F.col(fixed.SNAPSHOT)).isin(days))
            marked = self._marked(self.store.read(days), snapshots, lookups, strict)
            epics, seen["report"] = self._counted(marked, days)
            return epics

        epics = run_changes(report, changes, build)
        return EpicsRun(epics, write_report(marked_releases(marked), releases_path), _diagnostics(seen))


def _diagnostics(seen: dict[str, Observation | list[Observation]]) -> dict[str, dict[str, int]]:
    """The counts of each observation, or the sums of several, once their actions have run; warns of
    sprint names without a version."""
    for name in ("dated sprints", "current sprints"):
        warn_if_unparsed(seen[name])
    counts = {name: [one.get for one in (found if isinstance(found, list) else [found])] for name, found in seen.items()}
    return {name: {c: sum(part[c] for part in parts) for c in parts[0]} for name, parts in counts.items()}
