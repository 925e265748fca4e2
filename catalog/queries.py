"""Registered queries: each takes (spark, folder of the given tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from catalog import inputs as I
from snapledger import fixed
from snapledger.functions import casting, dates, sprints as sprint_text, text
from snapledger.operators import (
    align, gapfill, hierarchy, joins, merge, profile, releases, sprints,
)
from snapledger.plans import epics, profiles, stories
from snapledger.plans.publish import open_workspace
from snapledger.session import new_path, stage
from snapledger.sources import files, sinks
from snapledger.sources.history import HistoryStore
from snapledger.sources.workspace import Workspace

QUERIES = {}

# What the stories of a query are dealt by: the columns it groups or joins them on.
KEY, FEATURE, SPRINT = ["ISSUE_KEY"], ["FEATURE_ID"], [fixed.GROUP, "SPRINT_NAME"]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# --- hierarchy -----------------------------------------------------------
# Each level of the items is a table of its own here, so the leaves can be read by
# themselves; the levels above are staged, which gives the planner their true sizes.
def _epics_current(spark, sf, agile=None):
    items = leaves = I.issue_current(spark, sf)
    if agile is not None:
        # Features with roll-ups stay where they were joined, so the epics alone are dealt to meet them.
        leaves = I.issue_current(spark, sf, dealt="lineitem")
    return epics.epic_current(items, staged=True, leaf_from=leaves, agile=agile)


def _epics_dated(spark, sf, recent=False, **options):
    items = I.issue_history(spark, sf)
    if recent:
        items = hierarchy.recent_rows(items, I.AS_OF)
    return epics.epic_history(items, staged=True, leaf_from=items, **options)


@query
def hierarchy_flatten_current(spark: SparkSession, sf: str) -> DataFrame:
    return _epics_current(spark, sf)


@query
def hierarchy_flatten_snapshots(spark, sf):
    return _epics_dated(spark, sf)


@query
def hierarchy_flatten_recent(spark, sf):
    return _epics_dated(spark, sf, recent=True)


# --- story and feature sources -------------------------------------------
@query
def story_current(spark, sf):
    return stories.story_current(I.story_source(spark, sf))


@query
def story_history_enriched(spark, sf):
    return stories.story_history(I.story_snapshots(spark, sf, KEY), I.story_source(spark, sf, KEY))


@query
def story_history_recent(spark, sf):
    recent = hierarchy.recent_rows(I.story_snapshots(spark, sf, KEY), I.AS_OF)
    return stories.story_history(recent, I.story_source(spark, sf, KEY))


@query
def feature_lookup(spark, sf):
    return stories.feature_lookup(I.issue_current(spark, sf), I.issue_history(spark, sf))


# --- roll-ups and sprints --------------------------------------------------
@query
def agile_rollup_current(spark, sf):
    return epics.agile_current(I.story_source(spark, sf, FEATURE))


@query
def agile_rollup_snapshots(spark, sf):
    return epics.agile_history(I.story_snapshots(spark, sf, FEATURE))


@query
def sprint_windows(spark, sf):
    return sprints.sprint_windows(I.story_snapshots(spark, sf, SPRINT), fixed.SNAPSHOT)


@query
def sprint_windows_current(spark, sf):
    return sprints.sprint_windows(I.story_source(spark, sf, SPRINT))


@query
def sprint_version_key(spark, sf):
    version = sprint_text.version_at_end(F.col("SPRINT_NAME"))
    rows = I.story_source(spark, sf).select(
        "ISSUE_KEY", "SPRINT_NAME",
        version.alias("SPRINT_VERSION"),
        sprint_text.version_anywhere(F.col("SPRINT_NAME")).alias("SPRINT_NAME_ALT"),
        sprint_text.increment_of(F.col("SPRINT_NAME")).alias("PI_FROM_SPRINT"),
    )
    rows = rows.withColumn("SORT_KEY", sprint_text.version_key(F.col("SPRINT_VERSION")))
    return rows.withColumn("VERSION_TEXT", sprint_text.key_version(F.col("SORT_KEY")))


@query
def sprint_range(spark, sf):
    return sprints.sprint_range(I.story_snapshots(spark, sf))


@query
def sprint_range_current(spark, sf):
    return sprints.sprint_range(I.story_source(spark, sf), [fixed.GROUP])


@query
def sprint_range_window(spark, sf):
    return sprints.with_sprint_range(sprint_windows(spark, sf))


@query
def current_sprint(spark, sf):
    return sprints.current_sprint(sprint_windows(spark, sf), I.TODAY)


@query
def current_sprint_group(spark, sf):
    return sprints.current_sprint(sprint_windows_current(spark, sf), I.TODAY, [fixed.GROUP])


# --- coercion and alignment ------------------------------------------------
@query
def coerce_columns(spark, sf):
    raw = I.table(spark, sf, "orders").selectExpr(
        "o_orderkey as ORDER_KEY",
        "chr(9) || ' ' || o_orderpriority || chr(160) || chr(10) as PRIORITY",
        """case o_orderkey % 5 when 0 then 'n/a' when 1 then o_custkey || '.5'
             when 2 then o_custkey || '.0f' when 3 then '-' || o_custkey || 'e1'
             else cast(o_custkey as string) end as AMOUNT""",
        """case o_orderkey % 4 when 0 then 'not a date' when 1 then cast(o_orderdate as string)
             else cast(cast(o_orderdate as date) as string) end as ORDERED""",
        "cast(o_orderdate as string) as SNAPSHOT_DATE",
        "null as NOTE",
    )
    typed = casting.coerce(
        casting.void_to_string(raw),
        {"PRIORITY": "string", "AMOUNT": "float", "ORDERED": "datetime",
         "NOTE": "string", "ABSENT": "float"},
    )
    return typed.withColumn(fixed.SNAPSHOT, casting.to_date(F.col(fixed.SNAPSHOT)))


@query
def align_union_distinct(spark, sf):
    orders = I.table(spark, sf, "orders")
    left = orders.selectExpr(
        "o_orderkey as ORDER_KEY", "cast(o_orderdate as date) as DAY",
        "o_custkey as CUSTOMER", "null as AMOUNT", "null as NOTE",
    )
    right = orders.selectExpr(
        "cast(o_orderkey as int) as ORDER_KEY", "o_orderdate as DAY",
        "cast(o_custkey as string) as CUSTOMER",
        "if(o_orderstatus = 'F', o_totalprice, null) as AMOUNT", "null as NOTE",
        "if(o_orderstatus = 'O', o_orderpriority, null) as PRIORITY",
    )
    return align.union_distinct(left, right)


# --- merge -----------------------------------------------------------------
@query
def latest_per_key(spark, sf):
    rows = I.story_snapshots(spark, sf, KEY).select(
        "ISSUE_KEY", "SNAPSHOT_DATE", "UPDATED", "STORY_POINTS", "SPRINT_NAME", "STATUS"
    )
    return merge.latest_per_key(rows, ["ISSUE_KEY", "SNAPSHOT_DATE"], "UPDATED")


@query
def without_refetched(spark, sf):
    return joins.without_keys(
        I.cached_history(spark, sf), I.recent_history(spark, sf), ["ISSUE_KEY", "SNAPSHOT_DATE"]
    )


@query
def snapshot_merge(spark, sf):
    return merge.merge_snapshots(
        I.cached_history(spark, sf), I.recent_history(spark, sf), "ISSUE_KEY"
    )


@query
def merge_retention(spark, sf):
    """Row counts the shrink guard compares."""
    before = I.cached_history(spark, sf).select(F.lit(0).alias("AFTER"))
    after = snapshot_merge(spark, sf).select(F.lit(1).alias("AFTER"))
    counts = before.unionByName(after).agg(
        F.count_if(F.col("AFTER") == 0).alias("ROWS_BEFORE"),
        F.count_if(F.col("AFTER") == 1).alias("ROWS_AFTER"),
    )
    return counts.withColumn(
        "ACCEPTED", F.col("ROWS_AFTER") >= F.col("ROWS_BEFORE") * fixed.MIN_RETENTION
    )


def _feature_store(spark) -> HistoryStore:
    return HistoryStore(spark, new_path(spark, "feature-history"), "ISSUE_KEY")


@query
def history_store_merge(spark, sf):
    """Seed, then a merge that brings a new column."""
    store = _feature_store(spark)
    store.seed(I.cached_history(spark, sf))
    return store.merge(I.recent_history(spark, sf))


@query
def history_store_refresh(spark, sf):
    """Seed, then a merge of the same columns: touched dates only are rewritten."""
    store = _feature_store(spark)
    store.seed(I.cached_history(spark, sf))
    return store.merge(I.recent_history(spark, sf).drop("SUMMARY"))


@query
def history_store_stats(spark, sf):
    """What the manifest states of each date after a seed and a merge."""
    store = _feature_store(spark)
    store.seed(I.cached_history(spark, sf))
    store.merge(I.recent_history(spark, sf))
    return store.stats()


# --- calendar and gaps -----------------------------------------------------
@query
def snapshot_calendar(spark, sf):
    """The last four Mondays up to each day that has events."""
    days = I.table(spark, sf, "events").select(F.col("ts").cast("date").alias("DAY"))
    return days.distinct().select(
        "DAY", F.explode(dates.snapshot_day_array(F.col("DAY"))).alias("SNAPSHOT_DATE")
    )


@query
def snapshot_gap_fill(spark, sf):
    columns = ["ISSUE_KEY", "PARENT_KEY", "ESTIMATE", "OPEN_ESTIMATE", "FIX_VERSION"]
    is_feature = F.col("ISSUE_TYPE") == fixed.FEATURE
    return gapfill.fill_missing_snapshots(
        I.issue_current(spark, sf).where(is_feature).select(*columns),
        I.issue_history(spark, sf).where(is_feature).select("SNAPSHOT_DATE", *columns),
        I.AS_OF,
    )


# --- joins -----------------------------------------------------------------
def _lookups(spark, sf) -> epics.SprintLookups:
    return epics.sprint_lookups(
        I.story_source(spark, sf), I.story_snapshots(spark, sf), I.TODAY
    )


@query
def fallback_lookup(spark, sf):
    found = _lookups(spark, sf)
    dated = I.story_snapshots(spark, sf).select("ISSUE_KEY", fixed.SNAPSHOT, fixed.GROUP)
    plain = I.story_source(spark, sf).select(
        "ISSUE_KEY", F.lit(None).cast("date").alias(fixed.SNAPSHOT), fixed.GROUP
    )
    return joins.fallback_lookup(
        dated.unionByName(plain), found.range_history, found.range_current,
        fixed.SPRINT_GROUP, [fixed.GROUP], epics.RANGE, spread_by="ISSUE_KEY",
    )


@query
def null_safe_lookup(spark, sf):
    columns = ["ISSUE_KEY", "FEATURE_ID", fixed.SNAPSHOT, "TARGET_START"]
    plain = I.story_source(spark, sf).withColumn(fixed.SNAPSHOT, F.lit(None).cast("date"))
    rows = plain.select(*columns).unionByName(I.story_snapshots(spark, sf).select(*columns))
    return stories.join_features(rows, feature_lookup(spark, sf), keys_from=rows, row="ISSUE_KEY")


@query
def agile_join_snapshots(spark, sf):
    return _epics_dated(spark, sf, agile=agile_rollup_snapshots(spark, sf))


@query
def agile_join_current(spark, sf):
    return _epics_current(spark, sf, agile=agile_rollup_current(spark, sf))


# --- derived columns and release range ---------------------------------------
@query
def story_columns(spark, sf):
    rows = story_current(spark, sf).unionByName(story_history_enriched(spark, sf))
    rows = rows.select(
        fixed.STORY_KEY, fixed.SNAPSHOT, "PROJECT_NAME", "FIX_VERSION", "SPRINT_NAME"
    )
    return stories.story_columns(rows, I.AS_OF)


@query
def epic_columns(spark, sf):
    plain = agile_join_current(spark, sf).withColumn(fixed.SNAPSHOT, F.lit(None).cast("date"))
    columns = [fixed.EPIC_KEY, "FEATURE_KEY", fixed.SNAPSHOT, fixed.GROUP, "TOTAL_ESTIMATE"]
    rows = plain.select(*columns).unionByName(agile_join_snapshots(spark, sf).select(*columns))
    return epics.epic_columns(rows, _lookups(spark, sf), I.AS_OF)


@query
def split_versions(spark, sf):
    rows = I.issue_current(spark, sf).where(F.col("ISSUE_TYPE") == fixed.FEATURE)
    return releases.explode_list(rows.select("ISSUE_KEY", "FIX_VERSION"), "FIX_VERSION")


@query
def release_range(spark, sf):
    flat = hierarchy_flatten_current(spark, sf)
    flat = flat.withColumn(fixed.SNAPSHOT, F.lit(None).cast("date"))
    return releases.release_range(flat.toDF(*map(text.title_name, flat.columns)))


def _counts(spark, counts: dict[str, int]) -> DataFrame:
    names = {"rows": "ROW_COUNT"}
    columns = [names.get(c, c.upper().replace(" ", "_")) for c in counts]
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in columns))


@query
def release_null_counts(spark, sf):
    """Nulls in the columns the release range filters on, counted while the rows are staged."""
    seen = Observation()
    flat = hierarchy_flatten_snapshots(spark, sf)
    stage(releases.release_nulls(flat, [fixed.SNAPSHOT, "FEATURE_KEY", "SUBCAPABILITY_KEY"], seen), "flat")
    return _counts(spark, seen.get)


@query
def sprint_null_rate(spark, sf):
    """Sprints without a version among all distinct ones, counted while they are staged."""
    found = []
    for name, windows in (("dated", sprint_windows(spark, sf)), ("current", sprint_windows_current(spark, sf))):
        rows, seen = sprints.observe_versions(windows)
        stage(rows, "sprints")
        warned = sprints.warn_if_unparsed(seen) > fixed.NULL_RATE_WARNING
        found.append((name, seen.get["rows"], seen.get["nulls"], warned))
    return spark.createDataFrame(found, "SPRINTS string, ROW_COUNT long, NULLS long, WARNED boolean")


# --- profile, SQL, files -----------------------------------------------------
@query
def table_profile(spark, sf):
    return profile.profile(I.table(spark, sf, "orders"))


@query
def table_profile_events(spark, sf):
    return profile.profile(I.table(spark, sf, "events"))


@query
def table_profile_documents(spark, sf):
    return profile.profile(I.table(spark, sf, "documents"))


@query
def table_profile_stories(spark, sf):
    return profile.profile(I.story_snapshots(spark, sf).drop("N", "K"))


@query
def table_profile_total(spark, sf):
    return profile.profile_total(profile.profile(I.story_snapshots(spark, sf).drop("N", "K")))


@query
def table_profile_approx(spark, sf):
    return profile.profile(I.story_snapshots(spark, sf), exact=False)


@query
def profile_by_date(spark, sf):
    """The profile of a stored history from parts kept by date, after a merge that touched
    two of them, with how the estimated distinct counts compare with exact ones."""
    store, path = _feature_store(spark), new_path(spark, "profiles")
    store.seed(I.cached_history(spark, sf))
    profiles.update_profiles(store, path)
    store.merge(I.recent_history(spark, sf))
    near = profiles.stored_profile(store, path)
    exact = profile.profile(store.read()).select("COLUMN_NAME", F.col("UNIQUES").alias("EXACT"))
    error = F.abs(F.col("UNIQUES") - F.col("EXACT"))
    return near.join(exact, "COLUMN_NAME").select(
        "POSITION", "COLUMN_NAME", "DATA_TYPE", "ROW_COUNT", "NULLS", "NULL_PCT",
        F.col("EXACT").alias("UNIQUES"), (error <= F.greatest(F.lit(1.0), 0.05 * F.col("EXACT"))).alias("CLOSE"),
        "MIN_VALUE", "MAX_VALUE",
    )


@query
def csv_inferred(spark, sf):
    """A CSV file whose types are inferred on loading."""
    path = new_path(spark, "inferred") + ".csv"
    sinks.export(I.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), "csv", path)
    workspace = Workspace(spark)
    workspace.load([path], ["typed"])
    return workspace.table("typed").select(
        F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_totalprice", "o_orderpriority"
    )


@query
def sample_facts(spark, sf):
    """What holds of any sample without replacement: its size, that no row is drawn
    twice, and that every row is one of the table."""
    events = I.table(spark, sf, "events")
    drawn = Workspace(spark, {"events": events}).sample("events", 50, seed=7)
    drawn = drawn.join(events.groupBy("event_id").agg(F.max("user_id").alias("found")), "event_id", "left")
    return drawn.agg(
        F.count(F.lit(1)).alias("ROW_COUNT"), F.count_distinct("event_id").alias("DIFFERENT"),
        F.count_if(F.col("found") == F.col("user_id")).alias("FOUND"),
    )


@query
def profile_estimate_facts(spark, sf):
    """The estimated profile against the exact one: counts equal, distinct counts within 10 %."""
    stories_ = I.story_snapshots(spark, sf).drop("N", "K")
    near = profile.profile(stories_, exact=False)
    exact = profile.profile(stories_).select("COLUMN_NAME", F.col("UNIQUES").alias("EXACT"))
    error = F.abs(F.col("UNIQUES") - F.col("EXACT"))
    return near.join(exact, "COLUMN_NAME").select(
        "COLUMN_NAME", "ROW_COUNT", "NULLS", F.col("EXACT").alias("UNIQUES"),
        (error <= F.greatest(F.lit(2.0), 0.1 * F.col("EXACT"))).alias("CLOSE"), "MIN_VALUE", "MAX_VALUE",
    )


@query
def adhoc_sql(spark, sf):
    workspace = Workspace(
        spark,
        {
            "stories": story_current(spark, sf),
            "features": I.issue_current(spark, sf).where("ISSUE_TYPE = 'Feature'"),
        },
    )
    return workspace.sql(
        """
        SELECT f.PROGRAM_PRIORITY, s.STORY_TYPE, count(*) AS STORY_COUNT,
               sum(s.ESTIMATE) AS POINTS, min(s.BEGIN_DATE) AS FIRST_BEGIN
        FROM stories s JOIN features f ON s.FEATURE_ID = f.ISSUE_KEY
        WHERE s.STATUS = :status
        GROUP BY f.PROGRAM_PRIORITY, s.STORY_TYPE
        ORDER BY POINTS DESC;
        """,
        {"status": "Done"},
    )


@query
def adhoc_top(spark, sf):
    workspace = Workspace(spark, {"stories": story_current(spark, sf)})
    return workspace.show(
        workspace.sql(
            """SELECT FEATURE_ID, sum(ESTIMATE) AS POINTS, count(*) AS STORY_COUNT
               FROM stories GROUP BY FEATURE_ID ORDER BY POINTS DESC, FEATURE_ID"""
        )
    )


@query
def save_and_requery(spark, sf):
    workspace = Workspace(spark, {"stories": story_current(spark, sf)})
    workspace.sql("SELECT TEAM_NAME, STATUS, sum(ESTIMATE) AS POINTS FROM stories GROUP BY ALL")
    workspace.save("team_points")
    return workspace.sql(
        "SELECT TEAM_NAME, max(POINTS) AS MOST, count(*) AS STATES FROM team_points GROUP BY TEAM_NAME"
    )


@query
def random_sample(spark, sf):
    return Workspace(spark, {"events": I.table(spark, sf, "events")}).sample("events", 50, seed=7)


@query
def table_schema(spark, sf):
    return Workspace(spark, {"events": I.table(spark, sf, "events")}).schema("events")


@query
def folder_tables(spark, sf):
    """Every table file of the folder with its row and column count."""
    workspace = Workspace(spark)
    workspace.load_folder(sf)
    return workspace.tables()


@query
def table_count(spark, sf):
    return Workspace(spark, {"lineitem": I.table(spark, sf, "lineitem")}).count("lineitem")


@query
def csv_round_trip(spark, sf):
    path = new_path(spark, "export") + ".csv"
    rollup = agile_rollup_current(spark, sf)
    sinks.export(rollup, "csv", path)
    return files.read_file(spark, path, rollup.schema)


@query
def parquet_round_trip(spark, sf):
    path = new_path(spark, "export") + ".parquet"
    sinks.export(agile_rollup_snapshots(spark, sf), "parquet", path)
    return files.read_file(spark, path)


# --- report tables -----------------------------------------------------------
@query
def stories_table(spark, sf):
    source, snapshots = I.story_source(spark, sf, KEY), I.story_snapshots(spark, sf, KEY)
    return stories.stories_table(
        stories.story_current(source),
        stories.story_history_unique(snapshots, source),
        feature_lookup(spark, sf),
        I.AS_OF,
        dates_from=snapshots.where("ISSUE_KEY is not null"),
        staged=True,
    )


def _epics_marked(spark, sf):
    snapshots, agile = I.issue_history(spark, sf), agile_rollup_snapshots(spark, sf)
    return epics.epics_marked(
        hierarchy_flatten_current(spark, sf),
        _epics_dated(spark, sf, unique=True, agile=agile),
        agile_rollup_current(spark, sf),
        agile,
        _lookups(spark, sf),
        I.AS_OF,
        dates_from=snapshots.where("ISSUE_TYPE = 'Epic' and ISSUE_KEY is not null"),
        staged=True,
        estimated=True,
    )


@query
def epics_table(spark, sf):
    return epics.fill_snapshot(_epics_marked(spark, sf))


@query
def epics_release_range(spark, sf):
    return epics.marked_releases(_epics_marked(spark, sf))


@query
def stories_report_stored(spark, sf):
    """The report through its store: seed, merge of the recent window, output."""
    report = stories.StoriesReport(
        I.story_source(spark, sf, KEY), I.story_snapshots(spark, sf, KEY),
        I.issue_current(spark, sf), I.issue_history(spark, sf),
        stories.StoriesReport.store_at(spark, new_path(spark, "story-history")),
        I.AS_OF,
    )
    report.update_history()
    return report.run(new_path(spark, "stories"))


@query
def epics_report_stored(spark, sf):
    report = epics.EpicsReport(
        I.story_source(spark, sf, FEATURE), I.story_snapshots(spark, sf, FEATURE),
        I.issue_current(spark, sf), I.issue_history(spark, sf),
        epics.EpicsReport.store_at(spark, new_path(spark, "epic-history")),
        I.AS_OF, leaves_apart=True,
    )
    report.update_history()
    return report.run(new_path(spark, "epics"), new_path(spark, "releases"))[0]


@query
def release_diagnostics(spark, sf):
    """What a run of the report counts while it is written."""
    report = epics.EpicsReport(
        I.story_source(spark, sf, FEATURE), I.story_snapshots(spark, sf, FEATURE),
        I.issue_current(spark, sf), I.issue_history(spark, sf),
        epics.EpicsReport.store_at(spark, new_path(spark, "epic-history")), I.AS_OF,
        leaves_apart=True,
    )
    run = report.run(new_path(spark, "epics"), new_path(spark, "releases"))
    return _counts(spark, run.diagnostics["report"])


@query
def stories_report_incremental(spark, sf):
    """A first version over an older history, then an incremental run after a merge."""
    source, snapshots = I.story_source(spark, sf, KEY), I.story_snapshots(spark, sf, KEY)
    issues, dated = I.issue_current(spark, sf), I.issue_history(spark, sf)
    store = stories.StoriesReport.store_at(spark, new_path(spark, "story-history"))
    output = new_path(spark, "stories")
    stories.StoriesReport(source, I.stale(snapshots, "STATUS", "'Open'"), issues, dated, store, I.AS_OF).run_incremental(output)
    return stories.StoriesReport(source, snapshots, issues, dated, store, I.AS_OF).run_incremental(output)


@query
def epics_report_incremental(spark, sf):
    """A first version over an older history, then an incremental run after a merge."""
    source, snapshots = I.story_source(spark, sf, FEATURE), I.story_snapshots(spark, sf, FEATURE)
    issues, dated = I.issue_current(spark, sf), I.issue_history(spark, sf)
    store = epics.EpicsReport.store_at(spark, new_path(spark, "epic-history"))
    paths = new_path(spark, "epics"), new_path(spark, "releases")
    older = I.stale(dated, "OPEN_ESTIMATE", "OPEN_ESTIMATE + 1.0D")
    epics.EpicsReport(source, snapshots, issues, older, store, I.AS_OF, True).run_incremental(*paths)
    return epics.EpicsReport(source, snapshots, issues, dated, store, I.AS_OF, True).run_incremental(*paths).epics


@query
def published_tables(spark, sf):
    """SQL over the published report and its stored history."""
    store = _feature_store(spark)
    store.seed(I.cached_history(spark, sf))
    workspace = open_workspace(
        spark, {"stories": story_current(spark, sf)}, {"features": store}
    )
    return workspace.sql(
        """SELECT h.SNAPSHOT_DATE, count(*) AS FEATURES, count(s.FEATURE_ID) AS WITH_STORIES
           FROM features_history h
           LEFT JOIN (SELECT DISTINCT FEATURE_ID FROM stories) s ON s.FEATURE_ID = h.ISSUE_KEY
           GROUP BY h.SNAPSHOT_DATE"""
    )
