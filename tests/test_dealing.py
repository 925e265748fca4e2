"""What is dealt, staged and written, and how often."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from catalog import inputs as I
from catalog.queries import QUERIES
from snapledger import fixed
from snapledger.functions import text
from snapledger.operators import gapfill, hierarchy, profile, releases, sprints
from snapledger.plans import epics
from snapledger.session import open_files, stage
from snapledger.sources.reports import ReportFolder

DAY, NEXT = dt.date(1998, 2, 2), dt.date(1998, 2, 9)
ITEMS = ("SNAPSHOT_DATE date, ISSUE_KEY string, PARENT_KEY string, ISSUE_TYPE string, SUMMARY string, ESTIMATE double, "
         "OPEN_ESTIMATE double, SWAG double, PROGRAM_PRIORITY string, FIX_VERSION string")
REST = ("s", 1.0, 2.0, 3.0, "p", "26.1")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def items(spark):
    """Missing, null and repeated keys, and dates that differ between the levels."""
    rows = [(d, "e1", "f", "Epic", *REST) for d in (DAY, DAY, NEXT)]
    rows += [(DAY, "e2", None, "Epic", *REST), (DAY, "e3", "gone", "Epic", *REST), (None, "e4", "f", "Epic", *REST)]
    rows += [(DAY, "f", "c", "Feature", *REST), (DAY, "f", None, "Feature", *REST), (DAY, None, "c", "Feature", *REST)]
    rows += [(DAY, "c", None, "Sub-Capability", *REST), (NEXT, "e5", "f2", "Epic", *REST), (NEXT, "f2", "c", "Feature", *REST)]
    return spark.createDataFrame(rows, ITEMS)


@pytest.fixture
def agile(spark):
    rows = [("f", DAY, "PI 1"), ("f", DAY, "PI 2"), ("f", NEXT, "PI 1"), (None, DAY, "PI 1"), ("f2", None, "PI 1"), ("gone", DAY, "x")]
    df = spark.createDataFrame(rows, "FEATURE_ID string, SNAPSHOT_DATE date, PROGRAM_INCREMENT string")
    return df.withColumn("TOTAL_ESTIMATE", F.lit(5.0))


@pytest.mark.parametrize("name", ["agile_rollup_snapshots", "latest_per_key", "sprint_windows"])
def test_stories_are_dealt_once(spark, sf, name):
    """Before the dates multiply them, by what the query groups on: given columns only."""
    text = plan(QUERIES[name](spark, sf))
    assert text.count("Exchange hashpartitioning") == 1 and "RoundRobin" not in text
    assert "Generate" in text.split("Exchange")[0]


def test_history_and_stories_meet_where_they_were_dealt(spark, sf, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(QUERIES["story_history_enriched"](spark, sf))
    assert text.count("Exchange hashpartitioning") == 2 and "RoundRobin" not in text


@pytest.mark.parametrize("name", ["agile_join_current", "story_columns", "align_union_distinct"])
def test_tables_of_one_row_group_are_dealt_by_their_key(spark, sf, name):
    """Not in turn, for which Spark sorts the rows of every task first."""
    text = plan(QUERIES[name](spark, sf))
    assert "RoundRobin" not in text and "REPARTITION_BY_NUM" in text


def test_epics_are_dealt_once_by_what_they_meet_features_on(spark, sf, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(QUERIES["agile_join_current"](spark, sf))
    assert text.count("REPARTITION_BY_NUM") == 2
    # Three levels meet theirs on both sides; the fourth, features, is dealt anew for its roll-ups.
    assert text.count("ENSURE_REQUIREMENTS") == 3 * 2 + 1


def test_spread_tables_keep_every_row_and_fill_all_tasks(spark, sf):
    for name in I.SPREAD:
        got, given = I.table(spark, sf, name), spark.read.parquet(f"{sf}/{name}.parquet")
        assert Counter(got.collect()) == Counter(given.collect())
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) < 2 * min(sizes)


def test_leaves_read_apart_are_not_staged(spark, items, monkeypatch):
    made = []
    monkeypatch.setattr(hierarchy, "stage", lambda df, *args, **more: made.append(df) or stage(df, *args, **more))
    for unique in (False, True):
        apart = epics.epic_history(items, staged=True, leaf_from=items, unique=unique)
        assert made.pop().where("ISSUE_TYPE = 'Epic'").isEmpty()
        assert Counter(apart.collect()) == Counter(epics.epic_history(items, unique=unique).collect())


def test_estimates_join_to_features_as_to_epics(items, agile):
    for staged in (False, True):
        for unique in (False, True):
            whole = epics.join_agile(epics.epic_history(items, unique=unique), agile, True)
            early = epics.epic_history(items, staged, agile=agile, unique=unique)
            assert early.columns == whole.columns
            assert Counter(early.collect()) == Counter(whole.collect())
    current, now = items.drop("SNAPSHOT_DATE"), agile.drop("SNAPSHOT_DATE")
    want = epics.join_agile(epics.epic_current(current), now, False)
    assert Counter(epics.epic_current(current, agile=now).collect()) == Counter(want.collect())


def test_epics_are_dealt_by_their_parent_only(spark, sf, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(QUERIES["agile_join_snapshots"](spark, sf))
    dealt = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert not any("FEATURE_KEY" in line for line in dealt)
    assert text.count("SortMergeJoin") == 5


def test_copies_alone_are_what_filling_adds(spark):
    now = spark.createDataFrame([("a", 1.0)], "EPIC_KEY string, V double")
    held = spark.createDataFrame([("a", I.TODAY - dt.timedelta(days=16), 2.0)], "EPIC_KEY string, SNAPSHOT_DATE date, V double")
    copies = gapfill.snapshot_copies(now, held, I.AS_OF)
    columns = ["EPIC_KEY", fixed.SNAPSHOT, "V", fixed.SYNTHETIC]
    whole = gapfill.fill_missing_snapshots(now, held, I.AS_OF).select(columns)
    assert Counter(copies.select(columns).collect()) == Counter(whole.where(fixed.SYNTHETIC).collect())


def test_parts_of_a_report_are_written_where_their_rows_are(spark, tmp_path, monkeypatch):
    """No exchange: as many files of a value as tasks that hold it."""
    df = spark.range(0, 400, 1, 4).selectExpr("id", "id % 3 as PART")
    back = ReportFolder(spark, str(tmp_path / "r")).replace(df, "PART")
    assert Counter(back.collect()) == Counter(df.collect())
    assert len(back.inputFiles()) == 12


def test_open_files_is_set_for_one_write_only(spark):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    with pytest.raises(RuntimeError), open_files(spark):
        assert spark.conf.get(name) == "64"
        raise RuntimeError
    assert spark.conf.get(name, None) == before


def test_estimated_counts_of_many_columns_are_all_near(spark):
    """Errors of 5 % a column leave one of sixty columns beyond a tenth."""
    df = spark.range(20000).select(*[F.xxhash64(F.lit(k), "id").alias(f"c{k}") for k in range(60)])
    for rows, n in ((df, 20000), (df.where("c0 is null"), 0)):
        found = [r.UNIQUES for r in profile.profile(rows, exact=False).collect()]
        assert len(found) == 60 and all(abs(u - n) <= 0.1 * n for u in found)


@pytest.mark.parametrize("made", [
    lambda df: sprints.sprint_range(df, ["G"]), lambda df: sprints.sprint_summary(df, DAY, ["G"]).drop("INSIDE", "CURRENT_SPRINT"),
])
def test_sprint_names_are_matched_once_a_row(spark, made):
    """Not once for each part of the version."""
    rows = [("a", n, DAY, DAY) for n in ("T 26.1.IP", "T 26.2.3", "T 26.1.12 ", "none", None)] + [("b", None, None, None)]
    got = made(spark.createDataFrame(rows, "G string, SPRINT_NAME string, BEGIN_DATE date, END_DATE date"))
    assert plan(got).count(f"{fixed.SPRINT_AT_END}, 1)") == 1


def test_sprint_summary_keys(spark):
    rows = [("a", n, DAY, NEXT) for n in ("T 26.1.IP", "T 26.2.3", "none", None)] + [("b", None, None, None)]
    df = spark.createDataFrame(rows, "G string, SPRINT_NAME string, BEGIN_DATE date, END_DATE date")
    want = {("a", True, "26.1.IP", 260199, 260199), ("a", True, "26.2.3", 260203, 260203), ("a", True, None, 0, 0), ("b", False, None, 0, 0)}
    assert set(map(tuple, sprints.sprint_summary(df, DAY, ["G"]).collect())) == want


MIXED = ("a string, b long, c double, d date, e array<int>, f binary", [
    ("", 0, 0.0, DAY, [1], b"x"), ("x", 0, -0.0, NEXT, [1], b"x"), ("x", -1, float("nan"), None, [1, None], b""),
    (None, None, float("nan"), DAY, None, None), ("x ", 1, None, DAY, [], b"x"),
])


def test_cells_of_a_distinct_count_are_plain_columns(spark):
    """No struct is made of a cell; texts are hashed after the unpivot, once for all columns."""
    df = spark.createDataFrame(MIXED[1], MIXED[0])
    text = plan(profile._exact_uniques(df.drop("e")))
    assert "named_struct" not in text and "struct(" not in text
    got = {r[0]: r.UNIQUES for r in profile._exact_uniques(df).collect()}
    assert got == {0: 4, 1: 4, 2: 3, 3: 3, 4: 4, 5: 3}


def test_sketches_are_given_hashes_that_are_ready(spark):
    df = spark.createDataFrame(MIXED[1], MIXED[0])
    for made in (profile.profile(df, exact=False), profile.profile_parts(df, "d").drop("POSITION")):
        lines = [line for line in plan(made).splitlines() if "partial_hll_sketch_agg" in line]
        assert lines and not any("xxhash64" in line for line in lines)
    found = [(r.NULLS, r.UNIQUES) for r in profile.profile(df, exact=False).collect()]
    assert found == [(1, 4), (1, 4), (1, 3), (1, 3), (1, 4), (1, 3)]


def test_release_ranges_are_joined_where_roll_ups_left_the_rows(items, agile, settings):
    """The rows that roll-ups have multiplied are not dealt by feature once more."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    current, now = items.drop("SNAPSHOT_DATE"), agile.drop("SNAPSHOT_DATE")
    rows = epics.join_agile(epics.epic_current(current).distinct(), now, False)
    rows = rows.withColumn(fixed.SNAPSHOT, F.lit(None).cast("date"))
    rows = rows.toDF(*map(text.title_name, rows.columns))
    again, there = releases.release_range(rows), epics.marked_releases(rows)
    assert plan(there).count("Exchange hashpartitioning") == plan(again).count("Exchange hashpartitioning") - 1
    assert there.count() > 0 and Counter(there.collect()) == Counter(again.collect())
