"""What is shuffled, and what of it stays on disk."""

import datetime as dt
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from catalog.queries import QUERIES
from snapledger import fixed
from snapledger.operators.joins import left_lookup
from snapledger.operators.merge import latest_per_key
from snapledger.plans import epics, incremental
from snapledger.session import CODEC, shuffles_dropped, stage
from snapledger.sources import history
from snapledger.sources.history import HistoryStore
from snapledger.sources.reports import ReportFolder

DAY, NEXT = dt.date(1998, 2, 2), dt.date(1998, 2, 9)
NAMES = ("SNAPSHOT_DATE date, ISSUE_KEY string, PARENT_KEY string, ISSUE_TYPE string, SUMMARY string, ESTIMATE double, "
         "OPEN_ESTIMATE double, SWAG double, PROGRAM_PRIORITY string, FIX_VERSION string")
REST = ("s", 1.0, 2.0, 3.0, "p", "26.1")


def dealt(df):
    return [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning" in x]


def shuffled(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in blocks.mkString("\n").split("\n") if "/shuffle_" in f}


@pytest.fixture
def joins_shuffled(settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")


def test_dates_beside_match_as_equal_keys_do(spark, joins_shuffled):
    days = [DAY, NEXT, None]
    left = spark.createDataFrame([(k, d, i) for i, (k, d) in enumerate((k, d) for k in ("a", "b", None) for d in days)], "k string, d date, id int")
    right = spark.createDataFrame([("a", DAY, 1), ("a", DAY, 2), ("a", None, 3), ("b", NEXT, 4), (None, DAY, 5), (None, None, 6)], "k string, d date, v int")
    for more in ({}, {"null_safe": True}):
        want = left_lookup(left, right, ["k", "d"], **more)
        got = left_lookup(left, right, ["k"], beside=["d"], **more)
        assert got.columns == want.columns and Counter(got.collect()) == Counter(want.collect())
        assert dealt(got) and not any("d#" in line.split("hashpartitioning")[1] for line in dealt(got))


def test_dated_items_are_dealt_by_key_alone(spark, joins_shuffled):
    rows = [(d, "e", "f", "Epic", *REST) for d in (DAY, DAY, NEXT, None)] + [(DAY, "e2", None, "Epic", *REST)]
    rows += [(DAY, "f", "c", "Feature", *REST), (NEXT, "f", None, "Feature", *REST), (None, "f", "c", "Feature", *REST)]
    rows += [(DAY, "c", None, "Sub-Capability", *REST)]
    agile = spark.createDataFrame([("f", DAY, 1.0), ("f", DAY, 2.0), ("f", None, 3.0)], "FEATURE_ID string, SNAPSHOT_DATE date, TOTAL double")
    got = epics.epic_history_unique(spark.createDataFrame(rows, NAMES), agile=agile)
    found = Counter(map(tuple, got.select("SNAPSHOT_DATE", "EPIC_KEY", "FEATURE_KEY", "SUBCAPABILITY_KEY", "TOTAL").collect()))
    assert found == {(DAY, "e", "f", "c", 1.0): 1, (DAY, "e", "f", "c", 2.0): 1, (NEXT, "e", "f", None, None): 1, (DAY, "e2", None, None, None): 1}
    assert dealt(got) and not any("__day" in x or "SNAPSHOT_DATE" in x for x in (line.split("hashpartitioning")[1] for line in dealt(got)))


def test_roll_ups_meet_epics_where_they_were_made(spark, joins_shuffled):
    """Roll-ups by date of stories dealt by feature are not dealt again by feature and date."""
    stories = spark.createDataFrame([("f", DAY, "g", 1.0, "Done", DAY, NEXT)] * 2, "FEATURE_ID string, SNAPSHOT_DATE date, "
                                    "PROGRAM_INCREMENT string, STORY_POINTS double, STATUS string, BEGIN_DATE date, END_DATE date")
    there = epics.agile_history(stories.repartition(8, "FEATURE_ID"))
    rows = spark.createDataFrame([("e", "f", DAY), ("e", "f", NEXT), ("e2", None, DAY)], "EPIC_KEY string, FEATURE_KEY string, SNAPSHOT_DATE date")
    got = epics.join_agile(rows, there, True, strict=True)
    assert len(dealt(got)) == 2
    assert {(r.EPIC_KEY, r.SNAPSHOT_DATE, r.TOTAL_ESTIMATE) for r in got.collect()} == {("e", DAY, 2.0), ("e", NEXT, None), ("e2", DAY, None)}


def test_latest_per_key_dealt_by_a_part_of_the_key(spark, joins_shuffled):
    df = spark.range(0, 300, 1, 4).selectExpr("if(id % 50 = 0, null, 'k' || id % 7) as k", "date'1998-02-02' + cast(id % 3 as int) as d", "id as v")
    whole, part = latest_per_key(df, ["k", "d"], "v"), latest_per_key(df, ["k", "d"], "v", dealt_by=["k"])
    assert Counter(part.collect()) == Counter(whole.collect()) and part.count() == 21
    assert len(dealt(part)) == 1 and "d#" not in dealt(part)[0].split("hashpartitioning")[1]


@pytest.mark.parametrize("kind", ["stage", "report", "divided report", "store"])
def test_a_write_leaves_no_shuffle_files(spark, tmp_path, kind):
    df = spark.range(1000).selectExpr("cast(id % 100 as string) as K", "id as v").groupBy("K").agg(F.sum("v").alias("v"))
    df = df.withColumn("SNAPSHOT_DATE", F.lit(DAY))
    before = shuffled(spark)
    if kind == "stage":
        back = stage(df, "t")
    elif kind == "store":
        back = HistoryStore(spark, str(tmp_path / "s"), "K").seed(df)
    else:
        back = ReportFolder(spark, str(tmp_path / "r")).replace(df, "SNAPSHOT_DATE" if "divided" in kind else None)
    until = time.time() + 10
    while shuffled(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled(spark) - before
    assert all(CODEC in file for file in back.inputFiles())
    assert back.count() == 100


def test_shuffles_are_dropped_inside_only(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with pytest.raises(RuntimeError), shuffles_dropped(spark):
        assert spark.conf.get(name) == "true"
        raise RuntimeError
    assert spark.conf.get(name, None) == before


def test_a_store_is_filled_with_one_shuffle(spark, tmp_path, joins_shuffled, monkeypatch):
    """Repeats are found where the rows were dealt to buckets."""
    made, write = [], history.write_bucketed
    monkeypatch.setattr(history, "write_bucketed", lambda df, *args, **more: made.append((df, more.get("arranged") or args[-1])) or write(df, *args, **more))
    store = HistoryStore(spark, str(tmp_path / "s"), "K", newest=("v",))
    rows = [("a", DAY, 1), ("a", DAY, 2), ("a", NEXT, 1), (None, DAY, 1), ("b", None, 1), ("b", DAY, 5)]
    df = spark.createDataFrame(rows, "K string, SNAPSHOT_DATE date, v int")
    assert Counter(map(tuple, store.seed(df).select("K", "SNAPSHOT_DATE", "v").collect())) == Counter([("a", DAY, 2), ("a", NEXT, 1), ("b", DAY, 5)])
    got = store.merge(df.withColumn("v", F.col("v") + 10).where("SNAPSHOT_DATE = '1998-02-02'"))
    assert Counter(map(tuple, got.select("K", "SNAPSHOT_DATE", "v").collect())) == Counter([("a", DAY, 12), ("a", NEXT, 1), ("b", DAY, 15)])
    assert all(arranged for _, arranged in made) and len(dealt(made[0][0])) == len(dealt(made[1][0])) == 1
    assert all(len(store.spark.read.parquet(f"{store.manifests.data}/{f}").inputFiles()) <= store.buckets for f in store.folders().values())


def test_dates_of_a_report_are_written_in_groups(spark, tmp_path, monkeypatch):
    """Whole dates of at most so many rows; every row is in one group, also of dates not foreseen and without a date."""
    store = HistoryStore(spark, str(tmp_path / "s"), "K")
    days = [DAY + dt.timedelta(days=7 * i) for i in range(4)]
    store.seed(spark.createDataFrame([(f"k{i}", d) for i in range(3) for d in days], "K string, SNAPSHOT_DATE date"))
    as_of = dt.datetime(1998, 3, 4)
    assert len(incremental.date_groups(store, as_of)) == 1
    monkeypatch.setattr(fixed, "ROWS_AT_A_TIME", 6)
    groups = incremental.date_groups(store, as_of)
    assert [d for group in groups for d in group] == [*days, dt.date(1998, 3, 2), as_of.date()] and set(map(len, groups)) == {2}
    assert incremental.date_groups(store, as_of, days[:1]) != groups
    df = spark.createDataFrame([(d, i) for i, d in enumerate([*days, as_of.date(), None, dt.date(1990, 1, 1)])], "d date, v int")
    parts = incremental.by_groups(df, F.col("d"), groups)
    assert sum((Counter(part.collect()) for part in parts), Counter()) == Counter(df.collect())
    report = ReportFolder(spark, str(tmp_path / "r"))
    assert Counter(report.replace(parts, "d").select("d", "v").collect()) == Counter(df.collect())
    assert len({folder.split("/")[0] for folder in report.last()[1]["parts"].values()}) == 3
    with pytest.raises(ValueError):
        report.replace([df, df], "d")


@pytest.mark.parametrize("name", ["stories_report_stored", "epics_report_incremental", "release_diagnostics"])
def test_reports_in_groups_are_the_reports(spark, sf, monkeypatch, name):
    # Each run states its own staging time in no column; all columns are compared.
    want = Counter(map(str, QUERIES[name](spark, sf).collect()))
    made, write = [], ReportFolder._write
    monkeypatch.setattr(ReportFolder, "_write", lambda self, df, column: made.append(column) or write(self, df, column))
    monkeypatch.setattr(fixed, "ROWS_AT_A_TIME", 12000)
    assert Counter(map(str, QUERIES[name](spark, sf).collect())) == want
    assert made.count("Snapshot Date") > 2
