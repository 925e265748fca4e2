import datetime as dt
from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from catalog import inputs as I
from snapledger.operators.merge import ShrinkError
from snapledger.operators import profile
from snapledger.plans import epics, profiles, stories
from snapledger.plans.publish import open_workspace
from snapledger.sources import files, sinks
from snapledger.sources.history import HistoryStore
from snapledger.sources.jdbc import JdbcSource, Split
from snapledger.sources.manifest import ConflictError, ManifestFolder
from snapledger.sources.reports import ReportFolder
from snapledger.sources.workspace import Workspace

OLD, MID, NEW = dt.date(1998, 1, 5), dt.date(1998, 2, 2), dt.date(1998, 2, 9)
SCHEMA = "K string, SNAPSHOT_DATE date, V int, UPDATED int"


def snaps(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture
def store(spark, tmp_path):
    return HistoryStore(spark, str(tmp_path / "history"), "K", newest=("UPDATED",))


# --- history store -----------------------------------------------------------
def test_empty_store(store):
    assert store.read() is None


def test_seed_keeps_one_row_per_key(spark, store):
    got = store.seed(snaps(spark, [("a", OLD, 1, 1), ("a", OLD, 2, 2), (None, OLD, 1, 1), ("a", None, 1, 1)]))
    assert rows(got.select("K", "SNAPSHOT_DATE", "V", "UPDATED")) == Counter([("a", OLD, 2, 2)])
    assert dict(got.dtypes)["SNAPSHOT_DATE"] == "date"


def test_update_seeds_then_merges_and_is_idempotent(spark, store, tmp_path):
    full = lambda: snaps(spark, [("a", OLD, 1, 1), ("a", MID, 1, 1), ("b", MID, 1, 1)])
    recent = lambda: snaps(spark, [("a", MID, 7, 2), ("c", NEW, 7, 1)])
    unread = lambda: pytest.fail("not to be read")
    assert store.update(full, unread).count() == 3
    old_folder = store.folders()["1998-01-05"]
    want = Counter([("a", OLD, 1, 1), ("a", MID, 7, 2), ("b", MID, 1, 1), ("c", NEW, 7, 1)])
    for _ in range(2):
        got = store.update(unread, recent)
        assert rows(got.select("K", "SNAPSHOT_DATE", "V", "UPDATED")) == want
    # The date that was not refetched keeps its files.
    assert store.folders()["1998-01-05"] == old_folder


def test_new_column_leaves_other_dates_alone(spark, store):
    store.seed(snaps(spark, [("a", OLD, 1, 1)]))
    folder = store.folders()["1998-01-05"]
    got = store.merge(snaps(spark, [("b", NEW, 1, 1, "x")], SCHEMA + ", EXTRA string"))
    assert rows(got.select("K", "SNAPSHOT_DATE", "EXTRA")) == Counter([("a", OLD, None), ("b", NEW, "x")])
    assert store.folders()["1998-01-05"] == folder
    wider = store.merge(snaps(spark, [("c", NEW, 2.5, 1)], "K string, SNAPSHOT_DATE date, V double, UPDATED int"))
    assert dict(wider.dtypes)["V"] == "double" and wider.count() == 3
    assert store.folders()["1998-01-05"] != folder


def test_success_markers_are_not_needed(spark, store, settings):
    spark.sparkContext._jsc.hadoopConfiguration().set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        store.update(lambda: snaps(spark, [("a", OLD, 1, 1)]), None)
        store.update(lambda: pytest.fail("not to be read"), lambda: snaps(spark, [("b", NEW, 1, 1)]))
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert store.read().count() == 2


def test_a_merge_that_dies_before_the_manifest_changes_nothing(spark, store, monkeypatch):
    store.seed(snaps(spark, [("a", OLD, 1, 1), ("a", MID, 1, 1)]))
    recent = snaps(spark, [("a", MID, 2, 2), ("b", MID, 2, 2)])

    def die(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(HistoryStore, "_commit", die)
        with pytest.raises(KeyboardInterrupt):
            store.merge(recent)
    columns = ["K", "SNAPSHOT_DATE", "V", "UPDATED"]
    assert rows(store.read().select(columns)) == Counter([("a", OLD, 1, 1), ("a", MID, 1, 1)])
    want = Counter([("a", OLD, 1, 1), ("a", MID, 2, 2), ("b", MID, 2, 2)])
    assert rows(store.merge(recent).select(columns)) == want


def test_a_source_that_lost_rows_takes_none_from_the_store(spark, store):
    store.seed(snaps(spark, [(f"k{i}", OLD, i, i) for i in range(100)]))
    fewer = snaps(spark, [("k1", OLD, 0, 0)])
    assert store.merge(fewer).count() == 100
    with pytest.raises(ShrinkError):
        store.seed(fewer)
    assert store.read().count() == 100
    assert store.seed(fewer, force=True).count() == 1
    store.clean(keep=1)
    assert store.read().count() == 1 and len(files.list_folder(spark, f"{store.path}/manifest")) == 1


def test_no_seed_over_data_without_a_manifest(spark, store):
    snaps(spark, [("a", OLD, 1, 1)]).write.parquet(f"{store.path}/data/BATCH=x")
    with pytest.raises(RuntimeError):
        store.update(lambda: snaps(spark, [("b", OLD, 1, 1)]), None)
    assert store.update(lambda: snaps(spark, [("b", OLD, 1, 1)]), None, force=True).count() == 1


def test_a_merge_reads_touched_dates_only_and_counts_nothing_else(spark, store, monkeypatch, settings):
    # Sizes as of large tables: the planner would broadcast the few rows here.
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    days = [dt.date(1998, 1, 5) + dt.timedelta(weeks=i) for i in range(6)]
    store.seed(snaps(spark, [(f"k{i}", d, i, 1) for i in range(20) for d in days]))
    assert {r.SNAPSHOT_DATE: (r.ROW_COUNT, r.LEAST_KEY, r.GREATEST_KEY) for r in store.stats().collect()} == {
        d: (20, "k0", "k9") for d in days
    }
    read = []
    real = HistoryStore._merged

    @contextmanager
    def spy(self, *args):
        with real(self, *args) as merged:
            read.append((sorted(f.split("SNAPSHOT_DATE=")[1][:10] for f in merged.inputFiles()), plan_of(merged)))
            yield merged

    monkeypatch.setattr(HistoryStore, "_merged", spy)
    monkeypatch.setattr(HistoryStore, "_read", lambda self, m, own=HistoryStore._read: own(self, m) if not m["dates"] else pytest.fail("history read"))
    monkeypatch.setattr(HistoryStore, "read", lambda self, *a: None)
    store.merge(snaps(spark, [("k1", days[-1], 9, 2), ("new", days[-1], 9, 2)]))
    (files_read, text), = read
    assert set(files_read) == {str(days[-1])}
    # Bucketed on both sides: the join moves no row.
    assert "LeftAnti" in text and "Exchange" not in text
    assert store.dates()[str(days[-1])]["rows"] == 21


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reads_by_date_and_key_leave_folders_out(spark, store):
    store.seed(snaps(spark, [("a", OLD, 1, 1), ("m", OLD, 1, 1), ("p", MID, 1, 1), ("z", MID, 1, 1)]))
    assert store.days() == [OLD, MID]
    assert {f.split("SNAPSHOT_DATE=")[1][:10] for f in store.read([MID]).inputFiles()} == {"1998-02-02"}
    assert store.read([MID]).count() == 2 and store.read([NEW]).count() == 0
    assert {f.split("SNAPSHOT_DATE=")[1][:10] for f in store.read(key="b").inputFiles()} == {"1998-01-05"}
    assert store.read(key="m").count() == 1 and store.read(key="zz").count() == 0


def between(monkeypatch, store, act):
    """Run ``act`` once, after the next write of the store and before its commit."""
    real = HistoryStore._write

    def write(self, *args):
        done = real(self, *args)
        monkeypatch.setattr(HistoryStore, "_write", real)
        act()
        return done

    monkeypatch.setattr(HistoryStore, "_write", write)


def test_two_writers_of_different_dates_both_win(spark, store, monkeypatch):
    store.seed(snaps(spark, [("a", OLD, 1, 1), ("a", MID, 1, 1)]))
    other = lambda: store.merge(snaps(spark, [("a", MID, 5, 2), ("b", MID, 5, 2)]))
    between(monkeypatch, store, other)
    got = store.merge(snaps(spark, [("c", NEW, 7, 1, "x")], SCHEMA + ", EXTRA string"))
    want = Counter([("a", OLD, 1, None), ("a", MID, 5, None), ("b", MID, 5, None), ("c", NEW, 7, "x")])
    assert rows(got.select("K", "SNAPSHOT_DATE", "V", "EXTRA")) == want
    assert len(store.manifests.numbers()) == 3


def test_two_writers_of_one_date_conflict(spark, store, monkeypatch):
    store.seed(snaps(spark, [("a", OLD, 1, 1), ("a", MID, 1, 1)]))
    other = lambda: store.merge(snaps(spark, [("b", MID, 5, 2)]))
    between(monkeypatch, store, other)
    with pytest.raises(ConflictError, match="1998-02-02"):
        store.merge(snaps(spark, [("c", MID, 7, 1)]))
    assert rows(store.read().select("K", "SNAPSHOT_DATE")) == Counter([("a", OLD), ("a", MID), ("b", MID)])
    # The loser's batch is gone.
    assert len(files.list_folder(spark, store.manifests.data)) == 2
    between(monkeypatch, store, lambda: store.merge(snaps(spark, [("d", NEW, 1, 1)])))
    with pytest.raises(ConflictError):
        store.seed(snaps(spark, [("a", OLD, 1, 1)]), force=True)


def test_two_first_seeds_conflict(spark, store, monkeypatch):
    between(monkeypatch, store, lambda: store.seed(snaps(spark, [("b", OLD, 1, 1)]), force=True))
    with pytest.raises(ConflictError):
        store.seed(snaps(spark, [("a", OLD, 1, 1)]))
    assert rows(store.read().select("K")) == Counter([("b",)])


def test_orphans_of_dead_jobs_are_removed_by_age(spark, store, monkeypatch):
    store.seed(snaps(spark, [("a", OLD, 1, 1), ("a", MID, 1, 1)]))

    def die(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(HistoryStore, "_commit", die)
        with pytest.raises(KeyboardInterrupt):
            store.merge(snaps(spark, [("a", MID, 2, 2)]))
    store.merge(snaps(spark, [("a", MID, 3, 3)]))
    batches = lambda: len(files.list_folder(spark, store.manifests.data))
    assert batches() == 3
    store.clean(keep=1)
    store.clean(keep=1, unnamed_before=dt.datetime(2000, 1, 1))
    assert batches() == 3
    store.clean(keep=1, unnamed_before=dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=1))
    assert batches() == 2
    assert rows(store.read().select("SNAPSHOT_DATE", "V")) == Counter([(OLD, 1), (MID, 3)])


def test_another_number_of_buckets_rewrites_the_store(spark, store):
    store.seed(snaps(spark, [("a", OLD, 1, 1), ("a", MID, 1, 1)]))
    other = HistoryStore(spark, store.path, "K", newest=("UPDATED",), buckets=3)
    got = other.merge(snaps(spark, [("b", MID, 2, 2)]))
    assert rows(got.select("K", "SNAPSHOT_DATE")) == Counter([("a", OLD), ("a", MID), ("b", MID)])
    assert other.manifests.last()[1]["buckets"] == 3
    assert other.merge(snaps(spark, [("c", MID, 2, 2)])).count() == 4


def test_guard_stops_before_anything_changes(spark, store):
    """Cached repeats collapse in the merge, here written past the seed."""
    many = snaps(spark, [(f"k{i % 50}", OLD, i, i) for i in range(100)])
    store._commit(-1, *store._write(many), None, 0.0)
    recent = snaps(spark, [(f"k{i}", OLD, 0, 0) for i in range(50)])
    with pytest.raises(ShrinkError):
        store.merge(recent)
    assert store.read().count() == 100
    assert store.merge(recent, force=True).count() == 50


def test_keys_that_differ_in_white_space_stay_two(spark, store):
    assert store.seed(snaps(spark, [("a", OLD, 1, 1), (" a", OLD, 2, 2)])).count() == 2


def test_merge_of_nothing(spark, store):
    store.seed(snaps(spark, [("a", OLD, 1, 1)]))
    assert store.merge(snaps(spark, [])).count() == 1


def test_required_columns(spark, store):
    with pytest.raises(KeyError):
        store.seed(spark.createDataFrame([("a",)], "K string"))


# --- reports end to end --------------------------------------------------------
def test_stories_report_run_twice(spark, sf, tmp_path):
    report = stories.StoriesReport(
        I.story_source(spark, sf), I.story_snapshots(spark, sf),
        I.issue_current(spark, sf), I.issue_history(spark, sf),
        stories.StoriesReport.store_at(spark, str(tmp_path / "h")), I.AS_OF,
    )
    first = report.run(str(tmp_path / "out"))
    n, columns = first.count(), first.columns
    second = report.run(str(tmp_path / "out"))
    assert (second.count(), second.columns) == (n, columns)
    assert columns[0] == "Story Number" and "Target Start Epics" in columns
    workspace = open_workspace(spark, {"stories": second}, {"stories": report.store})
    assert workspace.names == ["stories", "stories_history"]
    got = workspace.sql("select count(*) n from stories where `Is Synthetic`").first().n
    assert got > 0


def test_epics_report_run(spark, sf, tmp_path):
    report = epics.EpicsReport(
        I.story_source(spark, sf), I.story_snapshots(spark, sf),
        I.issue_current(spark, sf), I.issue_history(spark, sf),
        epics.EpicsReport.store_at(spark, str(tmp_path / "h")), I.AS_OF,
    )
    table, releases, seen = report.run(str(tmp_path / "e"), str(tmp_path / "r"))
    assert seen["report"]["rows"] == table.count() and seen["report"]["Snapshot Date"] > 0
    assert 0 < seen["dated sprints"]["nulls"] < seen["dated sprints"]["rows"]
    assert table.where("`Snapshot Date` is null").isEmpty()
    assert {"MIN_TARGET_RELEASE", "MAX_TARGET_RELEASE"} <= set(releases.columns)
    assert releases.where("SNAPSHOT_DATE is not null or FEATURE_KEY is null").isEmpty()
    with pytest.raises(ValueError):
        report.build(strict=True)


# --- report versions and incremental runs ----------------------------------------
def test_a_report_that_dies_while_written_leaves_the_old_one(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "r")
    frame = lambda v: spark.sql(f"select {v} as v, date'1998-02-02' as d union all select {v}, null")
    sinks.write_report(frame(1), path, "d")

    def die(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(ManifestFolder, "add", die)
        with pytest.raises(KeyboardInterrupt):
            sinks.write_report(frame(2), path, "d")
    with pytest.raises(Exception, match="dies"):
        sinks.write_report(frame(3).withColumn("x", F.raise_error(F.lit("dies")).cast("string")), path, "d")
    report = ReportFolder(spark, path)
    want = Counter([(1, dt.date(1998, 2, 2)), (1, None)])
    assert rows(report.read()) == want
    sinks.write_report(frame(4), path)
    assert rows(report.read(0)) == want and {r.v for r in report.read().collect()} == {4}
    report.clean(keep=1, unnamed_before=dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=1))
    assert report.versions() == [1] and len(files.list_folder(spark, report.manifests.data)) == 1
    assert report.read().count() == 2


def test_a_report_does_not_read_itself(spark, tmp_path):
    path = str(tmp_path / "r")
    back = sinks.write_report(spark.range(3).toDF("v"), path)
    with pytest.raises(ValueError, match="inputs"):
        sinks.write_report(back.where("v > 0"), path)
    assert back.count() == 3
    with pytest.raises(FileNotFoundError):
        ReportFolder(spark, str(tmp_path / "none")).read()
    with pytest.raises(ConflictError):
        ReportFolder(spark, path).replace(spark.range(1), base=-1)


def part_files(report):
    return {d: sorted(f) for d, f in {d: files.list_folder(report.spark, f"{report.manifests.data}/{f}") for d, f in report.last()[1]["parts"].items()}.items()}


@pytest.mark.parametrize("kind", ["stories", "epics"])
def test_incremental_run_rewrites_changed_dates_only(spark, sf, tmp_path, kind):
    source, snapshots = I.story_source(spark, sf), I.story_snapshots(spark, sf)
    issues, dated = I.issue_current(spark, sf), I.issue_history(spark, sf)
    plan = {"stories": stories.StoriesReport, "epics": epics.EpicsReport}[kind]
    store = plan.store_at(spark, str(tmp_path / "h"))
    paths = [str(tmp_path / "t"), str(tmp_path / "r")][: 1 if kind == "stories" else 2]

    def run(story_rows, issue_rows, how="run_incremental", at=store, where=paths):
        done = getattr(plan(source, story_rows, issues, issue_rows, at, I.AS_OF), how)(*where)
        return done if kind == "stories" else done.epics

    if kind == "stories":
        run(I.stale(snapshots, "STATUS", "'Open'"), dated)
    else:
        run(snapshots, I.stale(dated, "OPEN_ESTIMATE", "OPEN_ESTIMATE + 1.0D"))
    report = ReportFolder(spark, paths[0])
    first = part_files(report)
    got = run(snapshots, dated)
    second = part_files(report)
    untouched = ["1998-01-05", "1998-01-12", "1998-01-19", "1998-01-26"]
    assert all(first[d] == second[d] for d in untouched)
    assert all(first.get(d) != second[d] for d in ("1998-02-02", "1998-02-16", "1998-03-02", "1998-03-04"))
    # A later change of another input reaches its date alone.
    if kind == "stories":
        later = dated.withColumn("SWAG", F.expr("if(SNAPSHOT_DATE = date'1998-01-12', SWAG + 1, SWAG)"))
        again = run(snapshots, later)
    else:
        later = snapshots.withColumn("STORY_POINTS", F.expr("if(SNAPSHOT_DATE = date'1998-01-12', STORY_POINTS + 1, STORY_POINTS)"))
        again = run(later, dated)
    third = part_files(report)
    assert third["1998-01-12"] != second["1998-01-12"]
    assert all(second[d] == third[d] for d in untouched if d != "1998-01-12")
    other = plan.store_at(spark, str(tmp_path / "h2"))
    where = [p + "2" for p in paths]
    full = run(snapshots, later, "run", other, where) if kind == "stories" else run(later, dated, "run", other, where)
    assert again.exceptAll(full).isEmpty() and full.exceptAll(again).isEmpty()
    assert got.columns == full.columns


# --- files and sinks -----------------------------------------------------------
def test_folder_loading_order_and_names(spark, tmp_path):
    for name, value in (("a.parquet", 1), ("b.pq", 2), ("b.csv", 3)):
        df = spark.sql(f"select {value} as v, 'x' as s")
        (sinks.export_csv if name.endswith("csv") else sinks.export_parquet)(df, str(tmp_path / name))
    (tmp_path / "notes.txt").write_text("no table")
    tables = files.load_folder(spark, str(tmp_path))
    assert {n: df.first().v for n, df in tables.items()} == {"a": 1, "b": 3}
    assert files.read_file(spark, str(tmp_path / "notes.txt")) is None
    named = files.load_files(spark, [str(tmp_path / "a.parquet"), str(tmp_path / "b.pq")], ["one"])
    assert list(named) == ["one", "b"]
    typed = files.read_file(spark, str(tmp_path / "b.csv"), "v long, s string")
    assert typed.dtypes == [("v", "bigint"), ("s", "string")]


def test_void_columns_reach_no_sink(spark, tmp_path):
    df = spark.sql("select 1 as a, null as b")
    sinks.export(df, "csv", str(tmp_path / "x.csv"))
    back = sinks.write_report(df, str(tmp_path / "r"))
    assert back.dtypes == [("a", "int"), ("b", "string")]
    with pytest.raises(ValueError):
        sinks.export(df, "xlsx", str(tmp_path / "y"))


def test_report_keeps_types_and_order(spark, tmp_path):
    df = spark.sql("select 1 as `A b`, date'1998-02-02' as `Snapshot Date`, 'x' as c")
    for _ in range(2):
        back = sinks.write_report(df, str(tmp_path / "r"), "Snapshot Date")
    assert back.dtypes == df.dtypes and rows(back) == rows(df)


def test_one_large_date_is_written_as_several_files(spark, tmp_path, settings):
    settings(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    df = spark.range(0, 40000, 1, 8).selectExpr(
        "md5(id || '') as K", "if(id % 3 = 0, date'1998-02-02', date_add(date'1998-03-02', cast(id % 20 as int))) as SNAPSHOT_DATE"
    )
    store = HistoryStore(spark, str(tmp_path / "h"), "K")
    store.seed(df)
    hot = files.list_folder(spark, f"{store.path}/data/{store.folders()['1998-02-02']}")
    assert len([p for p in hot if p.endswith(".parquet")]) > 1


def test_jdbc_options():
    """Options only: no database is started for a test."""
    source = JdbcSource("jdbc:x:y", "(select 1) t", Split("D", "1998-01-01", "1998-03-01", 8), options={"fetchsize": "1000"})
    assert source.reader_options() == {
        "url": "jdbc:x:y", "dbtable": "(select 1) t", "preferTimestampNTZ": "true",
        "partitionColumn": "D", "lowerBound": "1998-01-01", "upperBound": "1998-03-01",
        "numPartitions": "8", "fetchsize": "1000",
    }
    assert "partitionColumn" not in JdbcSource("jdbc:x:y", "t").reader_options()


# --- workspace -----------------------------------------------------------------
def test_workspace(spark, tmp_path):
    ws = Workspace(spark, {"t": spark.range(7).selectExpr("id", "id % 2 as odd")})
    assert rows(ws.tables()) == Counter([("t", 7, 2)])
    assert rows(ws.schema("t")) == Counter([(0, "id", "bigint"), (1, "odd", "bigint")])
    assert ws.count("t").first().ROW_COUNT == 7
    assert {r.COLUMN_NAME: r.UNIQUES for r in ws.describe("t").collect()} == {"id": 7, "odd": 2}
    assert ws.sample("t", 3).count() == 3
    ws.sql("select odd, count(*) as n from t where id >= :low group by odd ;", {"low": 2})
    ws.save("counts")
    assert ws.sql("select sum(n) as s from counts").first().s == 5
    ws.export("csv", str(tmp_path / "c.csv"))
    assert ws.load([str(tmp_path / "c.csv")]) == ["c"] and ws.table("c").first().s == 5
    with pytest.raises(KeyError, match="available: t, counts, c"):
        ws.table("missing")


def test_saved_results_keep_their_rows(spark, tmp_path):
    source = str(tmp_path / "t.parquet")
    spark.range(5).toDF("v").write.parquet(source)
    with Workspace(spark) as ws:
        ws.load([source])
        ws.sql("select sum(v) as s, null as nothing from t")
        ws.save("total")
        spark.range(100).toDF("v").write.mode("overwrite").parquet(source)
        assert ws.sql("select s from total").first().s == 10
        doubled = ws.sql("select 2 * s as s from total")
        ws.save("total")
        assert ws.sql("select s from total").first().s == 20 and doubled.first().s == 20
        folders = [d._staged_at for ds in ws.saved.values() for d in ds]
        assert len(folders) == 2 and all(files.path_exists(spark, f) for f in folders)
        ws.save("other")
        ws.drop("other")
        assert ws.names == ["t", "total"]
        with pytest.raises(KeyError):
            ws.table("other")
    assert not any(files.path_exists(spark, f) for f in folders)
    assert not spark.catalog.tableExists("total") and files.path_exists(spark, source)


def test_merged_profiles_keep_types_and_bounds(spark):
    df = spark.range(0, 4000, 1, 4).selectExpr(
        "id % 3 as part", "id", "cast(id as int) as i", "id / 7.0D as x", "cast(id as decimal(20,2)) / 4 as dec",
        "date_add(date'2000-01-01', cast(id as int)) as day", "timestamp_ntz'2000-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id) as t",
        "md5(cast(id % 1000 as string)) as s", "if(id % 2 = 0, null, id % 10) as half", "array(id % 5) as a",
    )
    got = {r.COLUMN_NAME: r for r in profile.merge_profiles(profile.profile_parts(df, "part")).collect()}
    want = {r.COLUMN_NAME: r for r in profile.profile(df).collect()}
    assert set(got) == set(want)
    for name, r in want.items():
        g = got[name]
        assert (g.POSITION, g.DATA_TYPE, g.ROW_COUNT, g.NULLS) == (r.POSITION, r.DATA_TYPE, r.ROW_COUNT, r.NULLS)
        assert abs(g.UNIQUES - r.UNIQUES) <= max(1, 0.05 * r.UNIQUES), name
        if name != "dec":
            assert (g.MIN_VALUE, g.MAX_VALUE) == (r.MIN_VALUE, r.MAX_VALUE), name
        else:
            assert (float(g.MIN_VALUE), float(g.MAX_VALUE)) == (float(r.MIN_VALUE), float(r.MAX_VALUE))
    assert profile.merge_profiles(profile.profile_parts(df.where("false"), "part")).isEmpty()


def test_profiles_by_date_read_changed_dates_only(spark, store, tmp_path, monkeypatch):
    path = str(tmp_path / "p")
    days = [OLD, MID, NEW]
    store.seed(snaps(spark, [(f"k{i}", d, i % 7 if i else None, 1) for i in range(50) for d in days]))
    profiles.update_profiles(store, path)
    read = []
    real = HistoryStore.read
    monkeypatch.setattr(HistoryStore, "read", lambda self, days=None, key=None: read.append(days) or real(self, days, key))
    assert profiles.stored_profile(store, path).count() == 4 and read == []
    store.merge(snaps(spark, [("k1", MID, 99, 2, "x")], SCHEMA + ", EXTRA string"))
    read.clear()
    got = {r.COLUMN_NAME: r for r in profiles.stored_profile(store, path).collect()}
    assert read == [[MID]]
    want = {r.COLUMN_NAME: r for r in profile.profile(real(store)).collect()}
    for name, r in want.items():
        g = got[name]
        assert (g.DATA_TYPE, g.ROW_COUNT, g.NULLS, g.NULL_PCT) == (r.DATA_TYPE, r.ROW_COUNT, r.NULLS, r.NULL_PCT)
        assert (g.MIN_VALUE, g.MAX_VALUE) == (r.MIN_VALUE, r.MAX_VALUE) and abs(g.UNIQUES - r.UNIQUES) <= 1
    one = {r.COLUMN_NAME: r.ROW_COUNT for r in profiles.stored_profile(store, path, [OLD]).collect()}
    assert set(one.values()) == {50}


def test_workspace_without_result(spark):
    ws = Workspace(spark)
    assert ws.tables().isEmpty()
    with pytest.raises(ValueError):
        ws.save("x")
