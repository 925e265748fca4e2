"""What the physical plans must and must not contain, and hot keys."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from catalog import inputs as I
from catalog.queries import QUERIES, _lookups
from snapledger.operators import align, gapfill, hierarchy, joins, merge, releases, skew
from snapledger.plans import epics, stories
from snapledger.session import stage

DAY = dt.date(1998, 2, 2)
LEAN = ["hierarchy_flatten_snapshots", "sprint_range", "snapshot_merge", "stories_table", "epics_table"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LEAN)
def test_no_python_and_no_cross_join(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node


def test_snapshot_filter_reaches_files_and_folders(spark, tmp_path):
    path = str(tmp_path / "h")
    rows = spark.createDataFrame([("a", DAY, 1)], "K string, SNAPSHOT_DATE date, V int")
    rows.write.parquet(path)
    recent = hierarchy.recent_rows(spark.read.parquet(path), I.AS_OF)
    assert "PushedFilters: [IsNotNull(SNAPSHOT_DATE)" in plan(recent)
    rows.write.partitionBy("SNAPSHOT_DATE").parquet(path + "p")
    recent = hierarchy.recent_rows(spark.read.parquet(path + "p"), I.AS_OF)
    assert "PartitionFilters: [isnotnull(SNAPSHOT_DATE" in plan(recent.select("V"))


def test_scans_are_pruned(spark, sf):
    text = plan(QUERIES["sprint_range_current"](spark, sf))
    scan = text[text.index("ReadSchema"):].splitlines()[0]
    assert "l_extendedprice" not in scan and "l_returnflag" not in scan


def test_leaf_table_is_shuffled_once(spark, settings, tmp_path):
    """Resolving the upper levels first leaves one exchange of the leaf rows."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    path = str(tmp_path / "items")
    spark.range(10).selectExpr(
        "'k' || id as ISSUE_KEY", "'p' as PARENT_KEY", "'Epic' as ISSUE_TYPE", "'s' as SUMMARY",
        "1.0D as ESTIMATE", "1.0D as OPEN_ESTIMATE", "1.0D as SWAG", "'p' as PROGRAM_PRIORITY",
        "'v' as FIX_VERSION",
    ).write.parquet(path)
    text = plan(epics.epic_current(spark.read.parquet(path)))
    assert text.count("SortMergeJoin") == 4
    # Nothing but the last join has leaf columns under it.
    upper = text.split("SortMergeJoin", 2)[2]
    assert "AS EPIC_SUMMARY" not in upper.split("SortMergeJoin", 1)[1]


def test_staged_levels_read_the_items_once(spark, sf, tmp_path, monkeypatch):
    path = str(tmp_path / "items")
    I.issue_history(spark, sf).write.parquet(path)
    items = spark.read.parquet(path)
    made = []
    monkeypatch.setattr(hierarchy, "stage", lambda df, *args, **more: made.append(df) or stage(df, *args, **more))
    plain, once = epics.epic_history_unique(items), epics.epic_history_unique(items, staged=True)
    (written,) = made
    assert plan(written).count("FileScan") == 1
    assert plan(plain).count(f"file:{path}") == 5
    text = plan(once)
    assert path not in text
    # Each level reads its own folder, and only its own columns.
    assert text.count("PartitionFilters: [isnotnull(ISSUE_TYPE") == 5
    leaf = [line for line in text.splitlines() if "ISSUE_TYPE#" in line and "= Epic)" in line]
    assert leaf and not any("FIX_VERSION" in line for line in leaf)
    assert Counter(once.collect()) == Counter(plain.collect())


def test_staged_levels_keep_edge_cases(spark):
    """Empty tables, missing levels, null kinds and dates, extra columns."""
    columns = ("SNAPSHOT_DATE date, ISSUE_KEY string, PARENT_KEY string, ISSUE_TYPE string, SUMMARY string, "
               "ESTIMATE double, OPEN_ESTIMATE double, SWAG double, PROGRAM_PRIORITY string, FIX_VERSION string, "
               "EXTRA string")
    rest = ("s", 1.0, 2.0, 3.0, "p", "26.1", "x")
    data = [
        (DAY, "e", "f", "Epic", *rest), (DAY, "f", None, "Feature", *rest), (None, "e2", "f", "Epic", *rest),
        (DAY, None, "f", "Epic", *rest), (DAY, "n", "f", None, *rest), (DAY, "o", "f", "Other", *rest),
    ]
    for rows in ([], data[:1], data):
        items = spark.createDataFrame(rows, columns)
        for flat in (epics.epic_history, epics.epic_history_unique, epics.epic_current):
            assert Counter(flat(items, staged=True).collect()) == Counter(flat(items).collect())


@pytest.mark.parametrize("name", ["stories", "epics"])
def test_current_rows_are_made_distinct_once(spark, sf, name):
    """The report and its copies read one staged table."""
    files = QUERIES[f"{name}_table"](spark, sf).inputFiles()
    assert any(f"/{name}-current-" in file for file in files)


def test_merge_uses_an_anti_join_and_reduces_before_the_shuffle(spark, sf):
    text = plan(QUERIES["snapshot_merge"](spark, sf))
    assert "LeftAnti" in text
    assert "row_number(), 1, Partial" in text and "row_number(), 1, Final" in text


def test_staged_lookups_are_broadcast_only_while_small(spark, sf, settings):
    found = _lookups(spark, sf)
    rows = I.story_snapshots(spark, sf).select("ISSUE_KEY", "SNAPSHOT_DATE", "PROGRAM_INCREMENT")

    def joined():
        return joins.fallback_lookup(
            rows, found.range_history, found.range_current,
            ["SNAPSHOT_DATE", "PROGRAM_INCREMENT"], ["PROGRAM_INCREMENT"], epics.RANGE,
        )

    small = plan(joined())
    assert small.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in small
    want = Counter(joined().collect())
    settings(spark__sql__autoBroadcastJoinThreshold="100")
    large = joined()
    assert plan(large).count("SortMergeJoin") == 2
    assert Counter(large.collect()) == want


def test_release_range_leaves_history_out(spark, sf):
    """The null-date filter removes the whole dated branch."""
    text = plan(QUERIES["epics_release_range"](spark, sf))
    assert "inline" not in text and "1998-01-05" not in text
    assert "Union" not in text


def test_release_range_has_no_window(spark, sf):
    assert "Window" not in plan(QUERIES["release_range"](spark, sf))


def test_current_distinct_replaces_the_distinct_of_the_union(spark, sf):
    source, snapshots = I.story_source(spark, sf), I.story_snapshots(spark, sf)
    current = stories.story_current(source)
    history = stories.story_history_unique(snapshots, source)
    lean = align.union_aligned(
        current.distinct(), gapfill.fill_missing_snapshots(current.distinct(), history, I.AS_OF)
    )
    full = align.union_distinct(
        current, gapfill.fill_missing_snapshots(current, history, I.AS_OF)
    )
    assert lean.count() == full.count()
    assert lean.exceptAll(full).isEmpty()


# --- hot keys ----------------------------------------------------------------
SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
    "spark__sql__adaptive__coalescePartitions__parallelismFirst": "false",
}


def test_hot_parent_is_split(spark, settings):
    """A third of the leaves share one parent: the join splits their partition."""
    settings(**SKEW)
    left = spark.range(0, 30000, 1, 8).selectExpr(
        "id", "if(id % 3 = 0, 'hot', 'k' || (id % 1000)) as k", "repeat(md5(id || ''), 3) as pad"
    )
    right = spark.range(1000).selectExpr("'k' || id as k", "id as v").union(
        spark.sql("select 'hot', -1L")
    )
    got = joins.left_lookup(left, right, ["k"], spread_by="id")
    text = final_plan(got)
    assert "skew=true" in text or "skewed" in text
    assert got.count() == 30000 and got.where("v = -1").count() == 10000
    assert got.where("v is null").count() == 0


def test_null_parents_are_spread(spark, settings):
    settings(**SKEW)
    left = spark.range(0, 9000, 1, 8).selectExpr("id", "if(id % 3 = 0, null, 'k' || id) as k")
    right = spark.range(9000).selectExpr("'k' || id as k", "id as v")
    keyed = joins.left_lookup(left, right, ["k"], spread_by="id")
    assert keyed.count() == 9000 and keyed.where("v is null").count() == 3000
    place = F.coalesce("k", joins._spread_nulls(F.col("k"), F.col("id")))
    sizes = left.where("k is null").repartition(8, place).groupBy(F.spark_partition_id()).count()
    counts = [r["count"] for r in sizes.collect()]
    assert len(counts) == 8 and max(counts) < 2 * min(counts)


def crowded(spark):
    """A third of the rows without a key, a third with one key, the rest spread."""
    left = spark.range(0, 30000, 1, 8).selectExpr(
        "id", "case id % 3 when 0 then null when 1 then 'hot' else 'k' || (id % 2000) end as k",
        "if(id % 3 = 0, cast(null as date), date'1998-02-02') as d",
    )
    right = spark.range(2000).selectExpr("'k' || id as k", "date'1998-02-02' as d", "id as v").unionByName(
        spark.sql("select 'hot' as k, date'1998-02-02' as d, -1L as v union all select null, null, -2L union all select 'hot', null, -3L")
    )
    return left, right


def test_hot_keys_are_found(spark):
    left, _ = crowded(spark)
    hashes = left.select(skew._key_hash([F.col("k"), F.col("d")]).alias("h"), "k").distinct().collect()
    want = {r.h for r in hashes if r.k in (None, "hot")}
    assert set(skew.hot_keys(left, ["k", "d"]).first().hot) == want
    assert skew.hot_keys(left.where("false"), ["k"]).first().hot == []
    assert skew.hot_keys(left.selectExpr("cast(id as string) as k"), ["k"]).first().hot == []


@pytest.mark.parametrize("null_safe", [True, False])
def test_split_lookup_deals_hot_and_null_keys(spark, settings, null_safe):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false",
        spark__sql__shuffle__partitions="16",
    )
    left, right = crowded(spark)
    plain = joins.left_lookup(left, right, ["k", "d"], null_safe=null_safe)
    split = skew.split_lookup(left, right, ["k", "d"], ["id"], null_safe=null_safe, parts=64)
    assert split.columns == plain.columns
    assert Counter(split.collect()) == Counter(plain.collect())

    def largest(df):
        return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())

    assert largest(plain) > 9000 and largest(split) < 4000
    # The keys may come from a cheaper table, and need not be found at all.
    for keys_from in (left.where("id % 2 = 0"), left.where("false")):
        other = skew.split_lookup(left, right, ["k", "d"], ["id"], null_safe=null_safe, keys_from=keys_from)
        assert Counter(other.collect()) == Counter(plain.collect())
    with pytest.raises(TypeError):
        skew.split_lookup(left, right.withColumn("d", F.lit("x")), ["k", "d"], ["id"])


def test_features_are_joined_without_dealing_stories_by_date(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    left, right = crowded(spark)
    names = lambda df: df.withColumnsRenamed({"k": "FEATURE_ID", "d": "SNAPSHOT_DATE"})
    left, right = names(left), names(right)
    want = Counter(joins.left_lookup(left, right, ["FEATURE_ID", "SNAPSHOT_DATE"], "_epics", null_safe=True).collect())
    for keys_from in (None, left):
        got = stories.join_features(left, right, keys_from, row="id")
        assert Counter(got.collect()) == want
        dealt = [line for line in plan(got).splitlines() if "hashpartitioning" in line]
        assert any("FEATURE_ID" in line for line in dealt)
        assert not any("SNAPSHOT_DATE" in line for line in dealt)


def test_null_groups_of_a_fallback_are_spread(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    left, right = crowded(spark)
    rows = left.withColumn("row", F.col("id").cast("string"))
    by_day, by_key = right.where("d is not null"), right.groupBy("k").agg(F.max("v").alias("v"))
    shape = (["d", "k"], ["k"], ["v"])
    plain = joins.fallback_lookup(rows, by_day, by_key, *shape)
    spread = joins.fallback_lookup(rows, by_day, by_key, *shape, spread_by="row")
    assert Counter(plain.collect()) == Counter(spread.collect())
    nulls = spread.where("k is null").groupBy(F.spark_partition_id()).count().collect()
    assert len(nulls) == 8 and max(r["count"] for r in nulls) < 2000


def test_features_are_joined_in_parts(spark, sf):
    """The report over a store looks for hot keys in the stored columns only."""
    source, snapshots = I.story_source(spark, sf), I.story_snapshots(spark, sf)
    history = stage(stories.story_history_unique(snapshots, source), "history")
    table = stories.stories_table(
        stories.story_current(source), history, QUERIES["feature_lookup"](spark, sf), I.AS_OF,
        known=[], keys_from=history,
    )
    text = table._jdf.queryExecution().optimizedPlan().toString()
    assert "approx_top_k" in text
    scans = [line for line in plan(table).splitlines() if "ReadSchema: struct<SNAPSHOT_DATE:date,FEATURE_ID:string>" in line]
    assert scans


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """One key holds a third of the rows; the result is one row for it."""
    df = spark.range(0, 30000, 1, 8).selectExpr(
        "if(id % 3 = 0, 'hot', 'k' || id) as K", "date'1998-02-02' as SNAPSHOT_DATE", "id as V"
    )
    got = merge.latest_per_key(df, ["K", "SNAPSHOT_DATE"], "V")
    assert got.count() == 20001
    assert got.where("K = 'hot'").first().V == 29997


def test_hot_feature_in_release_range(spark, settings):
    settings(**SKEW)
    df = spark.range(0, 9000, 1, 8).selectExpr(
        "cast(null as date) as `Snapshot Date`",
        "if(id % 3 = 0, 'hot', 'k' || id) as `Feature Key`", "'s' as `Subcapability Key`",
        "'26.' || (id % 5) || ', 26.' || (id % 7) as `Feature Fix Version`",
    )
    got = releases.release_range(df)
    assert got.count() == 18000
    hot = got.where("FEATURE_KEY = 'hot'")
    assert hot.count() == 6000
    assert hot.select("MIN_TARGET_RELEASE", "MAX_TARGET_RELEASE").distinct().collect() == [("26.0", "26.6")]


def test_staged_table_is_read_back_whole(spark):
    df = spark.range(100).selectExpr("id", "date'1998-02-02' as d", "cast(null as string) as s")
    back = stage(df, "t")
    assert back.dtypes == df.dtypes and back.count() == 100
    assert "Range" not in plan(back)
