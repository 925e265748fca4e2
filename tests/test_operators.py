import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import Observation, functions as F, types as T

from snapledger import fixed
from snapledger.operators import (
    align, columns, gapfill, hierarchy, joins, merge, profile, releases, rollup, sampling, sprints,
)
from snapledger.plans import epics

D = dt.date
DAY = D(1998, 2, 2)


def rows(df):
    return Counter(map(tuple, df.collect()))


# --- alignment -------------------------------------------------------------
@pytest.mark.parametrize(
    "a, b, want",
    [
        (T.IntegerType(), T.StringType(), T.StringType()),
        (T.DateType(), T.StringType(), T.StringType()),
        (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
        (T.NullType(), T.DoubleType(), T.DoubleType()),
        (T.NullType(), T.NullType(), T.StringType()),
        (T.IntegerType(), T.LongType(), T.LongType()),
        (T.LongType(), T.DoubleType(), T.DoubleType()),
        (T.BooleanType(), T.LongType(), T.StringType()),
        (T.DecimalType(10, 2), T.DecimalType(8, 4), T.DecimalType(12, 4)),
    ],
)
def test_common_type(a, b, want):
    assert align.common_type(a, b) == want == align.common_type(b, a)


def test_align_orders_and_fills(spark):
    left = spark.sql("select 1 as a, date'1998-01-01' as d, null as v")
    right = spark.sql("select 'x' as extra, '7' as a, 'later' as d")
    got = align.union_aligned(left, right)
    assert got.dtypes == [("a", "string"), ("d", "string"), ("v", "string"), ("extra", "string")]
    assert rows(got) == Counter([("1", "1998-01-01", None, None), ("7", "later", None, "x")])


def test_union_distinct_counts_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "b")], "a int, b string")
    assert align.union_distinct(df, df).count() == 2


def test_required_columns_fail_before_any_job(spark):
    with pytest.raises(KeyError, match="SNAPSHOT_DATE"):
        merge.normalize_keys(spark.createDataFrame([("a",)], "K string"), "K")


# --- joins -----------------------------------------------------------------
def test_plain_lookup_never_matches_null(spark):
    left = spark.createDataFrame([(1, "a"), (2, None)], "id int, k string")
    right = spark.createDataFrame([("a", "x"), (None, "no"), ("\x00" + "5", "no")], "k string, v string")
    for spread in (None, "id"):
        got = joins.left_lookup(left, right, ["k"], spread_by=spread)
        assert rows(got) == Counter([(1, "a", "x"), (2, None, None)])


def test_spread_stand_in_cannot_match(spark):
    left = spark.range(200).selectExpr("id", "cast(null as string) as k")
    right = spark.range(1024).selectExpr("chr(0) || id as k", "id as v")
    got = joins.left_lookup(left, right, ["k"], spread_by="id")
    assert got.where("v is not null").count() == 0 and got.count() == 200


def test_null_safe_lookup_and_suffix(spark):
    left = spark.createDataFrame([("f", None, 1), (None, None, 2)], "k string, d date, Val int")
    right = spark.createDataFrame([("f", None, 10), ("f", DAY, 11)], "k string, d date, val int")
    got = joins.left_lookup(left, right, ["k", "d"], "_epics", null_safe=True)
    assert got.columns == ["k", "d", "Val", "val_epics"]
    assert rows(got) == Counter([("f", None, 1, 10), (None, None, 2, None)])


def test_fallback(spark):
    df = spark.createDataFrame(
        [(1, DAY, "p"), (2, DAY, "q"), (3, DAY, "z"), (4, None, "p"), (5, DAY, None)],
        "id int, SNAPSHOT_DATE date, PROGRAM_INCREMENT string",
    )
    first = spark.createDataFrame([(DAY, "p", "first")], "SNAPSHOT_DATE date, PROGRAM_INCREMENT string, V string")
    second = spark.createDataFrame([("p", "second"), ("q", "second")], "PROGRAM_INCREMENT string, V string")
    got = joins.fallback_lookup(df, first, second, fixed.SPRINT_GROUP, [fixed.GROUP], ["V"])
    assert {r.id: r.V for r in got.collect()} == {1: "first", 2: "second", 3: None, 4: "second", 5: None}


def test_strict_lookup(spark):
    ok = spark.createDataFrame([("a", 1), (None, 1), (None, 2)], "k string, v int")
    joins.assert_unique(ok, ["k"])
    with pytest.raises(ValueError):
        joins.assert_unique(ok.union(ok), [("x", "k")])


# --- hierarchy ---------------------------------------------------------------
def items(spark, data):
    df = spark.createDataFrame(
        data, "SNAPSHOT_DATE date, ISSUE_KEY string, PARENT_KEY string, ISSUE_TYPE string"
    )
    return df.selectExpr(
        "*", "ISSUE_KEY as SUMMARY", "1.0D as ESTIMATE", "1.0D as OPEN_ESTIMATE",
        "1.0D as SWAG", "'p' as PROGRAM_PRIORITY", "'26.1' as FIX_VERSION",
    )


CHAIN = [
    ("e", "f", "Epic"), ("f", "s", "Feature"), ("s", "c", "Sub-Capability"),
    ("c", "x", "Customer Capability"), ("x", None, "Customer Epic"),
]


def test_missing_parent_on_one_day_breaks_the_chain_there_only(spark):
    later = D(1998, 2, 9)
    data = [(DAY, *r) for r in CHAIN] + [(later, *r) for r in CHAIN if r[0] != "s"]
    got = epics.epic_history(items(spark, data)).collect()
    keys = {r.SNAPSHOT_DATE: (r.FEATURE_KEY, r.SUBCAPABILITY_KEY, r.CUSTCAP_KEY, r.PROGRAM) for r in got}
    assert keys == {DAY: ("f", "s", "c", "x"), later: ("f", None, None, None)}


def test_repeated_parent_multiplies_unless_unique(spark):
    data = [(DAY, *r) for r in CHAIN] + [(DAY, "f", "s", "Feature")]
    assert epics.epic_history(items(spark, data)).count() == 2
    assert epics.epic_history_unique(items(spark, data)).count() == 1


def test_recent_bound_is_a_timestamp(spark):
    df = spark.createDataFrame([(D(1998, 2, 2),), (D(1998, 2, 3),), (None,)], "SNAPSHOT_DATE date")
    assert hierarchy.recent_rows(df, dt.datetime(1998, 3, 4)).count() == 2
    assert hierarchy.recent_rows(df, dt.datetime(1998, 3, 4, 12)).count() == 1


# --- roll-up and sprints -------------------------------------------------------
def test_rollup(spark):
    df = spark.createDataFrame(
        [("f", 3.0, "Done", DAY, DAY), ("f", None, "Open", None, D(1998, 2, 9)), ("g", None, "Done", None, None)],
        "F string, STORY_POINTS double, STATUS string, BEGIN_DATE date, END_DATE date",
    )
    assert rows(rollup.rollup_estimates(df, ["F"])) == Counter(
        [("f", 3.0, 3.0, 0.0, 2, DAY, D(1998, 2, 9)), ("g", None, None, None, 1, None, None)]
    )


WINDOWS = "SNAPSHOT_DATE date, PROGRAM_INCREMENT string, SPRINT_NAME string, BEGIN_DATE date, END_DATE date"


def windows(spark, data):
    return spark.createDataFrame(data, WINDOWS)


def test_sprint_range_groups_nulls_and_takes_empty_input(spark):
    df = windows(spark, [
        (DAY, "p", "T 26.1.10", None, None), (DAY, "p", "T 26.1.9", None, None),
        (DAY, "p", "T 26.1.IP", None, None), (None, None, "T 26.2.1", None, None),
        (None, None, "Backlog", None, None),
    ])
    want = Counter([(DAY, "p", "26.1.9", "26.1.IP"), (None, None, "0.0.0", "26.2.1")])
    assert rows(sprints.sprint_range(df)) == want
    summary = sprints.sprint_summary(df, DAY)
    assert rows(sprints.summary_range(summary)) == want
    assert sprints.sprint_range(df.limit(0)).count() == 0
    detail = sprints.with_sprint_range(df)
    assert rows(detail.select(*fixed.SPRINT_GROUP, "MIN_SPRINT", "MAX_SPRINT").distinct()) == want
    assert detail.count() == 5


def test_current_sprint_bounds_and_overlap(spark):
    df = windows(spark, [
        (DAY, "a", "26.1.1", DAY, D(1998, 2, 9)), (DAY, "b", "26.1.2", D(1998, 1, 1), DAY),
        (DAY, "c", "26.1.3", DAY, None), (DAY, "d", "26.1.4", D(1998, 2, 3), D(1998, 2, 9)),
        (DAY, "a", "later 26.1.5", DAY, DAY), (DAY, "a", "Backlog", DAY, DAY),
        (DAY, "a", "other 26.1.1", DAY, DAY),
    ])
    want = Counter([(DAY, "a", "26.1.1"), (DAY, "a", "26.1.5"), (DAY, "a", None), (DAY, "b", "26.1.2")])
    assert rows(sprints.current_sprint(df, DAY)) == want
    assert rows(sprints.summary_current(sprints.sprint_summary(df, DAY))) == want


def test_unparsed_names_are_reported(spark, caplog):
    df = windows(spark, [(DAY, "p", "Backlog", None, None), (DAY, "p", "26.1.1", None, None)])
    observed, seen = sprints.observe_versions(df)
    observed.collect()
    assert sprints.warn_if_unparsed(seen) == 0.5
    assert "1 of 2" in caplog.text


# --- merge -----------------------------------------------------------------
def snaps(spark, data):
    return spark.createDataFrame(data, "K string, SNAPSHOT_DATE date, V int, UPDATED int")


def test_merge_cases(spark):
    cached = snaps(spark, [("both", DAY, 1, 9), ("old", DAY, 1, 1), (None, DAY, 1, 1), ("both", D(1998, 1, 1), 5, 1)])
    recent = snaps(spark, [("both", DAY, 2, 1), ("new", DAY, 2, 1), ("two", DAY, 3, 1), ("two", DAY, 4, 2), ("x", None, 1, 1)])
    got = merge.merge_snapshots(cached, recent, "K", newest="UPDATED")
    want = Counter([
        ("both", DAY, 2, 1), ("old", DAY, 1, 1), ("both", D(1998, 1, 1), 5, 1),
        ("new", DAY, 2, 1), ("two", DAY, 4, 2),
    ])
    assert rows(got) == want
    again = merge.merge_snapshots(got, recent, "K", newest="UPDATED", cached_is_unique=True)
    assert rows(again) == want


def test_merge_removes_repeats_on_the_cached_side(spark):
    cached = snaps(spark, [("a", DAY, 1, 1), ("a", DAY, 2, 2)])
    got = merge.merge_snapshots(cached, snaps(spark, []), "K", newest="UPDATED")
    assert rows(got) == Counter([("a", DAY, 2, 2)])


def test_retention():
    merge.check_retention(100, 98)
    merge.check_retention(100, 97, 0.0)
    with pytest.raises(merge.ShrinkError):
        merge.check_retention(100, 97)


# --- gap fill ----------------------------------------------------------------
AS_OF = dt.datetime(1998, 3, 16, 9)
WEEKS = [D(1998, 2, 23), D(1998, 3, 2), D(1998, 3, 9)]


def test_gap_fill_picture(spark):
    """Two Mondays present, one missing; the Monday that is today is not filled."""
    history = spark.createDataFrame([("a", d) for d in WEEKS[:2]], "K string, SNAPSHOT_DATE date")
    now = spark.createDataFrame([("a", None), ("b", None)], "K string, SNAPSHOT_DATE date")
    got = gapfill.fill_missing_snapshots(now, history, AS_OF)
    assert rows(got) == Counter(
        [("a", d, False) for d in WEEKS[:2]] + [("a", WEEKS[2], True), ("b", WEEKS[2], True)]
    )
    elsewhere = gapfill.fill_missing_snapshots(now, history.where("K = 'z'"), AS_OF, dates_from=history)
    assert rows(elsewhere.select("SNAPSHOT_DATE")) == Counter([(WEEKS[2],)] * 2)


def test_gap_fill_without_gaps(spark):
    history = spark.createDataFrame([("a", d) for d in WEEKS], "K string, SNAPSHOT_DATE date")
    got = gapfill.fill_missing_snapshots(history, history, AS_OF)
    assert rows(got) == Counter([("a", d, False) for d in WEEKS])


def test_no_expected_date_is_left_out(spark):
    history = spark.createDataFrame([], "K string, SNAPSHOT_DATE date")
    now = spark.createDataFrame([("a", None)], "K string, SNAPSHOT_DATE date")
    got = gapfill.fill_missing_snapshots(now, history, AS_OF, weeks=6, day_of_week=3)
    assert got.select("SNAPSHOT_DATE").distinct().count() == 6


# --- release range -------------------------------------------------------------
def test_release_range_cases(spark):
    df = spark.createDataFrame(
        [
            (None, "f", "s", "26.9, 26.10"), (None, "f", "s", "26.2"), (None, None, "s", "26.1"),
            (DAY, "f", "s", "1.0"), (None, "n", None, None), (None, "t", None, "26.9,"),
        ],
        "`Snapshot Date` date, `Feature Key` string, `Subcapability Key` string, `Feature Fix Version` string",
    )
    got = releases.release_range(df).select(
        "FEATURE_KEY", "FEATURE_FIX_VERSION", "MIN_TARGET_RELEASE", "MAX_TARGET_RELEASE"
    )
    assert rows(got) == Counter([
        ("f", "26.9", "26.10", "26.9"), ("f", "26.10", "26.10", "26.9"), ("f", "26.2", "26.10", "26.9"),
        ("n", None, None, None), ("t", "26.9", "", "26.9"), ("t", "", "", "26.9"),
    ])


def test_null_diagnostics_ride_on_another_action(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "x string, y string")
    seen = Observation()
    releases.release_nulls(df, ["x", "y"], seen).collect()
    assert seen.get == {"rows": 2, "x": 1, "y": 2}


# --- profile and samples -------------------------------------------------------
def test_profile(spark):
    df = spark.createDataFrame(
        [(1, "a", 0.0, [1]), (2, None, -0.0, [1]), (2, None, None, None)],
        "n int, s string, x double, l array<int>",
    )
    got = {r.COLUMN_NAME: r for r in profile.profile(df).collect()}
    assert (got["s"].NULLS, got["s"].NULL_PCT, got["s"].UNIQUES, got["s"].MIN_VALUE) == (2, 66.6667, 2, None)
    assert (got["n"].UNIQUES, got["n"].MIN_VALUE, got["n"].MAX_VALUE) == (2, "1", "2")
    assert got["x"].UNIQUES == 2 and got["l"].UNIQUES == 2
    total = profile.profile_total(profile.profile(df)).first()
    assert (total.NULLS, total.NULL_PCT) == (4, 33.3333)


def test_profile_of_long_texts_is_exact(spark):
    df = spark.range(50).selectExpr("repeat('x', 5000) || (id % 7) as t")
    assert profile.profile(df).first().UNIQUES == 7


@pytest.mark.parametrize("exact", [True, False])
def test_profile_of_empty_table(spark, exact):
    got = profile.profile(spark.createDataFrame([], "a int, b string"), exact).collect()
    assert [(r.COLUMN_NAME, r.ROW_COUNT, r.NULLS, r.NULL_PCT, r.UNIQUES) for r in got] == [
        ("a", 0, 0, 0.0, 0), ("b", 0, 0, 0.0, 0)
    ]


def test_sample_is_capped_at_the_table(spark):
    df = spark.range(5)
    assert sampling.sample_rows(df, 10).count() == 5
    assert sampling.sample_rows(df, 3, seed=1).distinct().count() == 3
    assert sampling.preview(spark.range(300)).count() == 100
    assert sampling.preview(spark.range(300), None).count() == 300


def test_project_with_constants(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    got = columns.project(df, ["a -> x", "b", "c"], {"c": columns.typed_null("date")})
    assert got.dtypes == [("x", "int"), ("b", "int"), ("c", "date")]


def test_long_and_short_texts_are_counted_alike(spark):
    import hashlib

    long = "x" * 100
    df = spark.createDataFrame([(long,), (hashlib.sha256(long.encode()).hexdigest(),)], "t string")
    for exact in (True, False):
        assert profile.profile(df, exact).first().UNIQUES == 2


def test_names_that_differ_in_case_are_one_column(spark):
    left = spark.createDataFrame([(1, 2)], "K int, Val int")
    right = spark.createDataFrame([(3, 4)], "k int, val int")
    got = align.union_aligned(left, right)
    assert got.columns == ["K", "Val"] and sorted(map(tuple, got.collect())) == [(1, 2), (3, 4)]


def test_a_suffix_that_clashes_again_is_an_error(spark):
    left = spark.createDataFrame([(1, 2, 3)], "k int, v int, v_sum int")
    right = spark.createDataFrame([(1, 5)], "k int, v int")
    with pytest.raises(ValueError):
        joins.left_lookup(left, right, ["k"], "_sum")


def test_a_seed_draws_one_sample_for_any_partitioning(spark):
    df = spark.range(1000)
    one, many = (
        sorted(r.id for r in sampling.sample_rows(df.repartition(n), 20, seed=3).collect()) for n in (1, 50)
    )
    assert one == many and len(set(one)) == 20
    assert one != sorted(r.id for r in sampling.sample_rows(df, 20, seed=4).collect())
