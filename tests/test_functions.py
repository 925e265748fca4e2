import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapledger.functions import casting, dates, sprints, text
from snapledger.operators.releases import explode_list


def values(spark, rows, schema, *exprs):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*exprs).collect()]


def test_strip_removes_all_white_space(spark):
    rows = [("\ta\n",), (" a",), (" a b　",), ("",), (None,)]
    got = values(spark, rows, "c string", text.strip_text(F.col("c")))
    assert got == [("a",), ("a",), ("a b",), ("",), (None,)]


@pytest.mark.parametrize(
    "name, at_end, key, label",
    [
        ("Team PI 26.1.2", "26.1.2", 260102, "26.1.2"),
        ("26.1.IP", "26.1.IP", 260199, "26.1.IP"),
        ("x 26.1.2  \n", "26.1.2", 260102, "26.1.2"),
        ("2026.1.IP", "2026.1.IP", 260199, "26.1.IP"),
        ("01.2.3", "01.2.3", 10203, "1.2.3"),
        ("26.1.99", "26.1.99", 260199, "26.1.IP"),
        ("26.1.105", "26.1.105", 260205, "26.2.5"),
        ("26.1.99999999999999999999", "26.1.99999999999999999999", 260100, "26.1.0"),
        ("26.1.2 late", None, 0, "0.0.0"),
        ("Backlog", None, 0, "0.0.0"),
        (None, None, 0, "0.0.0"),
    ],
)
def test_version_key(spark, name, at_end, key, label):
    version = sprints.version_at_end(F.col("c"))
    k = sprints.version_key(version)
    got = values(spark, [(name,)], "c string", version, k, sprints.key_version(k))
    assert got == [(at_end, key, label)]


@pytest.mark.parametrize(
    "name, found, prefix",
    [
        ("T 26.1.IP", "26.1.IP", "26.1"),
        ("T 26.10.2", None, None),
        ("2026.1.IP", "26.1.IP", "26.1"),
        ("zz", None, None),
        (None, None, None),
    ],
)
def test_version_anywhere(spark, name, found, prefix):
    got = values(
        spark, [(name,)], "c string",
        sprints.version_anywhere(F.col("c")), sprints.increment_of(F.col("c")),
    )
    assert got == [(found, prefix)]


def test_split_keeps_null_and_empty(spark):
    rows = [(1, None), (2, ""), (3, "a,"), (4, "26.1, 26.2")]
    got = explode_list(spark.createDataFrame(rows, "k int, v string"), "v").collect()
    assert sorted(map(tuple, got), key=str) == [
        (1, None), (2, ""), (3, ""), (3, "a"), (4, "26.1"), (4, "26.2")
    ]


def test_names():
    assert text.title_name("PI_FROM_SPRINT") == "Pi From Sprint"
    assert text.title_name("TARGET_START_epics") == "Target Start Epics"
    assert text.title_name("X2Y") == "X2Y"
    assert text.snake_name("Pi From Sprint") == "PI_FROM_SPRINT"
    assert text.snake_name(text.title_name("BV")) == "BV"
    assert text.parse_column("A -> B") == ("A", "B")
    assert text.parse_column("A") == ("A", "A")


def test_coerce(spark):
    df = spark.createDataFrame(
        [("x", "not a date", " a\t", 1), ("1.5", "1998-03-04 10:00:00", None, 2), ("1.0f", None, "b", 3)],
        "n string, d string, s string, keep int",
    )
    got = casting.coerce(
        df, {"n": "float", "d": "datetime", "s": "string", "absent": "float"}
    )
    assert got.dtypes == [("n", "double"), ("d", "timestamp_ntz"), ("s", "string"), ("keep", "int")]
    assert [tuple(r) for r in got.collect()] == [
        (None, None, "a", 1), (1.5, dt.datetime(1998, 3, 4, 10), None, 2), (None, None, "b", 3)
    ]


def test_void_columns_become_text(spark):
    df = spark.sql("select 1 as a, null as b")
    assert casting.void_to_string(df).dtypes == [("a", "int"), ("b", "string")]


def test_snapshot_days():
    d = dt.date
    assert dates.snapshot_days(d(1998, 3, 4), 4) == [
        d(1998, 3, 2), d(1998, 2, 23), d(1998, 2, 16), d(1998, 2, 9)
    ]
    assert dates.snapshot_days(dt.datetime(1998, 3, 2, 13), 1) == [d(1998, 3, 2)]
    assert dates.snapshot_days(d(1998, 3, 4), 1, day_of_week=6) == [d(1998, 3, 1)]


def test_snapshot_days_as_column(spark):
    days = [dt.date(1998, 3, 1) + dt.timedelta(days=i) for i in range(14)]
    for dow in range(7):
        got = values(
            spark, [(d,) for d in days], "d date",
            "d", dates.snapshot_day_array(F.col("d"), 3, dow),
        )
        assert got == [(d, dates.snapshot_days(d, 3, dow)) for d in days]
