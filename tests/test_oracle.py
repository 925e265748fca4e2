"""Every registered query against independent SQL on the smallest tables."""

import pytest

import __spark_entry__ as registered
from catalog.oracle import ORACLE
from catalog.queries import QUERIES
from compare import connect, differences

NO_SQL = {"random_sample", "table_profile_approx"}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_is_registered_and_has_an_oracle():
    assert set(QUERIES) <= set(registered.queries())
    assert set(ORACLE) <= set(registered.oracle_sql())
    assert set(QUERIES) - set(ORACLE) == NO_SQL
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_oracle(spark, sf, con, name):
    assert differences(con, QUERIES[name](spark, sf), ORACLE[name]) == {}


def test_entry_runs(spark):
    assert not registered.entry(spark).isEmpty()


@pytest.mark.parametrize("partitions", ["1", "50"])
@pytest.mark.parametrize("name", ["latest_per_key", "snapshot_merge", "release_range"])
def test_partitioning_does_not_change_results(spark, sf, con, settings, name, partitions):
    settings(spark__sql__shuffle__partitions=partitions)
    assert differences(con, QUERIES[name](spark, sf), ORACLE[name]) == {}


def test_sample_is_exact_and_drawn_from_the_table(spark, sf):
    got = QUERIES["random_sample"](spark, sf)
    ids = [r.event_id for r in got.collect()]
    assert len(ids) == len(set(ids)) == 50
    events = spark.read.parquet(f"{sf}/events.parquet")
    assert events.where(events.event_id.isin(ids)).count() == 50


def test_estimated_profile_is_close(spark, sf):
    near = {r.COLUMN_NAME: r.UNIQUES for r in QUERIES["table_profile_approx"](spark, sf).collect()}
    exact = {r.COLUMN_NAME: r.UNIQUES for r in QUERIES["table_profile_stories"](spark, sf).collect()}
    for name, n in exact.items():
        assert abs(near[name] - n) <= max(2, 0.2 * n), name
