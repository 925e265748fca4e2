"""Work-item tables derived from the given star-schema tables.

Regions, nations, customers, orders and line items become the five levels of a
hierarchy; line items also become stories. All rows of the tables take part. The
conditions in the dated tables leave single rows out on single dates, which is
what incomplete snapshots look like; they are input data, not a way to read less.

The same tables are written in SQL in ``oracle.py``, for another engine.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapledger.operators.hierarchy import recent_rows
from snapledger.operators.joins import spread_key

AS_OF = dt.datetime(1998, 3, 4)
TODAY = AS_OF.date()

# (number, date) of the snapshots that exist; the week numbered 5 is missing.
SNAPSHOTS = [
    (0, "1998-01-05"), (1, "1998-01-12"), (2, "1998-01-19"),
    (3, "1998-01-26"), (4, "1998-02-02"), (6, "1998-02-16"),
]


# The given files of these tables are one row group each, which is one task up to
# the next shuffle. They are dealt to all cores whatever their size, by their own key:
# dealt in turn, every task would first sort its rows. A table in many files would be
# read as it is.
SPREAD = {"lineitem": ["l_orderkey", "l_linenumber"], "orders": ["o_orderkey"]}


def table(spark: SparkSession, sf_dir: str, name: str, by: list | None = None) -> DataFrame:
    """A given table. ``by`` holds expressions of the key the caller groups or joins on:
    rows are then dealt by it, once, while they are few and narrow. What is derived from
    them, with the same expressions as columns, is not dealt again for that key."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if by:
        # As many tasks as any shuffle has: rows are multiplied later, which adaptive
        # execution does not know when it joins small partitions to one.
        columns = [F.expr(c) if isinstance(c, str) else c for c in by]
        return df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *columns)
    return df.repartition(spark.sparkContext.defaultParallelism, *SPREAD[name]) if name in SPREAD else df


def _per_snapshot(df: DataFrame) -> DataFrame:
    """Every row once per snapshot, by exploding a literal array (no join)."""
    rows = ", ".join(
        f"named_struct('K', {k}, 'SNAPSHOT_DATE', date'{d}')" for k, d in SNAPSHOTS
    )
    return df.selectExpr("*", f"inline(array({rows}))")


_ISSUE_COLUMNS = {
    "ISSUE_KEY": "string", "PARENT_KEY": "string", "ISSUE_TYPE": "string",
    "SUMMARY": "string", "ESTIMATE": "double", "OPEN_ESTIMATE": "double",
    "SWAG": "double", "PROGRAM_PRIORITY": "string", "FIX_VERSION": "string",
    "TEAM_NAME": "string", "PROGRAM_INCREMENT": "string", "STATUS": "string",
    "TARGET_START": "date", "TARGET_END": "date", "LAST_UPDATED": "timestamp_ntz",
    "RESOLVED": "timestamp_ntz", "N": "bigint",
}

_ORDER_VERSIONS = """
    case when o_orderkey % 11 = 0 then null
         when o_orderkey % 3 = 0 then '26.' || (o_orderkey % 4 + 1) || ', 26.' || (o_orderkey % 12 + 1)
         when o_orderkey % 31 = 0 then '26.9,'
         else '26.' || (o_orderkey % 12 + 1) end
"""


def _increment(day: str) -> str:
    return f"'PI ' || (year({day}) - 1970) || '.' || quarter({day})"


_ISSUE_LEVELS = {
    "region": {
        "ISSUE_KEY": "'R-' || r_regionkey", "ISSUE_TYPE": "'Customer Epic'",
        "SUMMARY": "r_name", "N": "r_regionkey",
    },
    "nation": {
        "ISSUE_KEY": "'N-' || n_nationkey", "PARENT_KEY": "'R-' || n_regionkey",
        "ISSUE_TYPE": "'Customer Capability'", "SUMMARY": "n_name", "N": "n_nationkey",
    },
    "customer": {
        "ISSUE_KEY": "'C-' || c_custkey",
        "PARENT_KEY": "case when c_custkey % 10 <> 0 then 'N-' || c_nationkey end",
        "ISSUE_TYPE": "'Sub-Capability'", "SUMMARY": "c_name",
        "ESTIMATE": "c_acctbal", "N": "c_custkey",
    },
    "orders": {
        "ISSUE_KEY": "'O-' || o_orderkey", "PARENT_KEY": "'C-' || o_custkey",
        "ISSUE_TYPE": "'Feature'", "SUMMARY": "'order ' || o_orderstatus",
        "ESTIMATE": "o_totalprice",
        "OPEN_ESTIMATE": "if(o_orderstatus = 'F', 0.0D, o_totalprice)",
        "SWAG": "o_orderkey % 100", "PROGRAM_PRIORITY": "o_orderpriority",
        "FIX_VERSION": _ORDER_VERSIONS,
        "TEAM_NAME": "'Team ' || (o_custkey % 10)",
        "PROGRAM_INCREMENT": _increment("o_orderdate"), "STATUS": "o_orderstatus",
        "TARGET_START": "cast(o_orderdate as date)",
        "TARGET_END": "cast(o_orderdate as date) + 90",
        "LAST_UPDATED": "o_orderdate + interval 5 days",
        "RESOLVED": "if(o_orderstatus = 'F', o_orderdate + interval 60 days, null)",
        "N": "o_orderkey",
    },
    "lineitem": {
        "ISSUE_KEY": "'L-' || l_orderkey || '-' || l_linenumber",
        "PARENT_KEY": "if(l_orderkey % 17 = 0, 'O-missing', 'O-' || l_orderkey)",
        "ISSUE_TYPE": "'Epic'", "SUMMARY": "'flag ' || l_returnflag",
        "ESTIMATE": "l_quantity",
        "OPEN_ESTIMATE": "if(l_linestatus = 'F', 0.0D, l_quantity)",
        "STATUS": "l_linestatus", "N": "l_orderkey",
    },
}


def issue_current(spark: SparkSession, sf_dir: str, dealt: str | None = None) -> DataFrame:
    """Current items; ``dealt`` names a table whose rows are dealt by what :func:`left_lookup`
    joins them to their parents on, and so need not be dealt in between."""
    out = None
    for name, exprs in _ISSUE_LEVELS.items():
        by = [spread_key(F.expr(exprs["PARENT_KEY"]), F.expr(exprs["ISSUE_KEY"]))] if name == dealt else None
        rows = table(spark, sf_dir, name, by).selectExpr(
            *[f"cast({exprs.get(c, 'null')} as {t}) as {c}" for c, t in _ISSUE_COLUMNS.items()]
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def issue_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _per_snapshot(issue_current(spark, sf_dir).drop("LAST_UPDATED", "RESOLVED"))
    kept = rows.where(
        "ISSUE_TYPE not in ('Feature', 'Epic')"
        " or (ISSUE_TYPE = 'Feature' and N % 23 <> K)"
        " or (ISSUE_TYPE = 'Epic' and (N + K) % 19 <> 0)"
    )
    return kept.withColumn("OPEN_ESTIMATE", F.expr("OPEN_ESTIMATE + cast(6 - K as double)"))


_STORY = {
    "ISSUE_KEY": "'S-' || l_orderkey || '-' || l_linenumber",
    "FEATURE_ID": "'O-' || l_orderkey",
    "PROJECT_KEY": "'P' || (l_suppkey % 5)",
    "PROJECT_NAME": "'Project ' || (l_suppkey % 5)",
    "TEAM_NAME": "'Team ' || l_suppkey",
    "STORY_NAME": "'story ' || l_partkey",
    "ISSUE_TYPE": "case l_returnflag when 'R' then 'Bug' when 'A' then 'Task' else 'Story' end",
    "FIX_VERSION": "case when l_partkey % 7 <> 0 then '26.' || (l_partkey % 12 + 1) end",
    "PROGRAM_INCREMENT": f"case when l_partkey % 19 <> 0 then {_increment('l_shipdate')} end",
    "SPRINT_NAME": f"""
        case when l_partkey % 13 = 0 then 'Backlog' when l_partkey % 29 = 0 then null
             else 'Team ' || l_suppkey || ' ' || {_increment('l_shipdate')} || '.'
                  || if(l_linenumber = 7, 'IP', cast(l_linenumber as string)) end""",
    "CUSTOMER_EPIC_ID": "'R-' || (l_suppkey % 3)",
    "CUSTOMER_EPIC": "'customer epic ' || (l_suppkey % 3)",
    "CUSTOMER_CAPABILITY_ID": "'N-' || (l_suppkey % 25)",
    "CUSTOMER_CAPABILITY": "'capability ' || (l_suppkey % 25)",
    "SUB_CAPABILITY_ID": "'C-' || (l_partkey % 150)",
    "SUB_CAPABILITY": "'sub-capability ' || (l_partkey % 150)",
    "FEATURE": "'order ' || l_orderkey",
    "EPIC_ID": "'L-' || l_orderkey || '-' || l_linenumber",
    "EPIC": "'flag ' || l_returnflag",
    "STORY_POINTS": "l_quantity",
    "STATUS": "if(l_linestatus = 'F', 'Done', 'In Progress')",
    "RESOLUTION": "if(l_linestatus = 'F', 'Fixed', null)",
    "CREATED": "l_shipdate - interval 40 days",
    "UPDATED": "l_shipdate",
    "RESOLVED": "if(l_linestatus = 'F', l_shipdate + interval 2 days, null)",
    "SPRINT_ACTIVATE_DATE": "l_shipdate - interval 14 days",
    "SPRINT_COMPLETE_DATE": "l_shipdate",
    "INITIAL_DATE_TO_IN_PROGRESS": "l_shipdate - interval 12 days",
    "BEGIN_DATE": "trunc(cast(l_shipdate as date), 'QUARTER') + (l_linenumber - 1) * 13",
    "END_DATE": "trunc(cast(l_shipdate as date), 'QUARTER') + (l_linenumber - 1) * 13 + 12",
    "TARGET_START": "cast(l_shipdate as date) - 10",
    "TARGET_END": "cast(l_shipdate as date) + 20",
    "LAST_UPDATED": "l_shipdate + interval 1 day",
    "N": "l_orderkey",
}


def story_source(spark: SparkSession, sf_dir: str, by: list[str] | None = None) -> DataFrame:
    """Current stories; ``by`` names the columns to deal them by."""
    return table(spark, sf_dir, "lineitem", [_STORY[c] for c in by or []]).selectExpr(
        *[f"{e} as {c}" for c, e in _STORY.items()]
    )


def story_snapshots(spark: SparkSession, sf_dir: str, by: list[str] | None = None) -> DataFrame:
    """Dated stories; ``by`` names the columns to deal them by, before the dates multiply them."""
    rows = _per_snapshot(story_source(spark, sf_dir, by).drop("LAST_UPDATED"))
    return rows.where("(N + K) % 19 <> 0").withColumns(
        {
            "CUSTOMER_EPIC": F.expr("if(N % 5 = 0, null, CUSTOMER_EPIC)"),
            "STATUS": F.expr("if(K < 3, 'In Progress', STATUS)"),
        }
    )


def stale(snapshots: DataFrame, column: str, value: str) -> DataFrame:
    """Dated rows as they were before the last date was added: the date before it is stale in ``column``."""
    last, before = SNAPSHOTS[-1][1], SNAPSHOTS[-2][1]
    rows = snapshots.where(f"SNAPSHOT_DATE < date'{last}'")
    return rows.withColumn(column, F.expr(f"if(SNAPSHOT_DATE = date'{before}', {value}, {column})"))


def cached_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature snapshots as stored before a merge; the last date is stale."""
    return issue_history(spark, sf_dir).where("ISSUE_TYPE = 'Feature' and K <= 4").selectExpr(
        "SNAPSHOT_DATE", "ISSUE_KEY", "PARENT_KEY", "ESTIMATE",
        "if(K = 4, OPEN_ESTIMATE + 1.0D, OPEN_ESTIMATE) as OPEN_ESTIMATE",
    )


def recent_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refetched feature snapshots: some keys are not delivered again, and there
    is a column the stored ones lack."""
    rows = recent_rows(issue_history(spark, sf_dir).where("ISSUE_TYPE = 'Feature'"), AS_OF)
    return rows.where("ISSUE_KEY not like '%7'").select(
        "SNAPSHOT_DATE", "ISSUE_KEY", "PARENT_KEY", "ESTIMATE", "OPEN_ESTIMATE", "SUMMARY"
    )
