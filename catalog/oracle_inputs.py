"""The derived inputs in SQL for the checking engine."""

_ISSUE_NULLS = "null, null, null, null, null, null, null"

INPUTS = {
    "fx_snapshots": """
        select 0 as K, date '1998-01-05' as SNAPSHOT_DATE
        union all select 1, date '1998-01-12'
        union all select 2, date '1998-01-19'
        union all select 3, date '1998-01-26'
        union all select 4, date '1998-02-02'
        union all select 6, date '1998-02-16'
    """,
    "fx_issue_current": f"""
        select 'R-' || cast(r_regionkey as string) as ISSUE_KEY, cast(null as string) as PARENT_KEY,
               'Customer Epic' as ISSUE_TYPE, r_name as SUMMARY,
               cast(null as double) as ESTIMATE, cast(null as double) as OPEN_ESTIMATE,
               cast(null as double) as SWAG, cast(null as string) as PROGRAM_PRIORITY,
               cast(null as string) as FIX_VERSION, cast(null as string) as TEAM_NAME,
               cast(null as string) as PROGRAM_INCREMENT, cast(null as string) as STATUS,
               cast(null as date) as TARGET_START, cast(null as date) as TARGET_END,
               cast(null as timestamp) as LAST_UPDATED, cast(null as timestamp) as RESOLVED,
               cast(r_regionkey as bigint) as N
        from region
        union all
        select 'N-' || cast(n_nationkey as string), 'R-' || cast(n_regionkey as string),
               'Customer Capability', n_name, null, null, null, null, null, {_ISSUE_NULLS},
               cast(n_nationkey as bigint)
        from nation
        union all
        select 'C-' || cast(c_custkey as string),
               case when c_custkey % 10 = 0 then null else 'N-' || cast(c_nationkey as string) end,
               'Sub-Capability', c_name, c_acctbal, null, null, null, null, {_ISSUE_NULLS}, c_custkey
        from customer
        union all
        select 'O-' || cast(o_orderkey as string), 'C-' || cast(o_custkey as string), 'Feature',
               'order ' || o_orderstatus, o_totalprice,
               case when o_orderstatus = 'F' then 0.0 else o_totalprice end,
               cast(o_orderkey % 100 as double), o_orderpriority,
               case when o_orderkey % 11 = 0 then null
                    when o_orderkey % 3 = 0 then '26.' || cast(o_orderkey % 4 + 1 as string)
                         || ', 26.' || cast(o_orderkey % 12 + 1 as string)
                    when o_orderkey % 31 = 0 then '26.9,'
                    else '26.' || cast(o_orderkey % 12 + 1 as string) end,
               'Team ' || cast(o_custkey % 10 as string),
               'PI ' || cast(year(o_orderdate) - 1970 as string) || '.' || cast(quarter(o_orderdate) as string),
               o_orderstatus, cast(o_orderdate as date), cast(o_orderdate as date) + 90,
               o_orderdate + interval 5 days,
               case when o_orderstatus = 'F' then o_orderdate + interval 60 days end, o_orderkey
        from orders
        union all
        select 'L-' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string),
               case when l_orderkey % 17 = 0 then 'O-missing' else 'O-' || cast(l_orderkey as string) end,
               'Epic', 'flag ' || l_returnflag, l_quantity,
               case when l_linestatus = 'F' then 0.0 else l_quantity end, null, null, null,
               null, null, l_linestatus, null, null, null, null, l_orderkey
        from lineitem
    """,
    "fx_issue_history": """
        select s.SNAPSHOT_DATE, i.ISSUE_KEY, i.PARENT_KEY, i.ISSUE_TYPE, i.SUMMARY, i.ESTIMATE,
               i.OPEN_ESTIMATE + cast(6 - s.K as double) as OPEN_ESTIMATE, i.SWAG,
               i.PROGRAM_PRIORITY, i.FIX_VERSION, i.TEAM_NAME, i.PROGRAM_INCREMENT, i.STATUS,
               i.TARGET_START, i.TARGET_END, s.K
        from fx_issue_current i cross join fx_snapshots s
        where i.ISSUE_TYPE not in ('Feature', 'Epic')
           or (i.ISSUE_TYPE = 'Feature' and i.N % 23 <> s.K)
           or (i.ISSUE_TYPE = 'Epic' and (i.N + s.K) % 19 <> 0)
    """,
    "fx_story_current": """
        select 'S-' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as ISSUE_KEY,
               'O-' || cast(l_orderkey as string) as FEATURE_ID,
               'P' || cast(l_suppkey % 5 as string) as PROJECT_KEY,
               'Project ' || cast(l_suppkey % 5 as string) as PROJECT_NAME,
               'Team ' || cast(l_suppkey as string) as TEAM_NAME,
               'story ' || cast(l_partkey as string) as STORY_NAME,
               case l_returnflag when 'R' then 'Bug' when 'A' then 'Task' else 'Story' end as ISSUE_TYPE,
               case when l_partkey % 7 = 0 then null
                    else '26.' || cast(l_partkey % 12 + 1 as string) end as FIX_VERSION,
               case when l_partkey % 19 = 0 then null
                    else 'PI ' || cast(year(l_shipdate) - 1970 as string) || '.'
                         || cast(quarter(l_shipdate) as string) end as PROGRAM_INCREMENT,
               case when l_partkey % 13 = 0 then 'Backlog' when l_partkey % 29 = 0 then null
                    else 'Team ' || cast(l_suppkey as string) || ' PI '
                         || cast(year(l_shipdate) - 1970 as string) || '.'
                         || cast(quarter(l_shipdate) as string) || '.'
                         || case when l_linenumber = 7 then 'IP' else cast(l_linenumber as string) end
               end as SPRINT_NAME,
               'R-' || cast(l_suppkey % 3 as string) as CUSTOMER_EPIC_ID,
               'customer epic ' || cast(l_suppkey % 3 as string) as CUSTOMER_EPIC,
               'N-' || cast(l_suppkey % 25 as string) as CUSTOMER_CAPABILITY_ID,
               'capability ' || cast(l_suppkey % 25 as string) as CUSTOMER_CAPABILITY,
               'C-' || cast(l_partkey % 150 as string) as SUB_CAPABILITY_ID,
               'sub-capability ' || cast(l_partkey % 150 as string) as SUB_CAPABILITY,
               'order ' || cast(l_orderkey as string) as FEATURE,
               'L-' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as EPIC_ID,
               'flag ' || l_returnflag as EPIC,
               l_quantity as STORY_POINTS,
               case when l_linestatus = 'F' then 'Done' else 'In Progress' end as STATUS,
               case when l_linestatus = 'F' then 'Fixed' end as RESOLUTION,
               l_shipdate - interval 40 days as CREATED,
               l_shipdate as UPDATED,
               case when l_linestatus = 'F' then l_shipdate + interval 2 days end as RESOLVED,
               l_shipdate - interval 14 days as SPRINT_ACTIVATE_DATE,
               l_shipdate as SPRINT_COMPLETE_DATE,
               l_shipdate - interval 12 days as INITIAL_DATE_TO_IN_PROGRESS,
               cast(date_trunc('quarter', l_shipdate) as date) + (l_linenumber - 1) * 13 as BEGIN_DATE,
               cast(date_trunc('quarter', l_shipdate) as date) + (l_linenumber - 1) * 13 + 12 as END_DATE,
               cast(l_shipdate as date) - 10 as TARGET_START,
               cast(l_shipdate as date) + 20 as TARGET_END,
               l_shipdate + interval 1 day as LAST_UPDATED,
               l_orderkey as N
        from lineitem
    """,
    "fx_story_history": """
        select s.SNAPSHOT_DATE, s.K, t.* exclude (LAST_UPDATED) replace (
               case when t.N % 5 = 0 then null else t.CUSTOMER_EPIC end as CUSTOMER_EPIC,
               case when s.K < 3 then 'In Progress' else t.STATUS end as STATUS)
        from fx_story_current t cross join fx_snapshots s
        where (t.N + s.K) % 19 <> 0
    """,
    "fx_cached_history": """
        select SNAPSHOT_DATE, ISSUE_KEY, PARENT_KEY, ESTIMATE,
               case when K = 4 then OPEN_ESTIMATE + 1.0 else OPEN_ESTIMATE end as OPEN_ESTIMATE
        from fx_issue_history where ISSUE_TYPE = 'Feature' and K <= 4
    """,
    "fx_recent_history": """
        select SNAPSHOT_DATE, ISSUE_KEY, PARENT_KEY, ESTIMATE, OPEN_ESTIMATE, SUMMARY
        from fx_issue_history
        where ISSUE_TYPE = 'Feature'
          and SNAPSHOT_DATE >= timestamp '1998-03-04 00:00:00' - interval 30 days
          and ISSUE_KEY not like '%7'
    """,
}
