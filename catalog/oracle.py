"""The registered queries in SQL for the checking engine.

Written from the definitions, level by level and with plain distincts and row
numbers, so that the rearranged Spark plans are compared with something simple.
"""

from __future__ import annotations

from catalog.oracle_inputs import INPUTS

_AS_OF = "timestamp '1998-03-04 00:00:00'"
_TODAY = "date '1998-03-04'"


def _title(name: str) -> str:
    return " ".join(w.capitalize() for w in name.lower().split("_"))


def _titled(columns: str, source: str = "") -> str:
    prefix = f"{source}." if source else ""
    return ", ".join(f'{prefix}"{c}" as "{_title(c)}"' for c in columns.split())


def _latest(view: str, keys: str, newest: str, rest: str) -> str:
    order = [f"{c} desc nulls last" for c in newest.split()]
    order += [f"{c} asc nulls first" for c in rest.split()]
    some = " and ".join(f"{k} is not null" for k in keys.split())
    return f"""select * exclude (rn) from (
        select *, row_number() over (partition by {', '.join(keys.split())}
                                     order by {', '.join(order)}) as rn
        from {view} where {some}) where rn = 1"""


# --- shared parts ------------------------------------------------------------
_FLAT = """PROGRAM, CUSTEPIC_KEY, CUSTCAP_ESTIMATE, CUSTCAP_KEY, SUBCAPABILITY_KEY,
    FEATURE_KEY, FEATURE_SUMMARY, FEATURE_ESTIMATE, FEATURE_OPEN_ESTIMATE, FEATURE_SWAG, BV,
    FEATURE_FIX_VERSION, EPIC_SUMMARY, EPIC_ESTIMATE, EPIC_OPEN_ESTIMATE"""

_FLAT_SELECT = """
    ce.SUMMARY as PROGRAM, ce.ISSUE_KEY as CUSTEPIC_KEY, ce.ESTIMATE as CUSTCAP_ESTIMATE,
    cc.ISSUE_KEY as CUSTCAP_KEY, sc.ISSUE_KEY as SUBCAPABILITY_KEY,
    ft.ISSUE_KEY as FEATURE_KEY, ft.SUMMARY as FEATURE_SUMMARY, ft.ESTIMATE as FEATURE_ESTIMATE,
    ft.OPEN_ESTIMATE as FEATURE_OPEN_ESTIMATE, ft.SWAG as FEATURE_SWAG,
    ft.PROGRAM_PRIORITY as BV, ft.FIX_VERSION as FEATURE_FIX_VERSION,
    ep.SUMMARY as EPIC_SUMMARY, ep.ESTIMATE as EPIC_ESTIMATE, ep.OPEN_ESTIMATE as EPIC_OPEN_ESTIMATE
"""


def _flatten(view: str, dated: bool) -> str:
    def day(upper: str, lower: str) -> str:
        return f" and {upper}.SNAPSHOT_DATE = {lower}.SNAPSHOT_DATE" if dated else ""

    def level(name: str, kind: str, columns: str) -> str:
        dates = "SNAPSHOT_DATE, " if dated else ""
        return f"""{name} as materialized (
            select {dates}ISSUE_KEY, PARENT_KEY, SUMMARY, {columns} from {view} where ISSUE_TYPE = '{kind}')"""

    return f"""with {level('ep', 'Epic', 'ESTIMATE, OPEN_ESTIMATE')},
    {level('ft', 'Feature', 'ESTIMATE, OPEN_ESTIMATE, SWAG, PROGRAM_PRIORITY, FIX_VERSION')},
    {level('sc', 'Sub-Capability', 'ESTIMATE')},
    {level('cc', 'Customer Capability', 'ESTIMATE')},
    {level('ce', 'Customer Epic', 'ESTIMATE')}
    select {'ep.SNAPSHOT_DATE,' if dated else ''} ep.ISSUE_KEY as EPIC_KEY, {_FLAT_SELECT}
    from ep
    left join ft on ft.ISSUE_KEY = ep.PARENT_KEY{day('ft', 'ep')}
    left join sc on sc.ISSUE_KEY = ft.PARENT_KEY{day('sc', 'ft')}
    left join cc on cc.ISSUE_KEY = sc.PARENT_KEY{day('cc', 'sc')}
    left join ce on ce.ISSUE_KEY = cc.PARENT_KEY{day('ce', 'cc')}
    """


def _story_select(alias: str, day: str, updated: str, epic: str) -> str:
    a = alias
    return f"""
    {a}.ISSUE_KEY as STORY_NUMBER, {a}.PROJECT_KEY, {a}.PROJECT_NAME, {a}.SPRINT_NAME,
    {a}.TEAM_NAME, {a}.STORY_NAME, {a}.ISSUE_TYPE as STORY_TYPE, {day} as SNAPSHOT_DATE,
    {updated} as LAST_UPDATED, {a}.CREATED as CREATE_DATE, {a}.UPDATED, {a}.BEGIN_DATE,
    {a}.END_DATE, {a}.SPRINT_ACTIVATE_DATE, {a}.SPRINT_COMPLETE_DATE, {a}.TARGET_START,
    {a}.TARGET_END, {a}.INITIAL_DATE_TO_IN_PROGRESS, {a}.RESOLVED as CLOSED_DATE, {a}.STATUS,
    {a}.RESOLUTION, {a}.FIX_VERSION, {a}.STORY_POINTS as ESTIMATE, {a}.PROGRAM_INCREMENT,
    {a}.CUSTOMER_EPIC_ID, {epic} as CUSTOMER_EPIC, {a}.CUSTOMER_CAPABILITY_ID,
    {a}.CUSTOMER_CAPABILITY, {a}.SUB_CAPABILITY_ID, {a}.SUB_CAPABILITY, {a}.FEATURE_ID,
    {a}.FEATURE, {a}.EPIC_ID, {a}.EPIC"""


_NO_DAY = "cast(null as date)"
_NO_TIME = "cast(null as timestamp)"


def _story_history(snapshots: str, stories: str) -> str:
    epic = "coalesce(s.CUSTOMER_EPIC, h.CUSTOMER_EPIC)"
    return f"""select {_story_select('h', 'h.SNAPSHOT_DATE', _NO_TIME, epic)}
    from {snapshots} h left join {stories} s on h.ISSUE_KEY = s.ISSUE_KEY"""


_STORY_COLUMNS = """STORY_NUMBER PROJECT_KEY PROJECT_NAME SPRINT_NAME TEAM_NAME STORY_NAME
    STORY_TYPE SNAPSHOT_DATE LAST_UPDATED CREATE_DATE UPDATED BEGIN_DATE END_DATE
    SPRINT_ACTIVATE_DATE SPRINT_COMPLETE_DATE TARGET_START TARGET_END
    INITIAL_DATE_TO_IN_PROGRESS CLOSED_DATE STATUS RESOLUTION FIX_VERSION ESTIMATE
    PROGRAM_INCREMENT CUSTOMER_EPIC_ID CUSTOMER_EPIC CUSTOMER_CAPABILITY_ID
    CUSTOMER_CAPABILITY SUB_CAPABILITY_ID SUB_CAPABILITY FEATURE_ID FEATURE EPIC_ID EPIC"""

_FEATURES = f"""
    select OPEN_ESTIMATE as FEATURE_OPEN_POINTS, ESTIMATE as FEATURE_TOTAL_POINTS,
           TEAM_NAME as FEATURE_TEAM, ISSUE_KEY as FEATURE_ID, PROGRAM_INCREMENT as FEATURE_PI,
           FIX_VERSION as FEATURE_FIX_VERSION, STATUS as FEATURE_STATUS,
           {_NO_DAY} as SNAPSHOT_DATE, TARGET_START, TARGET_END,
           LAST_UPDATED as IMET_SUMMARY_LAST_UPDATED, PROGRAM_PRIORITY as BV, SWAG,
           RESOLVED as ACTUAL_END_DATE
    from fx_issue_current where ISSUE_TYPE = 'Feature'
    union all
    select OPEN_ESTIMATE, ESTIMATE, TEAM_NAME, ISSUE_KEY, PROGRAM_INCREMENT, FIX_VERSION, STATUS,
           SNAPSHOT_DATE, TARGET_START, TARGET_END, null, PROGRAM_PRIORITY, SWAG, null
    from fx_issue_history where ISSUE_TYPE = 'Feature'
"""


def _rollup(view: str, keys: str) -> str:
    return f"""
    select {keys}, sum(STORY_POINTS) as TOTAL_ESTIMATE,
           sum(case when STATUS = 'Done' then STORY_POINTS else 0 end) as DONE_ESTIMATE,
           sum(STORY_POINTS) - sum(case when STATUS = 'Done' then STORY_POINTS else 0 end) as OPEN_ESTIMATE,
           count(*) as SPRINT_COUNT, min(BEGIN_DATE) as BEGIN_DATE, max(END_DATE) as END_DATE
    from {view} group by {keys}"""


_AGILE_NOW = _rollup("fx_story_current", "FEATURE_ID, PROGRAM_INCREMENT")
_AGILE_DATED = _rollup("fx_story_history", "FEATURE_ID, SNAPSHOT_DATE, PROGRAM_INCREMENT")

_AT_END = r"nullif(regexp_extract(SPRINT_NAME, '(\d{2,4}\.\d+\.(?:\d+|IP))\s*$', 1), '')"
_ANYWHERE = r"nullif(regexp_extract(SPRINT_NAME, '(\d{2}\.\d.\w+)', 1), '')"


def _key(version: str) -> str:
    def part(i: int) -> str:
        return f"coalesce(try_cast(string_split({version}, '.')[{i}] as bigint), 0)"

    return f"""(({part(1)} % 100) * 10000 + {part(2)} * 100
        + case when string_split({version}, '.')[3] = 'IP' then 99 else {part(3)} end)"""


def _label(key: str) -> str:
    return f"""(cast({key} // 10000 as string) || '.' || cast(({key} % 10000) // 100 as string)
        || '.' || case when {key} % 100 = 99 then 'IP' else cast({key} % 100 as string) end)"""


_WINDOWS = """select distinct SNAPSHOT_DATE, PROGRAM_INCREMENT, SPRINT_NAME, BEGIN_DATE, END_DATE
    from fx_story_history"""
_WINDOWS_NOW = """select distinct PROGRAM_INCREMENT, SPRINT_NAME, BEGIN_DATE, END_DATE
    from fx_story_current"""


def _range(windows: str, keys: str) -> str:
    return f"""
    select {keys}, {_label('lo')} as MIN_SPRINT, {_label('hi')} as MAX_SPRINT from (
        select {keys}, min(k) as lo, max(k) as hi
        from (select *, {_key('v')} as k from (select *, {_AT_END} as v from ({windows})))
        group by {keys})"""


def _current(windows: str, keys: str) -> str:
    return f"""select distinct {keys}, {_ANYWHERE} as CURRENT_SPRINT from ({windows})
    where BEGIN_DATE <= {_TODAY} and END_DATE >= {_TODAY}"""


_RANGE_H = _range(_WINDOWS, "SNAPSHOT_DATE, PROGRAM_INCREMENT")
_RANGE_C = _range(_WINDOWS_NOW, "PROGRAM_INCREMENT")
_CURRENT_H = _current(_WINDOWS, "SNAPSHOT_DATE, PROGRAM_INCREMENT")
_CURRENT_C = _current(_WINDOWS_NOW, "PROGRAM_INCREMENT")

_SPRINT_JOINS = f"""
    left join ({_RANGE_H}) rh on rh.SNAPSHOT_DATE = r.SNAPSHOT_DATE and rh.PROGRAM_INCREMENT = r.PROGRAM_INCREMENT
    left join ({_RANGE_C}) rc on rc.PROGRAM_INCREMENT = r.PROGRAM_INCREMENT"""
_CURRENT_JOINS = f"""
    left join ({_CURRENT_H}) ch on ch.SNAPSHOT_DATE = r.SNAPSHOT_DATE and ch.PROGRAM_INCREMENT = r.PROGRAM_INCREMENT
    left join ({_CURRENT_C}) cc on cc.PROGRAM_INCREMENT = r.PROGRAM_INCREMENT"""

_EXPECTED = f"""select cast(date_trunc('week', {_TODAY}) as date) - 7 * cast(i as integer) as SNAPSHOT_DATE
    from range(4) t(i)"""


def _missing(history: str) -> str:
    return f"""select SNAPSHOT_DATE from ({_EXPECTED})
    where SNAPSHOT_DATE <> {_TODAY}
      and SNAPSHOT_DATE not in (select SNAPSHOT_DATE from {history} where SNAPSHOT_DATE is not null)"""


_MERGED = f"""
    with kept as (
        select c.* from fx_cached_history c
        anti join fx_recent_history r on r.ISSUE_KEY = c.ISSUE_KEY and r.SNAPSHOT_DATE = c.SNAPSHOT_DATE),
    merged as (
        select SNAPSHOT_DATE, ISSUE_KEY, PARENT_KEY, ESTIMATE, OPEN_ESTIMATE,
               cast(null as string) as SUMMARY, 0 as SRC from kept
        union all
        select SNAPSHOT_DATE, ISSUE_KEY, PARENT_KEY, ESTIMATE, OPEN_ESTIMATE, SUMMARY, 1
        from fx_recent_history),
    one as ({_latest('merged', 'ISSUE_KEY SNAPSHOT_DATE', 'SRC', 'PARENT_KEY ESTIMATE OPEN_ESTIMATE SUMMARY')})
"""
_MERGED_COLUMNS = "SNAPSHOT_DATE, ISSUE_KEY, PARENT_KEY, ESTIMATE, OPEN_ESTIMATE"

_SNAPSHOT_REST = """FEATURE_ID PROJECT_KEY PROJECT_NAME TEAM_NAME STORY_NAME ISSUE_TYPE
    FIX_VERSION PROGRAM_INCREMENT SPRINT_NAME CUSTOMER_EPIC_ID CUSTOMER_EPIC
    CUSTOMER_CAPABILITY_ID CUSTOMER_CAPABILITY SUB_CAPABILITY_ID SUB_CAPABILITY FEATURE EPIC_ID
    EPIC STORY_POINTS STATUS RESOLUTION CREATED RESOLVED SPRINT_ACTIVATE_DATE
    SPRINT_COMPLETE_DATE INITIAL_DATE_TO_IN_PROGRESS BEGIN_DATE END_DATE TARGET_START TARGET_END"""

_STORY_HISTORY_ONE = f"""
    one_snapshot as ({_latest('fx_story_history', 'ISSUE_KEY SNAPSHOT_DATE', 'UPDATED', _SNAPSHOT_REST)}),
    one_story as ({_latest('fx_story_current', 'ISSUE_KEY', 'UPDATED', _SNAPSHOT_REST + ' LAST_UPDATED')}),
    hist as ({_story_history('one_snapshot', 'one_story')})"""

_STORIES = f"""
    with {_STORY_HISTORY_ONE},
    cur as (select {_story_select('s', _NO_DAY, 's.LAST_UPDATED', 's.CUSTOMER_EPIC')} from fx_story_current s),
    gaps as ({_missing('hist')}),
    rows_ as (
        select distinct * from (
            select *, cast(null as boolean) as IS_SYNTHETIC from cur
            union all
            select *, false from hist
            union all
            select cur.* replace (gaps.SNAPSHOT_DATE as SNAPSHOT_DATE), true from cur cross join gaps)),
    feats as ({_FEATURES}),
    joined as (
        select r.* replace ({_AS_OF} as LAST_UPDATED,
                            coalesce(r.SNAPSHOT_DATE, {_TODAY}) as SNAPSHOT_DATE),
               f.* exclude (FEATURE_ID, SNAPSHOT_DATE, TARGET_START, TARGET_END),
               f.TARGET_START as TARGET_START_EPICS, f.TARGET_END as TARGET_END_EPICS,
               r.PROJECT_NAME || ' ' || r.FIX_VERSION as PROJECT_NAME_VERSION,
               {_ANYWHERE.replace('SPRINT_NAME', 'r.SPRINT_NAME')} as SPRINT_NAME_ALT,
               coalesce(cast(r.SNAPSHOT_DATE as timestamp), {_AS_OF}) as SNAPSHOT_DATE_ALT,
               substr({_ANYWHERE.replace('SPRINT_NAME', 'r.SPRINT_NAME')}, 1, 4) as PI_FROM_SPRINT
        from rows_ r left join feats f
          on f.FEATURE_ID is not distinct from r.FEATURE_ID
         and f.SNAPSHOT_DATE is not distinct from r.SNAPSHOT_DATE)
    select {_titled(_STORY_COLUMNS + ''' IS_SYNTHETIC FEATURE_OPEN_POINTS FEATURE_TOTAL_POINTS
        FEATURE_TEAM FEATURE_PI FEATURE_FIX_VERSION FEATURE_STATUS TARGET_START_EPICS
        TARGET_END_EPICS IMET_SUMMARY_LAST_UPDATED BV SWAG ACTUAL_END_DATE PROJECT_NAME_VERSION
        SPRINT_NAME_ALT SNAPSHOT_DATE_ALT PI_FROM_SPRINT''')}
    from joined"""

_ISSUE_REST = "PARENT_KEY SUMMARY ESTIMATE OPEN_ESTIMATE SWAG PROGRAM_PRIORITY FIX_VERSION"

_AGILE = "PROGRAM_INCREMENT, TOTAL_ESTIMATE, DONE_ESTIMATE, OPEN_ESTIMATE, SPRINT_COUNT, BEGIN_DATE, END_DATE"

_EPICS_WITH = f"""
    with one_issue as ({_latest('fx_issue_history', 'ISSUE_KEY SNAPSHOT_DATE ISSUE_TYPE', '', _ISSUE_REST)}),
    cur as ({_flatten('fx_issue_current', False)}),
    hist as ({_flatten('one_issue', True)}),
    gaps as ({_missing('hist')}),
    filled as (
        select SNAPSHOT_DATE, EPIC_KEY, {_FLAT}, false as IS_SYNTHETIC from hist
        union all
        select gaps.SNAPSHOT_DATE, EPIC_KEY, {_FLAT}, true from cur cross join gaps),
    agile_now as ({_AGILE_NOW}),
    agile_dated as ({_AGILE_DATED}),
    r as (
        select distinct * from (
            select cast(null as date) as SNAPSHOT_DATE, EPIC_KEY, {_FLAT},
                   cast(null as boolean) as IS_SYNTHETIC, {_AGILE}
            from cur left join agile_now a on a.FEATURE_ID = cur.FEATURE_KEY
            union all
            select filled.SNAPSHOT_DATE, EPIC_KEY, {_FLAT}, IS_SYNTHETIC, {_AGILE}
            from filled left join agile_dated a
              on a.FEATURE_ID = filled.FEATURE_KEY and a.SNAPSHOT_DATE = filled.SNAPSHOT_DATE)),
    marked as (
        select r.*, {_AS_OF} as LAST_UPDATED,
               coalesce(cast(r.SNAPSHOT_DATE as timestamp), {_AS_OF}) as SNAPSHOT_DATE_ALT,
               coalesce(rh.MIN_SPRINT, rc.MIN_SPRINT) as MIN_SPRINT,
               coalesce(rh.MAX_SPRINT, rc.MAX_SPRINT) as MAX_SPRINT,
               coalesce(ch.CURRENT_SPRINT, cc.CURRENT_SPRINT) as CURRENT_SPRINT
        from r {_SPRINT_JOINS} {_CURRENT_JOINS})"""

_EPIC_COLUMNS = f"""EPIC_KEY {_FLAT.replace(',', ' ')} {_AGILE.replace(',', ' ')}
    SNAPSHOT_DATE IS_SYNTHETIC LAST_UPDATED SNAPSHOT_DATE_ALT MIN_SPRINT MAX_SPRINT CURRENT_SPRINT"""

_EPICS = f"""{_EPICS_WITH}
    select {_titled(_EPIC_COLUMNS)}
    from (select * replace (coalesce(SNAPSHOT_DATE, {_TODAY}) as SNAPSHOT_DATE) from marked)"""


def _releases(source: str, where: str) -> str:
    return f"""parts as (
        select s.* exclude (FEATURE_FIX_VERSION), trim(p.part) as FEATURE_FIX_VERSION
        from {source} s,
             lateral unnest(coalesce(string_split(s.FEATURE_FIX_VERSION, ','), [null])) p(part)
        where {where} (s.FEATURE_KEY is not null or s.SUBCAPABILITY_KEY is not null)),
    span as (
        select FEATURE_KEY, min(FEATURE_FIX_VERSION) as MIN_TARGET_RELEASE,
               max(FEATURE_FIX_VERSION) as MAX_TARGET_RELEASE
        from parts group by FEATURE_KEY)
    select parts.*, span.MIN_TARGET_RELEASE, span.MAX_TARGET_RELEASE
    from parts join span on parts.FEATURE_KEY = span.FEATURE_KEY"""


_EVENT_KINDS = [
    ("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"),
    ("event_type", "string"), ("value", "double"), ("props", "string"),
]


def _profile(view: str, columns: list[tuple[str, str]]) -> str:
    """``columns``: (name, type as Spark prints it)."""
    ordered = {"bigint", "int", "double", "date", "timestamp_ntz"}

    def line(i: int, name: str, kind: str) -> str:
        lo, hi = (
            (f"cast(min({name}) as string)", f"cast(max({name}) as string)")
            if kind in ordered else ("cast(null as string)",) * 2
        )
        return f"""
        select {i} as POSITION, '{name}' as COLUMN_NAME, '{kind}' as DATA_TYPE,
               count(*) as ROW_COUNT, count(*) - count({name}) as NULLS,
               round((count(*) - count({name})) * 100.0 / count(*), 4) as NULL_PCT,
               count(distinct {name}) + max(case when {name} is null then 1 else 0 end) as UNIQUES,
               {lo} as MIN_VALUE, {hi} as MAX_VALUE
        from {view}"""

    return " union all ".join(line(i, n, k) for i, (n, k) in enumerate(columns))


_STORED_KINDS = [
    ("ISSUE_KEY", "string"), ("PARENT_KEY", "string"), ("ESTIMATE", "double"), ("OPEN_ESTIMATE", "double"),
    ("SUMMARY", "string"), ("SNAPSHOT_DATE", "date"),
]

_STORY_KINDS = [
    (c, "string") for c in """ISSUE_KEY FEATURE_ID PROJECT_KEY PROJECT_NAME TEAM_NAME STORY_NAME
    ISSUE_TYPE FIX_VERSION PROGRAM_INCREMENT SPRINT_NAME CUSTOMER_EPIC_ID CUSTOMER_EPIC
    CUSTOMER_CAPABILITY_ID CUSTOMER_CAPABILITY SUB_CAPABILITY_ID SUB_CAPABILITY FEATURE EPIC_ID
    EPIC""".split()
] + [
    ("STORY_POINTS", "double"), ("STATUS", "string"), ("RESOLUTION", "string"),
    ("CREATED", "timestamp_ntz"), ("UPDATED", "timestamp_ntz"), ("RESOLVED", "timestamp_ntz"),
    ("SPRINT_ACTIVATE_DATE", "timestamp_ntz"), ("SPRINT_COMPLETE_DATE", "timestamp_ntz"),
    ("INITIAL_DATE_TO_IN_PROGRESS", "timestamp_ntz"), ("BEGIN_DATE", "date"), ("END_DATE", "date"),
    ("TARGET_START", "date"), ("TARGET_END", "date"), ("SNAPSHOT_DATE", "date"),
]

_TABLE_COLUMNS = {
    "benchmark": 2, "conversations": 4, "customer": 5, "documents": 5, "embeddings": 3,
    "events": 6, "labels": 3, "lineitem": 11, "nation": 3, "orders": 6, "pages": 3, "part": 6,
    "region": 2, "supplier": 4,
}

_RECENT = f"SNAPSHOT_DATE >= {_AS_OF} - interval 30 days"

_BODIES = {
    "hierarchy_flatten_current": _flatten("fx_issue_current", False),
    "hierarchy_flatten_snapshots": _flatten("fx_issue_history", True),
    "hierarchy_flatten_recent": _flatten(
        f"(select * from fx_issue_history where {_RECENT})", True
    ),
    "story_current": f"""select {_story_select('s', _NO_DAY, 's.LAST_UPDATED', 's.CUSTOMER_EPIC')}
        from fx_story_current s""",
    "story_history_enriched": _story_history("fx_story_history", "fx_story_current"),
    "story_history_recent": _story_history("fx_story_history", "fx_story_current")
        + f" where h.{_RECENT}",
    "feature_lookup": _FEATURES,
    "agile_rollup_current": _AGILE_NOW,
    "agile_rollup_snapshots": _AGILE_DATED,
    "sprint_windows": _WINDOWS,
    "sprint_windows_current": _WINDOWS_NOW,
    "sprint_version_key": f"""
        select *, {_label('SORT_KEY')} as VERSION_TEXT from (
            select *, {_key('SPRINT_VERSION')} as SORT_KEY from (
                select ISSUE_KEY, SPRINT_NAME, {_AT_END} as SPRINT_VERSION,
                       {_ANYWHERE} as SPRINT_NAME_ALT,
                       substr({_ANYWHERE}, 1, 4) as PI_FROM_SPRINT
                from fx_story_current))""",
    "sprint_range": _RANGE_H,
    "sprint_range_current": _RANGE_C,
    "sprint_range_window": f"""
        select SNAPSHOT_DATE, PROGRAM_INCREMENT, SPRINT_NAME, BEGIN_DATE, END_DATE,
               v as SPRINT_VERSION, {_label('lo')} as MIN_SPRINT, {_label('hi')} as MAX_SPRINT
        from (select *, min(k) over (partition by SNAPSHOT_DATE, PROGRAM_INCREMENT) as lo,
                     max(k) over (partition by SNAPSHOT_DATE, PROGRAM_INCREMENT) as hi
              from (select *, {_key('v')} as k from (select *, {_AT_END} as v from ({_WINDOWS}))))""",
    "current_sprint": _CURRENT_H,
    "current_sprint_group": _CURRENT_C,
    "coerce_columns": """
        select ORDER_KEY, trim(PRIORITY, chr(9) || chr(10) || chr(32) || chr(160)) as PRIORITY,
               try_cast(AMOUNT as double) as AMOUNT, try_cast(ORDERED as timestamp) as ORDERED,
               try_cast(DAY as date) as SNAPSHOT_DATE, cast(null as string) as NOTE
        from (select o_orderkey as ORDER_KEY,
                     chr(9) || ' ' || o_orderpriority || chr(160) || chr(10) as PRIORITY,
                     case o_orderkey % 5 when 0 then 'n/a' when 1 then cast(o_custkey as string) || '.5'
                          when 2 then cast(o_custkey as string) || '.0f'
                          when 3 then '-' || cast(o_custkey as string) || 'e1'
                          else cast(o_custkey as string) end as AMOUNT,
                     case o_orderkey % 4 when 0 then 'not a date' when 1 then cast(o_orderdate as string)
                          else cast(cast(o_orderdate as date) as string) end as ORDERED,
                     cast(cast(o_orderdate as date) as string) as DAY
              from orders)""",
    "align_union_distinct": """
        select distinct * from (
            select o_orderkey as ORDER_KEY, cast(cast(o_orderdate as date) as timestamp) as DAY,
                   cast(o_custkey as string) as CUSTOMER, cast(null as double) as AMOUNT,
                   cast(null as string) as NOTE, cast(null as string) as PRIORITY
            from orders
            union all
            select o_orderkey, o_orderdate, cast(o_custkey as string),
                   case when o_orderstatus = 'F' then o_totalprice end, null,
                   case when o_orderstatus = 'O' then o_orderpriority end
            from orders)""",
    "latest_per_key": "select ISSUE_KEY, SNAPSHOT_DATE, UPDATED, STORY_POINTS, SPRINT_NAME, STATUS from ("
        + _latest("fx_story_history", "ISSUE_KEY SNAPSHOT_DATE", "UPDATED",
                  "STORY_POINTS SPRINT_NAME STATUS") + ")",
    "without_refetched": """
        select c.* from fx_cached_history c anti join fx_recent_history r
          on r.ISSUE_KEY = c.ISSUE_KEY and r.SNAPSHOT_DATE = c.SNAPSHOT_DATE""",
    "snapshot_merge": f"{_MERGED} select {_MERGED_COLUMNS}, SUMMARY from one",
    "history_store_merge": f"{_MERGED} select {_MERGED_COLUMNS}, SUMMARY from one",
    "history_store_refresh": f"{_MERGED} select {_MERGED_COLUMNS} from one",
    "history_store_stats": f"""{_MERGED}
        select SNAPSHOT_DATE, count(*) as ROW_COUNT, min(ISSUE_KEY) as LEAST_KEY, max(ISSUE_KEY) as GREATEST_KEY
        from one group by SNAPSHOT_DATE""",
    "merge_retention": f"""{_MERGED}
        select *, ROWS_AFTER >= ROWS_BEFORE * 0.98 as ACCEPTED from (
            select (select count(*) from fx_cached_history) as ROWS_BEFORE,
                   (select count(*) from one) as ROWS_AFTER)""",
    "snapshot_calendar": """
        select DAY, cast(date_trunc('week', DAY) as date) - 7 * cast(i as integer) as SNAPSHOT_DATE
        from (select distinct cast(ts as date) as DAY from events) cross join range(4) t(i)""",
    "snapshot_gap_fill": f"""
        with feature_now as (select * from fx_issue_current where ISSUE_TYPE = 'Feature'),
        feature_then as (select * from fx_issue_history where ISSUE_TYPE = 'Feature'),
        gaps as ({_missing('feature_then')})
        select SNAPSHOT_DATE, ISSUE_KEY, PARENT_KEY, ESTIMATE, OPEN_ESTIMATE, FIX_VERSION,
               false as IS_SYNTHETIC from feature_then
        union all
        select gaps.SNAPSHOT_DATE, ISSUE_KEY, PARENT_KEY, ESTIMATE, OPEN_ESTIMATE, FIX_VERSION, true
        from feature_now cross join gaps""",
    "fallback_lookup": f"""
        select r.ISSUE_KEY, r.SNAPSHOT_DATE, r.PROGRAM_INCREMENT,
               coalesce(rh.MIN_SPRINT, rc.MIN_SPRINT) as MIN_SPRINT,
               coalesce(rh.MAX_SPRINT, rc.MAX_SPRINT) as MAX_SPRINT
        from (select ISSUE_KEY, SNAPSHOT_DATE, PROGRAM_INCREMENT from fx_story_history
              union all
              select ISSUE_KEY, null, PROGRAM_INCREMENT from fx_story_current) r {_SPRINT_JOINS}""",
    "null_safe_lookup": f"""
        with feats as ({_FEATURES}),
        r as (select ISSUE_KEY, FEATURE_ID, {_NO_DAY} as SNAPSHOT_DATE, TARGET_START from fx_story_current
              union all
              select ISSUE_KEY, FEATURE_ID, SNAPSHOT_DATE, TARGET_START from fx_story_history)
        select r.*, f.* exclude (FEATURE_ID, SNAPSHOT_DATE, TARGET_START),
               f.TARGET_START as "TARGET_START_epics"
        from r left join feats f on f.FEATURE_ID is not distinct from r.FEATURE_ID
                                and f.SNAPSHOT_DATE is not distinct from r.SNAPSHOT_DATE""",
    "agile_join_snapshots": f"""
        with flat as ({_flatten('fx_issue_history', True)}), a as ({_AGILE_DATED})
        select flat.*, a.* exclude (FEATURE_ID, SNAPSHOT_DATE)
        from flat left join a on a.FEATURE_ID = flat.FEATURE_KEY and a.SNAPSHOT_DATE = flat.SNAPSHOT_DATE""",
    "agile_join_current": f"""
        with flat as ({_flatten('fx_issue_current', False)}), a as ({_AGILE_NOW})
        select flat.*, a.* exclude (FEATURE_ID)
        from flat left join a on a.FEATURE_ID = flat.FEATURE_KEY""",
    "story_columns": f"""
        with r as (
            select {_story_select('s', _NO_DAY, 's.LAST_UPDATED', 's.CUSTOMER_EPIC')} from fx_story_current s
            union all {_story_history('fx_story_history', 'fx_story_current')})
        select STORY_NUMBER as "Story Number", coalesce(SNAPSHOT_DATE, {_TODAY}) as "Snapshot Date",
               PROJECT_NAME as "Project Name", FIX_VERSION as "Fix Version",
               SPRINT_NAME as "Sprint Name", {_AS_OF} as "Last Updated",
               PROJECT_NAME || ' ' || FIX_VERSION as "Project Name Version",
               {_ANYWHERE} as "Sprint Name Alt",
               coalesce(cast(SNAPSHOT_DATE as timestamp), {_AS_OF}) as "Snapshot Date Alt",
               substr({_ANYWHERE}, 1, 4) as "Pi From Sprint"
        from r""",
    "epic_columns": f"""
        with flat_now as ({_flatten('fx_issue_current', False)}),
        flat_then as ({_flatten('fx_issue_history', True)}),
        agile_now as ({_AGILE_NOW}), agile_dated as ({_AGILE_DATED}),
        r as (
            select EPIC_KEY, FEATURE_KEY, {_NO_DAY} as SNAPSHOT_DATE, PROGRAM_INCREMENT, TOTAL_ESTIMATE
            from flat_now left join agile_now a on a.FEATURE_ID = FEATURE_KEY
            union all
            select EPIC_KEY, FEATURE_KEY, flat_then.SNAPSHOT_DATE, PROGRAM_INCREMENT, TOTAL_ESTIMATE
            from flat_then left join agile_dated a
              on a.FEATURE_ID = FEATURE_KEY and a.SNAPSHOT_DATE = flat_then.SNAPSHOT_DATE)
        select EPIC_KEY as "Epic Key", FEATURE_KEY as "Feature Key", r.SNAPSHOT_DATE as "Snapshot Date",
               r.PROGRAM_INCREMENT as "Program Increment", TOTAL_ESTIMATE as "Total Estimate",
               {_AS_OF} as "Last Updated",
               coalesce(cast(r.SNAPSHOT_DATE as timestamp), {_AS_OF}) as "Snapshot Date Alt",
               coalesce(rh.MIN_SPRINT, rc.MIN_SPRINT) as "Min Sprint",
               coalesce(rh.MAX_SPRINT, rc.MAX_SPRINT) as "Max Sprint",
               coalesce(ch.CURRENT_SPRINT, cc.CURRENT_SPRINT) as "Current Sprint"
        from r {_SPRINT_JOINS} {_CURRENT_JOINS}""",
    "split_versions": """
        select ISSUE_KEY, trim(p.part) as FIX_VERSION
        from fx_issue_current, lateral unnest(coalesce(string_split(FIX_VERSION, ','), [null])) p(part)
        where ISSUE_TYPE = 'Feature'""",
    "release_range": f"""
        with flat as (select *, {_NO_DAY} as SNAPSHOT_DATE from ({_flatten('fx_issue_current', False)})),
        {_releases('flat', '')}""",
    "release_null_counts": f"""
        select count(*) as ROW_COUNT, count(*) - count(SNAPSHOT_DATE) as SNAPSHOT_DATE,
               count(*) - count(FEATURE_KEY) as FEATURE_KEY,
               count(*) - count(SUBCAPABILITY_KEY) as SUBCAPABILITY_KEY
        from ({_flatten('fx_issue_history', True)})""",
    "table_profile": _profile("orders", [
        ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
        ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"),
    ]),
    "table_profile_events": _profile("events", _EVENT_KINDS),
    "table_profile_documents": _profile("documents", [
        ("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
        ("n_chars", "bigint"),
    ]),
    "table_profile_stories": _profile("fx_story_history", _STORY_KINDS),
    "table_profile_total": f"""
        select cast(sum(NULLS) as bigint) as NULLS, round(sum(NULLS) * 100.0 / sum(ROW_COUNT), 4) as NULL_PCT
        from ({_profile('fx_story_history', _STORY_KINDS)})""",
    "profile_by_date": f"""{_MERGED}, stored as (select {_MERGED_COLUMNS}, SUMMARY from one),
        lines as ({_profile('stored', _STORED_KINDS)})
        select POSITION, COLUMN_NAME, DATA_TYPE, ROW_COUNT, NULLS, NULL_PCT, UNIQUES, true as CLOSE,
               MIN_VALUE, MAX_VALUE
        from lines""",
    "profile_estimate_facts": f"""
        select COLUMN_NAME, ROW_COUNT, NULLS, UNIQUES, true as CLOSE, MIN_VALUE, MAX_VALUE
        from ({_profile('fx_story_history', _STORY_KINDS)})""",
    "csv_inferred": "select o_orderkey, o_totalprice, o_orderpriority from orders",
    "sample_facts": """
        select least(count(*), 50) as ROW_COUNT, least(count(*), 50) as DIFFERENT, least(count(*), 50) as FOUND
        from events""",
    "adhoc_sql": """
        select f.PROGRAM_PRIORITY, s.ISSUE_TYPE as STORY_TYPE, count(*) as STORY_COUNT,
               sum(s.STORY_POINTS) as POINTS, min(s.BEGIN_DATE) as FIRST_BEGIN
        from fx_story_current s join fx_issue_current f on s.FEATURE_ID = f.ISSUE_KEY
        where f.ISSUE_TYPE = 'Feature' and s.STATUS = 'Done'
        group by f.PROGRAM_PRIORITY, s.ISSUE_TYPE""",
    "adhoc_top": """
        select FEATURE_ID, sum(STORY_POINTS) as POINTS, count(*) as STORY_COUNT
        from fx_story_current group by FEATURE_ID order by POINTS desc, FEATURE_ID limit 100""",
    "save_and_requery": """
        select TEAM_NAME, max(POINTS) as MOST, count(*) as STATES
        from (select TEAM_NAME, STATUS, sum(STORY_POINTS) as POINTS from fx_story_current
              group by TEAM_NAME, STATUS)
        group by TEAM_NAME""",
    "folder_tables": " union all ".join(
        f"select '{n}' as TABLE_NAME, count(*) as ROW_COUNT, {k} as COLUMN_COUNT from {n}"
        for n, k in _TABLE_COLUMNS.items()
    ),
    "table_count": "select count(*) as ROW_COUNT from lineitem",
    "csv_round_trip": _AGILE_NOW,
    "parquet_round_trip": _AGILE_DATED,
    "stories_table": _STORIES,
    "stories_report_stored": _STORIES,
    "stories_report_incremental": _STORIES,
    "epics_table": _EPICS,
    "epics_report_stored": _EPICS,
    "epics_report_incremental": _EPICS,
    "release_diagnostics": f"""{_EPICS_WITH}
        select count(*) as ROW_COUNT, count(*) - count(SNAPSHOT_DATE) as SNAPSHOT_DATE,
               count(*) - count(FEATURE_KEY) as FEATURE_KEY,
               count(*) - count(SUBCAPABILITY_KEY) as SUBCAPABILITY_KEY
        from marked""",
    "sprint_null_rate": " union all ".join(
        f"""select '{name}' as SPRINTS, count(*) as ROW_COUNT, count(*) - count(v) as NULLS,
                   (count(*) - count(v)) / count(*) > 0.1 as WARNED
            from (select {_AT_END} as v from ({windows}))"""
        for name, windows in (("dated", _WINDOWS), ("current", _WINDOWS_NOW))
    ),
    "table_schema": " union all ".join(
        f"select cast({i} as integer) as POSITION, '{name}' as COLUMN_NAME, '{kind}' as DATA_TYPE"
        for i, (name, kind) in enumerate(_EVENT_KINDS)
    ),
    "epics_release_range": f"{_EPICS_WITH}, {_releases('marked', 's.SNAPSHOT_DATE is null and')}",
    "published_tables": """
        select h.SNAPSHOT_DATE, count(*) as FEATURES, count(s.FEATURE_ID) as WITH_STORIES
        from fx_cached_history h
        left join (select distinct FEATURE_ID from fx_story_current) s on s.FEATURE_ID = h.ISSUE_KEY
        group by h.SNAPSHOT_DATE""",
}


def _statement(body: str) -> str:
    """The query with the derived inputs as common table expressions."""
    needed: list[str] = []

    def need(sql: str) -> None:
        for name, definition in INPUTS.items():
            if name in sql and name not in needed:
                need(definition)
                needed.append(name)

    need(body)
    inputs = [f"{name} as ({INPUTS[name]})" for name in needed]
    body = body.strip()
    if body.startswith("with "):
        inputs.append(body[len("with "):])
        return "with " + ",\n".join(inputs)
    return (f"with {', '.join(inputs)}\n" if inputs else "") + body


ORACLE = {name: _statement(body) for name, body in _BODIES.items()}
