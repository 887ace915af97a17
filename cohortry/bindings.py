"""Canonical views of the study platform, built from the star-schema tables.

Each view is one SELECT in the SQL that Spark and an oracle engine share; ``{ARRAY}``, ``{EMPTY}`` and the like stand
for what they spell differently. Times are epoch milliseconds, so both compute with plain integers.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .session import prepare

RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations")
DAY = 86_400_000
FIRST_DAY = 1_704_067_200_000  # 2024-01-01

SPARK = {
    "ARRAY": "array", "EMPTY": "cast(array() as array<string>)", "MILLIS": "unix_millis(cast({0} as timestamp))", "STR": "string",
    "MAP": "map({0})", "TS": "timestamp_millis({0})",
}
DUCK = {
    "ARRAY": "list_value", "EMPTY": "cast([] as varchar[])", "MILLIS": "(epoch_us({0}) // 1000)", "STR": "varchar",
    "MAP": "", "TS": "make_timestamp(({0}) * 1000)",
}

VIEWS = {
    "uploads": """select concat('app', cast(user_id % 4 as {STR})) as app_id, event_id as upload_id, user_id, event_type as status,
        {MILLIS(ts)} as requested_ms from {events}""",
    "activity_events": """select concat('app', cast(user_id % 4 as {STR})) as app_id, user_id, event_type as event_id, event_id as seq,
        {MILLIS(ts)} as ts_ms from {events}""",
    "request_info": """select concat('app', cast(user_id % 4 as {STR})) as app_id, user_id,
        max(case when event_type = 'click' then {MILLIS(ts)} end) as signed_in_ms,
        max(case when event_type = 'purchase' then {MILLIS(ts)} end) as uploaded_ms from {events} group by user_id""",
    "participants": """select concat('app', cast(c_custkey % 4 as {STR})) as app_id, c_custkey as user_id, concat('hc', cast(c_custkey as {STR})) as health_code,
        case when c_custkey % 5 = 0 then 'disabled' when c_custkey % 5 = 1 then 'unverified' else 'enabled' end as status,
        case when c_custkey % 3 = 0 then 'no_sharing' when c_custkey % 3 = 1 then 'sponsors_and_partners' else 'all_qualified_researchers' end as sharing_scope,
        case when c_custkey % 11 = 0 then {ARRAY}('developer') when c_custkey % 13 = 0 then {ARRAY}('researcher') when c_custkey % 14 = 0 then {ARRAY}('study_coordinator') else {EMPTY} end as roles,
        case when c_custkey % 17 = 0 then {ARRAY}('test_user', 'groupB') when c_custkey % 7 = 0 then {ARRAY}('groupB', 'groupA') when c_custkey % 6 = 0 then {ARRAY}('clinical_consent') else {EMPTY} end as data_groups,
        {ARRAY}(concat('study', cast(c_nationkey as {STR})), concat('study', cast((c_nationkey + 7) % 25 as {STR}))) as study_ids,
        case when c_custkey % 6 = 0 then null when c_custkey % 6 = 1 then '-07:00' when c_custkey % 6 = 2 then '-05:00' when c_custkey % 6 = 3 then '+01:00' when c_custkey % 6 = 4 then '-11:00' else '-01:00' end as time_zone,
        case when c_custkey % 9 = 0 then false when c_custkey % 9 = 1 then null else true end as phone_verified,
        case when c_custkey % 8 = 0 then null else concat('+1555', cast(c_custkey as {STR})) end as phone,
        case when c_custkey % 4 = 0 then null else concat(lower(replace(c_name, '#', '.')), '@example.org') end as email,
        c_custkey % 10 <> 3 as email_verified, {FIRST_DAY} + (c_custkey % 30) * {DAY} as created_ms, c_mktsegment as segment from {customer}""",
    "consents": """select c_custkey as user_id, {FIRST_DAY} + (c_custkey % 20) * {DAY} as signed_ms, case when c_custkey % 12 = 5 then {FIRST_DAY} + 25 * {DAY} end as withdrew_ms from {customer} where c_custkey % 10 <> 9
        union all select c_custkey, {FIRST_DAY} + 27 * {DAY}, cast(null as bigint) from {customer} where c_custkey % 24 = 5""",
    "studies": """select concat('app', cast(r_regionkey % 4 as {STR})) as app_id, concat('study', cast(n_nationkey as {STR})) as study_id, n_name as study_name,
        case when n_nationkey % 6 = 5 then null else concat('schedule', cast(n_nationkey % 10 as {STR})) end as schedule_guid,
        case when n_nationkey % 5 = 0 then 'design' when n_nationkey % 5 = 1 then 'recruitment' when n_nationkey % 5 = 2 then 'in_flight' when n_nationkey % 5 = 3 then 'legacy' else 'completed' end as phase,
        case when n_nationkey % 7 = 0 then null else 40 + n_nationkey end as threshold,
        case when n_nationkey % 8 = 7 then null else n_nationkey % 4 <> 3 end as export_enabled, n_nationkey % 9 <> 8 as configured,
        case when n_nationkey % 10 = 9 then null else concat('table', cast(n_nationkey as {STR})) end as table_id,
        case when n_nationkey % 11 = 10 then null else concat('view', cast(n_nationkey as {STR})) end as view_id,
        n_nationkey % 3 = 0 as upload_table, case when n_nationkey % 12 = 11 then null else concat('project', cast(n_nationkey as {STR})) end as project_id,
        concat('team', cast(n_nationkey as {STR})) as team_id from {nation} join {region} on n_regionkey = r_regionkey""",
    "records": """select o_orderkey as record_id, o_custkey as user_id, concat('app', cast(o_custkey % 4 as {STR})) as app_id,
        case when o_orderkey % 5 = 0 then 'no_sharing' else 'all_qualified_researchers' end as sharing_scope,
        case when o_orderkey % 3 = 0 then concat('schedule', cast(o_orderkey % 10 as {STR})) end as schedule_guid,
        concat('file ', cast(o_orderkey as {STR}), '.json') as filename, {MILLIS(o_orderdate)} as created_ms, o_orderkey % 4 as version, o_orderpriority as priority from {orders}""",
    "scheduled_activities": """select user_id, 'task' as task_id, min({MILLIS(ts)}) as scheduled_ms, max(case when event_type = 'purchase' then 'finished' else 'assigned' end) as status, min(event_id) as seq
        from {events} group by user_id, event_type, cast(ts as date)""",
    "notification_log": """select user_id, {MILLIS(ts)} as time_ms, case when event_id % 5 = 0 then null when event_id % 5 = 1 then '' when event_id % 5 = 2 then 'PRE_BURST' else 'EARLY' end as type, event_id as seq from {events} where event_type = 'view'""",
    "upload_rows": """select event_id as record_id, concat('study', cast(user_id % 25 as {STR})) as study_id, event_type as assessment_guid, {MILLIS(ts)} as created_ms, event_id % 17 = 0 as is_test,
        concat('hc', cast(user_id as {STR})) as health_code, case when event_id % 6 = 0 then null else event_id % 4 end as participant_version, event_id % 3 as kind, props from {events}""",
    "data_rows": """select l_orderkey * 10 + l_linenumber as record_id, concat('hc', cast(o_custkey as {STR})) as health_code, o_custkey as user_id, cast(o_orderdate as date) as upload_date,
        case when l_linenumber % 3 = 0 then '' else concat('fh-', cast(l_partkey as {STR})) end as bar, case when l_linenumber % 2 = 0 then null else concat('fh-', cast(l_suppkey as {STR})) end as baz, l_returnflag as foo
        from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    "file_summaries": """select concat('fh-', cast(p_partkey as {STR})) as file_handle_id, case when p_partkey % 4 <> 0 then concat('entry-', cast(p_partkey as {STR})) end as zip_entry, case when p_partkey % 8 = 0 then 'service error' end as failure, p_partkey as seq from {part} where p_partkey % 3 <> 0""",
    "requests": """select s_suppkey as request_id, concat('app', cast(s_suppkey % 4 as {STR})) as app_id, s_suppkey as user_id, date '1995-01-01' as start_date, date '1997-06-30' as end_date from {supplier}""",
    "weekly_reports": """select c_custkey as user_id, concat('study', cast(c_nationkey as {STR})) as study_id, case when c_custkey % 9 = 0 then null else c_custkey * 7 % 101 end as weekly_percent from {customer} where c_custkey % 4 <> 3""",
    "schemas": """select concat('app', cast(p_size % 4 as {STR})) as app_id, concat('schema', cast(p_partkey % 97 as {STR})) as schema_id, p_size as revision from {part}""",
    "table_map": """select distinct concat('app', cast(p_size % 4 as {STR})) as app_id, concat('schema', cast(p_partkey % 97 as {STR})) as schema_id, p_size as revision, concat('table', cast(p_partkey % 41 as {STR})) as table_id from {part} where p_partkey % 5 <> 0""",
    "report_data": """select user_id, case when event_id % 3 = 0 then 'Engagement' else 'Other' end as report_id, case when event_id % 2 = 0 then '2000-12-31' else '2001-01-01' end as report_date, event_id as seq,
        case when event_id % 7 = 0 then 'not json' when event_id % 5 = 0 then '{{"other":1}}' else concat('{{"benefits":"reason ', cast(event_id as {STR}), '"}}') end as data from {events}""",
}


def _render(name: str, dialect: dict[str, str], raw: str) -> str:
    text = re.sub(r"\{(\w+)\(([^()]*)\)\}", lambda m: dialect[m[1]].format(m[2]), VIEWS[name])
    for key in ("ARRAY", "EMPTY", "STR"):
        text = text.replace("{" + key + "}", dialect[key])
    text = text.replace("{DAY}", f"cast({DAY} as bigint)").replace("{FIRST_DAY}", str(FIRST_DAY))
    for t in RAW:
        text = text.replace("{" + t + "}", raw.format(t))
    return text.replace("{{", "{").replace("}}", "}")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.sql(_render(name, SPARK, "parquet.`" + sf_dir + "/{0}.parquet`"))


def with_views(names: str, sql: str) -> str:
    """An oracle query over canonical views."""
    return "with " + ", ".join(f"{n} as ({_render(n, DUCK, '{0}')})" for n in names.split()) + " " + sql
