"""Queries of fan-out, exports, tabulation, results, extracts, rosters and streams."""

from __future__ import annotations

import json
import tempfile
import zipfile

from pyspark.sql import functions as F

from ..bindings import DAY, FIRST_DAY, view, with_views
from ..operators import aggregates as A
from ..operators import filters as P
from ..operators import flatten as L
from ..operators import joins as J
from ..session import prepare, table
from ..sources import readers as R
from ..sources import sinks as K
from ..sources.merged import merge_latest as merge_into
from ..sources.merged import merged
from ..sources.published import published
from ..streaming import streams as X
from .extensions import summarize
from .registry import query
from .report_queries import _REPORTABLE, _reportable


def _folder(spark, name: str) -> str:
    """A new folder that all executors see: under the checkpoint folder, or a temporary one on a local master."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        import uuid

        return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"{name}-") + "/out"


def _apps(spark, sf_dir):
    return view(spark, sf_dir, "studies").select("app_id").distinct().withColumns({"export_enabled": F.col("app_id") != "app3", "configured": F.lit(True), "upload_table": F.when(F.col("app_id") != "app2", F.col("app_id") != "app1")})


def _versions(spark, sf_dir):
    people = view(spark, sf_dir, "participants")
    pairs = F.expr("map_from_entries(transform(study_ids, (s, i) -> struct(s, if(i = 0, concat('ext', cast(user_id as string)), '<none>'))))")
    return people.select("app_id", "user_id", "health_code", (F.col("user_id") % 5).cast("int").alias("participant_version"), "created_ms", (F.col("created_ms") + 1).alias("modified_ms"), "data_groups", F.array(F.lit("en-US"), F.lit("language")).alias("languages"), "sharing_scope", pairs.alias("study_memberships"), "time_zone", "study_ids")


_ON = "(select distinct study_id from studies where export_enabled is true and configured is true)"
_VFAN = f"""(select p.user_id, p.app_id, s.study_id from (select user_id, app_id, unnest(study_ids) as study_id from participants) p join {_ON} s on s.study_id = p.study_id
    union all select user_id, app_id, null from participants where app_id <> 'app3' and app_id in (select app_id from studies))"""
_FAN = f"""(select record_id, r.app_id, m.study_id from records r join (select distinct user_id, unnest(study_ids) as study_id from participants) m on m.user_id = r.user_id join {_ON} s on s.study_id = m.study_id
    where r.schedule_guid is null or exists (select 1 from studies x where x.schedule_guid = r.schedule_guid and x.study_id = m.study_id)
    union all select record_id, app_id, null from records where app_id <> 'app3' and app_id in (select app_id from studies))"""


def _fanout(spark, sf_dir, carry=()):
    studies, records = view(spark, sf_dir, "studies"), view(spark, sf_dir, "records").withColumn("content_md5", F.base64(F.unhex(F.md5("priority"))))
    return J.study_fanout(records, view(spark, sf_dir, "participants"), studies.filter("schedule_guid is not null"), studies, _apps(spark, sf_dir), carry)


@query(with_views("records participants studies", f"select record_id, app_id, coalesce(study_id, '') as study_id from {_FAN}"))
def study_fanout(spark, sf_dir):
    return _fanout(spark, sf_dir).select("record_id", "app_id", F.coalesce("study_id", F.lit("")).alias("study_id"))


@query(with_views("participants studies", f"select user_id, app_id, coalesce(study_id, '') as study_id from {_VFAN}"))
def version_fanout(spark, sf_dir):
    return J.version_fanout(_versions(spark, sf_dir), view(spark, sf_dir, "studies"), _apps(spark, sf_dir)).select("user_id", "app_id", F.coalesce("study_id", F.lit("")).alias("study_id"))


@query(with_views("participants studies", f"select user_id, concat_ws('.', app_id, study_id) as table_id, user_id % 5 as participant_version, 'hc' || user_id as health_code from {_VFAN} where user_id in (select o_custkey from orders)"))
def redrive_versions(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id"))
    out = J.redrive_versions(ids, _versions(spark, sf_dir), view(spark, sf_dir, "studies"), _apps(spark, sf_dir))
    return out.select("user_id", "table_id", F.col("participant_version").cast("long").alias("participant_version"), "health_code")


@query("select c_custkey as user_id from customer where c_custkey not in (select o_custkey from orders where o_orderkey % 7 = 0)")
def backfill_candidates(spark, sf_dir):
    return J.backfill_candidates(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id")), table(spark, sf_dir, "orders").filter("o_orderkey % 7 = 0").select(F.col("o_custkey").alias("user_id")))


@query("select c_custkey as user_id, unnest(case c_custkey % 3 when 0 then ['sleep-api'] when 1 then ['activity-api', 'sleep-api'] else ['activity-api'] end) as endpoint_id from customer")
def user_endpoint_pairs(spark, sf_dir):
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.expr("case c_custkey % 3 when 0 then array('sleep', 'other') when 1 then array('activity', 'sleep') else array('activity') end").alias("scopes"))
    return J.user_endpoint_pairs(users, spark.createDataFrame([("activity-api", "activity"), ("sleep-api", "sleep")], "endpoint_id string, scope string"))


@query("select o_orderkey, o_orderpriority as own, case when exists (select 1 from part where p_partkey = o_orderkey % 997 and p_partkey % 2 = 0) then (select p_name from part where p_partkey = o_orderkey % 997) else '' end as timeline from orders")
def timeline_enrich(spark, sf_dir):
    records = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 997).alias("instance_guid"), F.create_map(F.lit("own"), "o_orderpriority").alias("metadata"))
    timeline = table(spark, sf_dir, "part").filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("instance_guid"), F.create_map(F.lit("timeline"), "p_name").alias("metadata"))
    out = J.timeline_enrich(records, timeline)
    return out.select("o_orderkey", F.col("metadata")["own"].alias("own"), F.coalesce(F.try_element_at("metadata", F.lit("timeline")), F.lit("")).alias("timeline"))


@query("select l_orderkey, l_linenumber, coalesce(case when l_partkey % 3 = 0 then p_name when l_partkey % 3 = 1 then p_brand end, '') as title from lineitem left join part on p_partkey = l_partkey")
def assessment_lookup(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    of = lambda k, c: part.filter(F.col("p_partkey") % 3 == k).select(F.col("p_partkey").alias("assessment_guid"), F.col(c).alias("title"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("assessment_guid"))
    return J.assessment_lookup(rows, of(0, "p_name"), of(1, "p_brand").unionByName(of(0, "p_brand"))).select("l_orderkey", "l_linenumber", F.coalesce("title", F.lit("")).alias("title"))


@query("select o_orderkey * 2 as upload_id from orders where o_orderkey in (select l_orderkey from lineitem where l_quantity > 45)")
def resolve_upload_ids(spark, sf_dir):
    ids = table(spark, sf_dir, "lineitem").filter("l_quantity > 45").select(F.col("l_orderkey").alias("id")).distinct()
    uploads = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("record_id"), (F.col("o_orderkey") * 2).alias("upload_id"))
    return J.resolve_upload_ids(ids, uploads, "record_id")




@query(with_views("data_rows file_summaries", "select d.record_id, d.bar is null or trim(d.bar) = '' as blank, case when trim(coalesce(d.bar, '')) = '' then '' else coalesce(f.zip_entry, f.failure, 'Unknown error downloading attachment') end as bar, case when trim(coalesce(d.baz, '')) = '' then '' else coalesce(g.zip_entry, g.failure, 'Unknown error downloading attachment') end as baz from data_rows d left join file_summaries f on f.file_handle_id = d.bar left join file_summaries g on g.file_handle_id = d.baz"))
def replace_file_handles(spark, sf_dir):
    out = J.replace_file_handles(view(spark, sf_dir, "data_rows"), view(spark, sf_dir, "file_summaries"), ["bar", "baz"])
    return out.select("record_id", (F.trim(F.coalesce("bar", F.lit(""))) == "").alias("blank"), F.coalesce("bar", F.lit("")).alias("bar"), F.coalesce("baz", F.lit("")).alias("baz"))


_EXTRACT = "(select q.request_id, d.* from data_rows d join participants p on p.health_code = d.health_code join requests q on q.user_id = p.user_id where upload_date between start_date and end_date)"


def _extract(spark, sf_dir):
    return J.user_data_extract(*(view(spark, sf_dir, v) for v in ("requests", "participants", "data_rows")))


_TABLES = f"""(select request_id, 'rows' as table_id, 'data' as kind, record_id as key from {_EXTRACT} where foo <> 'N' union all select request_id, 'returns', 'data', record_id from {_EXTRACT} where foo = 'N'
    union all select request_id, 'metadata', 'survey', threshold from studies s join requests q on q.app_id = s.app_id where threshold is not null)"""


def _tables(spark, sf_dir):
    rows, studies = view(spark, sf_dir, "data_rows"), view(spark, sf_dir, "studies").filter("threshold is not null").select("app_id", "study_id", F.col("threshold").cast("long").alias("record_id"))
    return J.extract_tables(*(view(spark, sf_dir, v) for v in ("requests", "participants")), {"rows": rows.filter("foo <> 'N'"), "returns": rows.filter("foo = 'N'")}, {"metadata": studies})


@query(with_views("data_rows participants requests studies", f"select request_id, table_id, kind, cast(key as bigint) as key from {_TABLES}"))
def user_data_extract(spark, sf_dir):
    return _tables(spark, sf_dir).select("request_id", "table_id", "kind", F.get_json_object("row", "$.record_id").cast("long").alias("key"))


@query(with_views("data_rows participants requests", f"select request_id, foo as table_id, count(*) as n from {_EXTRACT} group by all"))
def drop_empty_extracts(spark, sf_dir):
    rows = _extract(spark, sf_dir).select("request_id", F.col("foo").alias("table_id"), "record_id")
    headers = view(spark, sf_dir, "requests").select("request_id", F.lit("X").alias("table_id"), F.lit(None).cast("bigint").alias("record_id"))
    return P.drop_empty_extracts(rows.unionByName(headers))


@query(with_views("data_rows", "select distinct h as file_handle_id from (select bar as h from data_rows union all select baz from data_rows) where trim(coalesce(h, '')) <> ''"))
def distinct_attachments(spark, sf_dir):
    return A.distinct_attachments(view(spark, sf_dir, "data_rows"), ["bar", "baz"])


@query(with_views("data_rows", "select record_id, '' as health_code, foo from data_rows"))
def mask_identifier(spark, sf_dir):
    return L.mask_identifier(view(spark, sf_dir, "data_rows"), "health_code").select("record_id", F.coalesce("health_code", F.lit("")).alias("health_code"), "foo")


@query(with_views("data_rows participants requests studies", f"select r.request_id, coalesce(n_tables, 0) as n_tables, coalesce(n_rows, 0) as n_rows, coalesce(n_surveys, 0) as n_surveys, coalesce(n_errors, 0) as n_errors, case when coalesce(n_tables, 0) = 0 then 'no data' when coalesce(n_errors, 0) > 0 then 'with errors' else 'ok' end as status from requests r left join (select request_id, count(distinct table_id) filter (kind = 'data') as n_tables, count(*) as n_rows, count(*) filter (kind = 'survey') as n_surveys from {_TABLES} group by all) e on e.request_id = r.request_id left join (select request_id, 1 as n_errors from requests where request_id % 4 = 0) f on f.request_id = r.request_id"))
def write_extract_bundle(spark, sf_dir):
    requests = view(spark, sf_dir, "requests")
    path = _folder(spark, "bundle")
    K.write_extract_bundle(_tables(spark, sf_dir), requests.filter("request_id % 4 = 0").select("request_id", F.lit("Error downloading survey: no such table").alias("message")), path)
    data, surveys, errors = (K.read_extract_bundle(spark, path, kind).withColumn("request_id", F.col("request_id").cast("long")) for kind in K.BUNDLE)
    status = K.extract_status(requests, data, errors)
    n = data.withColumn("survey", F.lit(0)).unionByName(surveys.withColumn("survey", F.lit(1))).filter("get_json_object(row, '$.record_id') is not null").groupBy("request_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("survey").alias("n_surveys"))
    return status.join(n, "request_id", "left").select("request_id", "n_tables", F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows"), F.coalesce("n_surveys", F.lit(0).cast("long")).alias("n_surveys"), "n_errors", "status")


@query(with_views("participants", "select user_id, case when email is not null and email_verified then 'email' when phone is not null and phone_verified then 'phone' else 'invalid' end as channel, coalesce(case when email is not null and email_verified then email when phone is not null and phone_verified then phone end, '') as address from participants"))
def contact_channel(spark, sf_dir):
    return L.contact_channel(view(spark, sf_dir, "participants")).select("user_id", "channel", F.coalesce("address", F.lit("")).alias("address"))


@query(with_views("schemas table_map", "select table_id, app_id, schema_id, revision from (select m.*, row_number() over (partition by m.table_id order by m.revision desc, m.app_id desc, m.schema_id desc) as k from schemas s join table_map m on m.app_id = s.app_id and m.schema_id = s.schema_id and m.revision = s.revision) where k = 1"))
def canonical_schemas(spark, sf_dir):
    return J.canonical_schemas(view(spark, sf_dir, "schemas"), view(spark, sf_dir, "table_map"))


@query(with_views("table_map", "select schema_id, table_id, revision, app_id from table_map where table_id not in (select concat('table', cast(l_partkey % 41 as varchar)) from lineitem where l_partkey % 41 < 20)"))
def stale_mappings(spark, sf_dir):
    tables = table(spark, sf_dir, "lineitem").filter("l_partkey % 41 < 20").select(F.concat(F.lit("table"), (F.col("l_partkey") % 41).cast("string")).alias("table_id")).distinct()
    return J.stale_mappings(view(spark, sf_dir, "table_map"), tables).select("schema_id", "table_id", "revision", "app_id")


@query("select concat(p_brand, cast(p_partkey as varchar)) as schema_id, case p_size % 3 when 0 then 'rawData,a,b' when 1 then 'rawData,b' else 'rawData' end as columns from part")
def attachment_columns(spark, sf_dir):
    types = F.expr("case p_size % 3 when 0 then map('b', 'ATTACHMENT_BLOB', 'a', 'attachment_v2', 'c', 'INT') when 1 then map('b', 'Attachment_Csv', 'c', 'STRING') else map('c', 'STRING') end")
    schemas = table(spark, sf_dir, "part").select(F.concat("p_brand", F.col("p_partkey").cast("string")).alias("schema_id"), types.alias("field_types"))
    return L.attachment_columns(schemas).select("schema_id", F.array_join("columns", ",").alias("columns"))


_PAIRS = f"(select distinct p.app_id, p.user_id, s.study_id, s.threshold, w.weekly_percent from (select distinct app_id, user_id, unnest(study_ids) as study_id from participants) p join ({_REPORTABLE}) s on s.app_id = p.app_id and s.study_id = p.study_id join weekly_reports w on w.user_id = p.user_id and w.study_id = p.study_id)"


def _pairs(spark, sf_dir):
    return J.adherence_pairs(view(spark, sf_dir, "participants"), _reportable(spark, sf_dir), view(spark, sf_dir, "weekly_reports"))


@query(with_views("participants studies weekly_reports", f"select app_id, user_id, study_id from {_PAIRS}"))
def adherence_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir).select("app_id", "user_id", "study_id")


@query(with_views("participants studies weekly_reports", f"select app_id, user_id, study_id, weekly_percent from {_PAIRS} where weekly_percent < coalesce(threshold, 0)"))
def out_of_compliance(spark, sf_dir):
    return A.out_of_compliance(_pairs(spark, sf_dir)).select("app_id", "user_id", "study_id", "weekly_percent")


@query(with_views("participants", "select cast(user_id as varchar) as user_id, app_id, '' as roles, coalesce(cast(phone_verified as varchar), '') as phone_verified, coalesce(time_zone, '') as time_zone, '{\"a\":' || cast(user_id as varchar) || '}' as attributes from participants"))
def flatten_roster(spark, sf_dir):
    people = view(spark, sf_dir, "participants").select("user_id", "app_id", "roles", "phone_verified", "time_zone", F.create_map(F.lit("a"), "user_id").alias("attributes"), F.lit("x").alias("type"), F.lit("7").alias("platform_user_id"))
    return L.flatten_roster(people, (*L.ROSTER_EXCLUDED, "platform_user_id"))


@query(with_views("uploads", "select coalesce(case when upload_id % 11 = 0 then 'submission_error' when upload_id % 13 = 0 then 'completion_error' end, lower(status)) as metric, count(*) as n from uploads group by all"))
def redrive_metrics(spark, sf_dir):
    return A.redrive_metrics(view(spark, sf_dir, "uploads").withColumn("error", F.expr("case when upload_id % 11 = 0 then 'submission_error' when upload_id % 13 = 0 then 'completion_error' end")))


@query("select event_id, service, error, case when error is null or error = 'unknown service' then 'b' || cast(event_id as varchar) else '' end as body from (select event_id, case event_id % 4 when 0 then 'one' when 1 then 'two' when 2 then 'other' else '' end as service, case event_id % 4 when 2 then 'unknown service' when 3 then 'bad message' end as error from events)")
def route_requests(spark, sf_dir):
    value = F.expr("case event_id % 4 when 3 then 'not json' else concat('{\"service\":\"', case event_id % 4 when 0 then 'one' when 1 then 'two' else 'other' end, '\",\"body\":\"b', cast(event_id as string), '\"}') end")
    messages = table(spark, sf_dir, "events").select("event_id", value.alias("value"))
    out = L.route_requests(messages, ["one", "two"])
    return out.select("event_id", F.coalesce("service", F.lit("")).alias("service"), "error", F.coalesce("body", F.lit("")).alias("body"))


@query(with_views("data_rows participants requests studies", f"select request_id, table_id, kind, key::bigint as key, '' as message from {_TABLES} union all select request_id, '', 'error', 0, 'Error downloading survey: no such table, \"x\"' from requests where request_id % 4 = 0"))
def extract_bundle_contents(spark, sf_dir):
    """Every row and message of the written bundles."""
    path = _folder(spark, "bundle")
    errors = view(spark, sf_dir, "requests").filter("request_id % 4 = 0").select("request_id", F.lit('Error downloading survey: no such table, "x"').alias("message"))
    K.write_extract_bundle(_tables(spark, sf_dir), errors, path)
    own = F.col("request_id").cast("long").alias("request_id")
    rows = [K.read_extract_bundle(spark, path, kind).select(own, "table_id", F.lit(kind).alias("kind"), F.get_json_object("row", "$.record_id").cast("long").alias("key"), F.lit("").alias("message")) for kind in ("data", "survey")]
    log = K.read_extract_bundle(spark, path, "error.log").select(own, F.lit("").alias("table_id"), F.lit("error").alias("kind"), F.lit(0).cast("long").alias("key"), "message")
    return rows[0].unionByName(rows[1]).unionByName(log)


@query(with_views("upload_rows", f"select record_id from upload_rows where assessment_guid = 'click' and created_ms >= {FIRST_DAY + 3 * DAY} and created_ms < {FIRST_DAY + 9 * DAY} and not is_test"))
def query_upload_rows(spark, sf_dir):
    return R.query_upload_rows(view(spark, sf_dir, "upload_rows"), "click", FIRST_DAY + 3 * DAY, FIRST_DAY + 9 * DAY).select("record_id")


@query(with_views("upload_rows", "select g as assessment_guid, (select count(*) from upload_rows where assessment_guid = g) as n from (select unnest(['click', 'view', 'nothing']) as g)"))
def rows_by_assessment(spark, sf_dir):
    return A.rows_by_assessment(view(spark, sf_dir, "upload_rows"), spark.createDataFrame([("click",), ("view",), ("nothing",)], "assessment_guid string"))


def _maps(spark, sf_dir):
    rows = view(spark, sf_dir, "upload_rows")
    meta = F.expr("case kind when 0 then map('A', 'a', 'B', assessment_guid) when 1 then map('A', 'a') else map('C', health_code) end")
    return rows.withColumns({"metadata": meta, "data": F.expr("case kind when 0 then map('X', 'x') else map('Y', health_code) end")})


@query(with_views("upload_rows", "select assessment_guid, 'A,B,C' as metadata_keys, 'X,Y' as data_keys from upload_rows group by all having count(distinct kind) = 3"))
def column_union(spark, sf_dir):
    return A.column_union(_maps(spark, sf_dir)).select("assessment_guid", F.array_join("metadata_keys", ",").alias("metadata_keys"), F.array_join("data_keys", ",").alias("data_keys"))


_WIDE = """select cast(record_id as varchar) as record_id, coalesce(cast(participant_version as varchar), '') as participant_version, case when kind < 2 then 'a' else '' end as A, case kind when 0 then assessment_guid else '' end as B, case kind when 2 then health_code else '' end as C, case kind when 0 then 'x' else '' end as X, case kind when 0 then '' else health_code end as Y from upload_rows where assessment_guid = 'click'"""


@query(with_views("upload_rows", "select assessment_guid, unnest([0, 0, 0, 1, 1]) as kind, unnest(['A', 'B', 'C', 'X', 'Y']) as key, unnest([1, 2, 3, 4, 5]) as position from upload_rows group by assessment_guid having count(distinct kind) = 3"))
def column_keys(spark, sf_dir):
    return A.column_keys(_maps(spark, sf_dir))


def _wide(spark, sf_dir):
    return L.wide_upload_rows(_maps(spark, sf_dir).filter("assessment_guid = 'click'"), ["B", "A", "C"], ["X", "Y"], ["record_id", "participant_version"])


@query(with_views("upload_rows", _WIDE))
def wide_upload_rows(spark, sf_dir):
    return _wide(spark, sf_dir)


_CSV = """select 'study1-StudyOne-' || assessment_guid || '-First' || assessment_guid as file_name, cast(record_id as varchar) as recordId, study_id as studyIds, assessment_guid as assessmentGuid, cast(created_ms as varchar) as createdOn, cast(is_test as varchar) as isTestData,
    'app ' || kind as clientInfo, health_code as healthCode, coalesce(cast(participant_version as varchar), '') as participantVersion, '' as userAgent, 'phone' as phoneInfo, case when kind = 1 then 'a,b' else '' end as dataGroups,
    case when kind < 2 then 'a' else '' end as A, case kind when 0 then assessment_guid else '' end as B, case kind when 2 then health_code else '' end as C, case kind when 0 then 'x' else '' end as X, case kind when 0 then '' else health_code end as Y from upload_rows where assessment_guid in ('click', 'view')"""


@query(with_views("upload_rows", _CSV))
def write_assessment_csv(spark, sf_dir):
    """Two assessments with all common columns, written and read back."""
    own = {"recordId": "record_id", "studyIds": "study_id", "assessmentGuid": "assessment_guid", "createdOn": "created_ms", "isTestData": "is_test", "clientInfo": "concat('app ', kind)", "healthCode": "health_code", "participantVersion": "participant_version", "userAgent": "cast(null as string)", "phoneInfo": "'phone'", "dataGroups": "case when kind = 1 then 'a,b' end"}
    rows = _maps(spark, sf_dir).select(*(F.expr(own[c]).alias(c) for c in L.COMMON_COLUMNS), "metadata", "data")
    path, guids = _folder(spark, "csv"), ("click", "view")
    names = {r.g: r.name for r in spark.createDataFrame([(g,) for g in guids], "g string").select("g", K.assessment_file_name("study1", "Study One", "g", F.concat(F.lit("First: "), "g")).alias("name")).collect()}
    K.write_assessment_csv(rows, names, path, rows_per_file=20_000)
    sets = [spark.read.options(header=True, escape='"', multiLine=True).csv(f"{path}/file_name={name}").drop("part").withColumn("file_name", F.lit(name)) for name in names.values()]
    back = sets[0].unionByName(sets[1], allowMissingColumns=True)
    return back.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in back.columns))


@query("select c_custkey as healthCode, cast(c_nationkey as varchar) as n, c_mktsegment as segment from customer")
def write_tsv(spark, sf_dir):
    path = _folder(spark, "tsv")
    K.write_tsv(table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("n"), F.col("c_custkey").alias("healthCode"), F.col("c_mktsegment").alias("segment")), path)
    back = spark.read.option("header", True).option("sep", "\t").csv(path)
    return back.select(F.col("healthCode").cast("long").alias("healthCode"), "n", "segment")


@query("select p_partkey, case when p_partkey % 2 = 0 then p_brand else '' end as brand, case when p_partkey % 2 = 1 then p_type else '' end as kind from part")
def append_evolving(spark, sf_dir):
    part, path = table(spark, sf_dir, "part"), _folder(spark, "evolving")
    K.append_evolving(part.filter("p_partkey % 2 = 0").select("p_partkey", F.col("p_brand").alias("brand")), path)
    out = K.append_evolving(part.filter("p_partkey % 2 = 1").select("p_partkey", F.col("p_type").alias("kind")), path)
    return out.select("p_partkey", F.coalesce("brand", F.lit("")).alias("brand"), F.coalesce("kind", F.lit("")).alias("kind"))


@query("select case when o_orderkey % 2 = 0 then 'first' else 'second' end as append, count(*) as n, sum(o_orderkey)::bigint as ids from orders group by all")
def append_checked(spark, sf_dir):
    """Two appends, one of them twice under its name, and one that must fail and leave no row."""
    orders, path = table(spark, sf_dir, "orders").select("o_orderkey"), _folder(spark, "checked")
    for k, name in enumerate(("first", "second", "second")):
        K.append_checked(orders.filter(f"o_orderkey % 2 = {k and 1}").withColumn("append", F.lit(name)), path, name)
    try:
        K.append_checked(orders.withColumn("append", F.lit("wrong")), path, expected=-1)
    except ValueError:
        pass
    return published(spark, path, "o_orderkey long, append string").groupBy("append").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("ids"))


@query("select o_custkey, max(o_orderkey) as o_orderkey from orders group by all")
def upsert_latest(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return K.upsert_latest(orders.filter("o_orderkey % 2 = 0"), orders.filter("o_orderkey % 2 = 1"), ["o_custkey"], "o_orderkey")


@query("select o_custkey, max(o_orderkey) as o_orderkey from orders group by all")
def merge_latest(spark, sf_dir):
    """The latest order of each customer, merged from three appends of all orders and a fourth of those of a tenth of the customers."""
    orders, path = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), _folder(spark, "merged")
    for k in range(3):
        merge_into(orders.filter(f"o_orderkey % 3 = {k}"), path, ["o_custkey"], "o_orderkey", rows_per_file=5_000)
    merge_into(orders.join(orders.agg((F.max("o_custkey") * 0.9).alias("low")), F.col("o_custkey") > F.col("low")).select("o_custkey", "o_orderkey"), path, ["o_custkey"], "o_orderkey", rows_per_file=5_000)
    return merged(spark, path)


@query("select app_id, study_id, date, concat_ws('/', app_id, nullif(study_id, ''), date, cast(event_id as varchar) || '-f ' || event_type) as key from (select *, concat('app', cast(user_id % 4 as varchar)) as app_id, case when user_id % 3 = 0 then '' else concat('study', cast(user_id % 3 as varchar)) end as study_id, strftime(timezone('America/Los_Angeles', timezone('UTC', ts)), '%Y-%m-%d') as date from events)")
def write_dated_layout(spark, sf_dir):
    e, path = table(spark, sf_dir, "events"), _folder(spark, "dated")
    study = F.when(F.col("user_id") % 3 != 0, F.concat(F.lit("study"), (F.col("user_id") % 3).cast("string")))
    K.write_dated_layout(e.select(F.col("event_id").alias("upload_id"), F.concat(F.lit("f "), "event_type").alias("filename"), F.col("ts").cast("timestamp").alias("ts"), F.concat(F.lit("app"), (F.col("user_id") % 4).cast("string")).alias("app_id"), study.alias("study_id")), path, "ts")
    both = spark.read.parquet(f"{path}/studies").unionByName(spark.read.parquet(f"{path}/apps").withColumn("study_id", F.lit("")))
    return both.select("app_id", "study_id", F.col("date").cast("string").alias("date"), "key")


@query("select coalesce(a.l_suppkey % 50, b.s_suppkey % 50) as dest, coalesce(a.n, 0) as expected, coalesce(b.n, 0) as written, coalesce(a.n, 0) = coalesce(b.n, 0) as matches from (select l_suppkey % 50 as l_suppkey, count(*) as n from lineitem where l_suppkey % 50 <> 7 group by 1) a full join (select l_suppkey % 50 as s_suppkey, count(*) as n from lineitem where l_linenumber < 7 or l_suppkey % 2 = 0 group by 1) b on a.l_suppkey = b.s_suppkey")
def row_count_reconciliation(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("dest", F.col("l_suppkey") % 50)
    return A.row_count_reconciliation(rows.filter("dest <> 7"), rows.filter("l_linenumber < 7 or l_suppkey % 2 = 0"), "dest")


@query(with_views("participants", "select user_id, health_code, cast(created_ms as varchar) as created_on, coalesce(case when len(data_groups) > 0 then array_to_string(list_sort(data_groups), ',') end, '') as data_groups, '[\"en-US\",\"langu\"]' as languages, '|' || array_to_string(list_sort([study_ids[1] || '=ext' || cast(user_id as varchar), study_ids[2] || '=']), '|') || '|' as study_memberships from participants"))
def participant_version_rows(spark, sf_dir):
    v = _versions(spark, sf_dir)
    return L.participant_version_rows(v).join(v.select("health_code", "user_id"), "health_code").select("user_id", "health_code", "created_on", F.coalesce("data_groups", F.lit("")).alias("data_groups"), "languages", "study_memberships")


_DEMO = "array(named_struct('study_id', cast(null as string), 'category', 'age', 'units', 'years', 'values', array(named_struct('value', cast(user_id % 90 as string), 'invalidity', cast(null as string)))), named_struct('study_id', study_ids[0], 'category', 'race', 'units', cast(null as string), 'values', array(named_struct('value', 'a', 'invalidity', 'bad'), named_struct('value', 'b', 'invalidity', cast(null as string)))), named_struct('study_id', study_ids[1], 'category', 'none', 'units', cast(null as string), 'values', cast(array() as array<struct<value:string,invalidity:string>>)), named_struct('study_id', study_ids[1], 'category', cast(null as string), 'units', cast(null as string), 'values', cast(null as array<struct<value:string,invalidity:string>>)))"


@query(with_views("participants", "select health_code, s as study_id, c as category, v as value, i as invalidity from (select health_code, unnest(['', study_ids[1], study_ids[1], study_ids[2]]) as s, unnest(['age', 'race', 'race', 'none']) as c, unnest([cast(user_id % 90 as varchar), 'a', 'b', '']) as v, unnest(['', 'bad', '', '']) as i from participants where user_id % 10 <> 4)"))
def demographics_rows(spark, sf_dir):
    v = view(spark, sf_dir, "participants").select(F.expr("case when user_id % 10 <> 4 then health_code end").alias("health_code"), F.lit(1).alias("participant_version"), F.expr(_DEMO).alias("demographics"))
    return L.demographics_rows(v).select("health_code", F.coalesce("study_id", F.lit("")).alias("study_id"), "category", F.coalesce("value", F.lit("")).alias("value"), F.coalesce("invalidity", F.lit("")).alias("invalidity"))


@query(with_views("records", "select record_id, 'priority' as name, 'STRING' as type, priority as value from records union all select record_id, 'participantVersion', 'LONG', cast(version as varchar) from records where version > 0"))
def export_annotations(spark, sf_dir):
    r = view(spark, sf_dir, "records").select("record_id", F.create_map(F.lit("priority"), "priority").alias("metadata"), F.when(F.col("version") > 0, F.col("version")).alias("version"))
    return L.export_annotations(r)


_KEY = "concat_ws('/', f.app_id, f.study_id, strftime(timezone('America/Los_Angeles', timezone('UTC', make_timestamp(created_ms * 1000))), '%Y-%m-%d'), concat(cast(r.record_id as varchar), '-', filename))"


_PLACE = "case when f.study_id is null then 'project-' || f.app_id || '|folder-' || f.app_id else coalesce(project_id, '') || '|' || coalesce(view_id, '') end || '|raw-data|' || {key} || '|' || md5(priority) || '|2024-02-01'"


@query(with_views("records participants studies", f"select record_id, count(study_id) as n_studies, coalesce(max(case when study_id is null then place end), '') as app_record, coalesce(string_agg(case when study_id is not null then study_id || '=' || place end, ',' order by study_id), '') as study_records from (select f.*, {_PLACE.replace('{key}', _KEY)} as place from {_FAN} f join records r on r.record_id = f.record_id left join (select distinct study_id, project_id, view_id from studies) s on s.study_id = f.study_id) group by record_id"))
def export_manifest(spark, sf_dir):
    """One notice a record; the content of a record is its priority's text here."""
    studies = view(spark, sf_dir, "studies").withColumn("folder_id", F.col("view_id"))
    apps = _apps(spark, sf_dir).select("app_id", F.concat(F.lit("project-"), "app_id").alias("project_id"), F.concat(F.lit("folder-"), "app_id").alias("folder_id"))
    out = L.export_manifest(_fanout(spark, sf_dir, ("filename", "created_ms", "content_md5")), studies, apps, "raw-data", "2024-02-01")
    text = lambda r: F.concat_ws("|", *(F.coalesce(r[c], F.lit("")) for c in ("project_id", "folder_id", "bucket", "key", "md5", "exported_on")))
    studies_ = F.transform(F.array_sort(F.map_entries("study_records")), lambda e: F.concat(e["key"], F.lit("="), text(e["value"])))
    return out.select("record_id", F.size("study_records").cast("long").alias("n_studies"), F.when(F.col("app_record").isNull(), "").otherwise(text(F.col("app_record"))).alias("app_record"), F.array_join(studies_, ",").alias("study_records"))


@query(with_views("records participants studies", f"select f.record_id, f.study_id, r.priority as device, case when p.study_ids[1] = f.study_id and p.user_id % 2 = 0 then 'ext' || cast(p.user_id as varchar) when p.study_ids[1] = f.study_id then 'plain' else '' end as external_id from {_FAN} f join records r on r.record_id = f.record_id join participants p on p.user_id = r.user_id where study_id in (select study_id from studies where export_enabled is true and configured is true and upload_table) and r.app_id not in ('app1', 'app2', 'app3')"))
def study_table_rows(spark, sf_dir):
    fan = _fanout(spark, sf_dir)
    ids = F.expr("map(study_ids[0], if(user_id % 2 = 0, concat('ext', cast(user_id as string), ':', study_ids[0]), 'plain'))")
    rows = view(spark, sf_dir, "records").select("record_id", "user_id", F.create_map(F.lit("device"), "priority").alias("metadata"))
    out = L.study_table_rows(rows, fan, view(spark, sf_dir, "studies"), view(spark, sf_dir, "participants").select("user_id", ids.alias("external_ids")), _apps(spark, sf_dir))
    return out.select("record_id", "study_id", F.col("metadata")["device"].alias("device"), F.coalesce(F.try_element_at("metadata", F.lit("externalId")), F.lit("")).alias("external_id"))


@query(with_views("records participants", "select record_id, r.created_ms + 1000 as created_ms, coalesce(g, 'container') as assessment_guid, coalesce(case when len(data_groups) > 0 then array_to_string(list_sort(data_groups), ',') end, '') as data_groups, list_contains(data_groups, 'test_user') as is_test, priority as device, '' as start from (select *, case when record_id % 3 = 0 then 'guid' end as g from records) r join participants p on p.user_id = r.user_id where g is not null or r.app_id = 'app1'"))
def upload_table_row(spark, sf_dir):
    r = view(spark, sf_dir, "records").withColumns({"assessment_guid": F.expr("case when record_id % 3 = 0 then 'guid' end"), "app_id": F.when(F.col("app_id") == "app1", "arc").otherwise(F.col("app_id")), "metadata": F.create_map(F.lit("deviceInfo"), "priority")})
    uploads = view(spark, sf_dir, "records").select("record_id", (F.col("created_ms") + 1000).alias("created_ms"))
    out = L.upload_table_row(r, uploads, view(spark, sf_dir, "participants"), ["deviceInfo", "startDate"])
    return out.select("record_id", "created_ms", "assessment_guid", "data_groups", "is_test", F.col("metadata")["deviceInfo"].alias("device"), F.col("metadata")["startDate"].alias("start"))


@query("select event_id, case event_id % 3 when 0 then 'phone' else '' end as device, event_id % 3 < 2 as has_keys from events")
def metadata_json_fields(spark, sf_dir):
    a = table(spark, sf_dir, "events").select(F.col("event_id").alias("record_id"), F.expr("case event_id % 3 when 0 then '{\"deviceInfo\":\"phone\",\"startDate\":5}' when 1 then '{\"deviceInfo\":\" \"}' end").alias("metadata_json"))
    out = L.metadata_json_fields(a)
    return out.select(F.col("record_id").alias("event_id"), F.coalesce(F.try_element_at("fields", F.lit("deviceInfo")), F.lit("")).alias("device"), (F.size("fields") > 0).alias("has_keys"))


_RESULT = """concat('{"type":"assessment","stepHistory":[{"type":"answer","identifier":"q1","value":', cast(event_id % 7 as {s}), '},{"type":"answer","identifier":"q2","value":"', event_type, '"},{"type":"instruction","identifier":"i"},{"type":"answer","identifier":"extra', cast(event_id % 2 as {s}), '","value":"more"}]}')"""


def _answers(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("record_id"), F.col("event_type").alias("assessment_guid"), F.expr(_RESULT.replace("{s}", "string")).alias("result")).withColumn("answers", L.flatten_answers("result"))


@query("select event_id as record_id, cast(event_id % 7 as varchar) as q1, event_type as q2, 3 as n from events")
def flatten_answers(spark, sf_dir):
    return _answers(spark, sf_dir).select("record_id", F.col("answers")["q1"].alias("q1"), F.col("answers")["q2"].alias("q2"), F.size("answers").alias("n"))


@query("select event_id as record_id, case when event_id % 2 = 0 then event_type else '' end as q2 from events")
def register_summarizer(spark, sf_dir):
    framework = F.when(F.col("record_id") % 2 == 0, F.lit("survey")).otherwise(F.lit("unknown"))
    return _answers(spark, sf_dir).select("record_id", F.coalesce(summarize(framework, F.col("result"))["q2"], F.lit("")).alias("q2"))


@query("select p_partkey, case p_partkey % 3 when 0 then 'q1,q2' else '' end as columns from part")
def answer_columns(spark, sf_dir):
    config = F.expr("case p_partkey % 3 when 0 then '{\"steps\":[{\"identifier\":\"q1\"},{\"type\":\"x\"},{\"identifier\":\"q2\"}]}' when 1 then 'text' end")
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(L.answer_columns(config), ",").alias("columns"))


@query("select event_id as record_id, concat('extra', cast(event_id % 2 as varchar)) as name from events")
def unexpected_columns(spark, sf_dir):
    answers = _answers(spark, sf_dir)
    definition = answers.select("assessment_guid").distinct().withColumn("name", F.explode(F.array(F.lit("q1"), F.lit("q2"))))
    return P.unexpected_columns(answers, definition).select("record_id", "name")


def _payloads(spark, sf_dir):
    item = F.to_json(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("line"), F.col("l_returnflag").alias("flag"), F.col("l_partkey").alias("part")))))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(item.alias("items"))
    orders = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    text = F.concat(F.lit('{"summary":{"status":"'), "o_orderstatus", F.lit('","customer":'), F.col("o_custkey").cast("string"), F.lit(',"odd":true},"items":'), "items", F.lit(',"empty":{},"extra":1,"skip":2,"flat":3}'))
    return orders.select(F.concat(F.lit("hc"), F.col("o_orderkey").cast("string")).alias("health_code"), F.lit("2024-01-05").alias("created_date"), F.lit("orders").alias("endpoint_id"), text.alias("payload"))


SCHEMA = [("orders", "summary", "status", "STRING", 1), ("orders", "summary", "customer", "INTEGER", None), ("orders", "items", "line", "INTEGER", None), ("orders", "items", "flag", "STRING", 10), ("orders", "items", "part", "STRING", 2), ("orders", "items", "missing", "DATE", None), ("orders", "flat", "x", "INTEGER", None), ("orders", "empty", "x", "INTEGER", None)]


def _schema(spark):
    return spark.createDataFrame(SCHEMA, "endpoint_id string, table_key string, column_id string, kind string, max_length int")


_LINES = """select l_orderkey, unnest(['line', 'flag', 'part', 'rawData']) as column_id, row_number() over (partition by l_orderkey order by l_linenumber, l_returnflag, l_partkey) - 1 as row_no, unnest([cast(l_linenumber as varchar), l_returnflag, left(cast(l_partkey as varchar), 2), sha256('{"line":' || l_linenumber || ',"flag":"' || l_returnflag || '","part":' || l_partkey || '}')]) as value from lineitem"""


@query(f"""select concat('hc', cast(o_orderkey as varchar)) as health_code, 'orders.summary' as table_id, 0 as row_no, unnest(['status', 'customer', 'rawData']) as column_id, unnest([left(o_orderstatus, 1), cast(o_custkey as varchar), sha256('{{"status":"' || o_orderstatus || '","customer":' || o_custkey || ',"odd":true}}')]) as value from orders where o_orderkey in (select l_orderkey from lineitem)
    union all select concat('hc', cast(l_orderkey as varchar)), 'orders.items', cast(row_no as int), column_id, value from ({_LINES}) where l_orderkey in (select o_orderkey from orders)""")
def tabulate_json(spark, sf_dir):
    return L.tabulate_json(_payloads(spark, sf_dir), _schema(spark)).select("health_code", "table_id", "row_no", "column_id", "value")


@query("select 'orders' as endpoint_id, unnest(['extra', 'flat', 'summary']) as table_key, unnest(['', '', 'odd']) as column_id, unnest(['unexpected table', 'neither array nor object', 'unexpected column']) as problem, (select count(*) from orders where o_orderkey in (select l_orderkey from lineitem)) as n")
def schema_key_audit(spark, sf_dir):
    out = P.schema_key_audit(_payloads(spark, sf_dir), _schema(spark), spark.createDataFrame([("orders", "skip")], "endpoint_id string, table_key string"))
    return out.withColumn("column_id", F.coalesce("column_id", F.lit("")))


@query("select distinct sha256('{\"brand\":\"' || p_brand || '\"}') as file_id, '{\"brand\":\"' || p_brand || '\"}' as content from part")
def extract_attachments(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.to_json(F.struct(F.col("p_brand").alias("brand"))).alias("raw"))
    return L.extract_attachments(rows, ["raw"])[1]


@query("select concat('hc', cast(o_custkey as varchar)) as health_code, 'orders' as endpoint_id, length(o_orderpriority) + 8 as n from orders")
def read_payloads(spark, sf_dir):
    path = _folder(spark, "payloads")
    rows = table(spark, sf_dir, "orders").select(F.concat(F.lit("hc"), F.col("o_custkey").cast("string")).alias("health_code"), F.lit("orders").alias("endpoint_id"), F.lit("2024-01-05").alias("created_date"), F.to_json(F.struct(F.col("o_orderpriority").alias("p"))).alias("payload"))
    rows.write.json(path)
    return R.read_payloads(spark, path).select("health_code", "endpoint_id", F.length("payload").alias("n"))


@query("select cast(o_orderkey as varchar) as id from orders")
def read_id_list(spark, sf_dir):
    path = _folder(spark, "ids")
    table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("value")).write.text(path)
    return R.read_id_list(spark, path)


@query("select cast(n_regionkey as varchar) as endpoint_id, 'scope' as scope, n_name as table_key, n_name as column_id, case when n_nationkey % 2 = 0 then 'STRING' else 'INTEGER' end as kind, case when n_nationkey % 4 = 0 then 10 else 0 end as max_length, case when n_nationkey % 4 = 2 then 'text needs a length of 1 to 1000' else '' end as problem from nation union all select '', '', '', '', '', 0, 'not a document of endpoints' from region")
def load_endpoint_schemas(spark, sf_dir):
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return R.load_endpoint_schemas(spark, _schema_files(spark, sf_dir)).select(*map(text, ("endpoint_id", "scope", "table_key", "column_id", "kind", "problem")), F.coalesce("max_length", F.lit(0)).alias("max_length"))


@query("select cast(r_regionkey as varchar) as endpoint_id, unnest(['links', 'region' || r_regionkey]) as table_key from region where r_regionkey in (select n_regionkey from nation)")
def load_ignored_keys(spark, sf_dir):
    return R.load_ignored_keys(spark, _schema_files(spark, sf_dir))


def _schema_files(spark, sf_dir) -> str:
    """Endpoint schemas derived from the nations, a table per nation; and a broken document per region."""
    path = _folder(spark, "schemas")
    tables = F.collect_list(F.expr("struct(n_name as tableKey, array(struct(n_name as columnId, if(n_nationkey % 2 = 0, 'STRING', 'INTEGER') as columnType, if(n_nationkey % 4 = 0, 10, cast(null as int)) as maxLength)) as columns)"))
    by_region = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(tables.alias("t"))
    endpoints = F.collect_list(F.expr("struct(cast(n_regionkey as string) as endpointId, 'scope' as scopeName, 'http://x' as url, array('links', concat('region', n_regionkey)) as ignoredKeys, t as tables)"))
    doc = by_region.groupBy("n_regionkey").agg(F.to_json(F.struct(endpoints.alias("endpoints"))).alias("value"))
    bad = table(spark, sf_dir, "region").select("r_regionkey", F.concat(F.lit("no document "), "r_name").alias("value"))
    every = doc.select((F.col("n_regionkey") * 2).alias("file"), "value").unionByName(bad.select((F.col("r_regionkey") * 2 + 1).alias("file"), "value"))
    every.repartition("file").write.partitionBy("file").text(path)
    return path


@query("select s_suppkey, finish_ms, 'done' as tag from (select s_suppkey, 1704067200000 + s_suppkey as finish_ms from supplier where s_suppkey = (select max(s_suppkey) from supplier))")
def append_job_log(spark, sf_dir):
    path, last = _folder(spark, "log"), table(spark, sf_dir, "supplier").agg(F.max("s_suppkey")).first()[0]
    K.append_job_log(spark, str(last), FIRST_DAY + last, "done", path)
    return spark.read.parquet(path).select(F.col("worker_id").cast("long").alias("s_suppkey"), "finish_ms", "tag")


def _notices(text: str) -> str:
    return f"""concat('{{"Records":[{{"eventSource":"', case when event_id % 5 = 0 then 'aws:sns' else 'aws:s3' end, '","eventName":"', case when event_id % 3 = 0 then 'ObjectRemoved:Delete' else 'ObjectCreated:Put' end, '","eventTime":"t","s3":{{"bucket":{{"name":"', case when event_id % 7 = 0 then 'other' else 'uploads' end, '"}},"object":{{"key":"', cast(event_id as {text}), '","size":1}}}}}}]}}')"""


def _messages(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.expr(f"case when event_id % 11 = 0 then 'not json' else {_notices('string')} end").alias("value"))


_COMPLETED = "select cast(event_id as varchar) as upload_id from events where event_id % 11 <> 0 and event_id % 5 <> 0 and event_id % 3 <> 0 and event_id % 7 <> 0"


@query(_COMPLETED)
def upload_completions(spark, sf_dir):
    return X.upload_completions(_messages(spark, sf_dir), "uploads").select("upload_id")


@query(_COMPLETED)
def read_object_events(spark, sf_dir):
    folder, out = _folder(spark, "notices"), _folder(spark, "completed")
    _messages(spark, sf_dir).write.text(folder)
    stream = X.upload_completions(R.read_object_events(spark, folder), "uploads")
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", _folder(spark, "state")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("upload_id string, event_time string").parquet(out).select("upload_id")


@query("select event_id, case when s between 200 and 299 then 'ok' when s = 400 or s between 404 and 499 then 'dropped' else 'retry' end as outcome from (select event_id, [200, 400, 401, 403, 404, 412, 500, 503][1 + event_id % 8] as s from events)")
def classify_failures(spark, sf_dir):
    codes = F.array(*map(F.lit, (200, 400, 401, 403, 404, 412, 500, 503)))
    return X.classify_failures(table(spark, sf_dir, "events").select("event_id", F.get(codes, (F.col("event_id") % 8).cast("int")).alias("http_status"))).select("event_id", "outcome")


@query("select event_id from events")
def dedupe_redelivery(spark, sf_dir):
    folder, out = _folder(spark, "twice"), _folder(spark, "once")
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    e.unionByName(e.filter("event_id % 2 = 0")).write.parquet(folder)
    stream = X.dedupe_redelivery(spark.readStream.schema("event_id long, ts timestamp").parquet(folder), ["event_id"], "ts", "40 days")
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", _folder(spark, "state")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("event_id long, ts timestamp").parquet(out).select("event_id")


@query("select event_id from events")
def dedupe_redelivery_ever(spark, sf_dir):
    """Three deliveries, each long after the watermark of the one before: all events but every third, every second again, and all again."""
    folder, out, state = _folder(spark, "again"), _folder(spark, "ever"), _folder(spark, "state")
    e = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("kind"))
    for day, which in enumerate(("event_id % 3 <> 0", "event_id % 2 = 0", "true")):
        e.filter(which).withColumn("arrived", F.timestamp_millis(F.lit(FIRST_DAY + 10 * day * DAY))).write.mode("append").parquet(folder)
        stream = spark.readStream.schema("event_id long, kind string, arrived timestamp").parquet(folder)
        X.dedupe_redelivery_ever(stream, ["event_id"], "arrived", "1 day", out, state).awaitTermination()
    return X.delivered_once(spark, out, "event_id long, kind string, arrived timestamp").select("event_id")


_RESULTS = "select concat('r', cast(user_id % 40 as {s})) as request_id, cast({list}[{first} + cast(event_id % 8 as int)] as int) as http_status, cast(event_id as bigint) as time_ms from events"
_COUNTED = f"""select request_id, http_status, time_ms, outcome, attempt, coalesce(next_try_ms, 0) as next_try_ms from (select *, case when outcome = 'retry' then time_ms + (60000 * pow(2, attempt - 1))::bigint end as next_try_ms from (
    select request_id, http_status, time_ms, ((nth - 1) % 3 + 1)::int as attempt, case when o = 'retry' and (nth - 1) % 3 = 2 then 'dead' else o end as outcome from (select *, row_number() over (partition by request_id, round order by time_ms) as nth from (
    select *, coalesce(sum(case when o = 'retry' then 0 else 1 end) over (partition by request_id order by time_ms rows between unbounded preceding and 1 preceding), 0) as round from (
    select *, case when http_status between 200 and 299 then 'ok' when http_status = 400 or http_status between 404 and 499 then 'dropped' else 'retry' end as o from ({_RESULTS.format(s='varchar', list='[200, 500, 503, 401, 403, 502, 404, 500]', first=1)}))))))"""


def _results(spark, sf_dir):
    return spark.sql(_RESULTS.format(s="string", list="array(200, 500, 503, 401, 403, 502, 404, 500)", first=0).replace("from events", f"from parquet.`{sf_dir}/events.parquet`"))


@query(_COUNTED)
def count_attempts(spark, sf_dir):
    return X.count_attempts(_results(prepare(spark), sf_dir), 3, 60_000).withColumn("next_try_ms", F.coalesce("next_try_ms", F.lit(0).cast("long")))


@query(_COUNTED)
def route_failures(spark, sf_dir):
    """Results in two parts of time, so that requests go on where they were."""
    folder, out, state = _folder(spark, "results"), _folder(spark, "outcomes"), _folder(spark, "state")
    results = _results(prepare(spark), sf_dir)
    half = results.agg(F.max("time_ms")).first()[0] // 2
    for part in (F.col("time_ms") <= half, F.col("time_ms") > half):
        results.filter(part).write.mode("append").parquet(folder)
        X.route_failures(spark.readStream.schema(results.schema).parquet(folder), out, state, limit=3).awaitTermination()
    return X.routed_failures(spark, out).withColumn("next_try_ms", F.coalesce("next_try_ms", F.lit(0).cast("long")))


_LOGGED = f"(select user_id, type from (select *, row_number() over (partition by user_id order by time_ms desc, seq desc) as k from notification_log where time_ms < {FIRST_DAY + 24 * DAY}) where k = 1 and time_ms > {FIRST_DAY + 21 * DAY})"


@query(with_views("participants notification_log", f"select user_id from participants where user_id not in (select user_id from {_LOGGED} where coalesce(type, '') <> 'PRE_BURST')"))
def reminder_cooldown_stream(spark, sf_dir):
    """The log in two parts, then every participant as a candidate."""
    folder, out, state, now = _folder(spark, "log"), _folder(spark, "sent"), _folder(spark, "state"), FIRST_DAY + 24 * DAY
    log = view(spark, sf_dir, "notification_log").select("user_id", "time_ms", "seq", F.lit(None).cast("string").alias("decision"), F.coalesce("type", F.lit("")).alias("type"))
    people = view(spark, sf_dir, "participants").select("user_id", F.lit(now).cast("long").alias("time_ms"), F.lit(0).cast("long").alias("seq"), F.lit("EARLY").alias("decision"), F.lit(None).cast("string").alias("type"))
    middle = FIRST_DAY + 22 * DAY
    for part in (log.filter(F.col("time_ms") <= middle), log.filter((F.col("time_ms") > middle) & (F.col("time_ms") < now)), people):
        part.write.mode("append").parquet(folder)
        passed = X.reminder_cooldown_stream(spark.readStream.schema(log.schema).parquet(folder), 3)
        passed.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("user_id long").parquet(out)


@query("select case event_id % 4 when 0 then 'one' when 1 then 'two' else 'errors' end as target, count(*) as n from events group by all")
def route_requests_stream(spark, sf_dir):
    folder, out = _folder(spark, "requests"), _folder(spark, "routed")
    value = F.expr("case event_id % 4 when 3 then 'not json' else concat('{\"service\":\"', case event_id % 4 when 0 then 'one' when 1 then 'two' else 'other' end, '\",\"body\":\"b\"}') end")
    table(spark, sf_dir, "events").select(value.alias("value")).write.text(folder)
    X.route_requests_stream(R.read_object_events(spark, folder), ["one", "two"], out, _folder(spark, "state")).awaitTermination()
    return X.routed_requests(spark, out).groupBy("target").agg(F.count(F.lit(1)).alias("n"))


@query("select p_partkey % 20 as archive, count(*) as entries from part group by all")
def expand_archives(spark, sf_dir):
    """Zips of fifty parts' names each, written by tasks and read back; archives with an error count under null."""
    folder = _folder(spark, "zips")
    _write_zips(table(spark, sf_dir, "part").select("p_partkey", "p_name"), folder)
    out = R.expand_archives(spark, folder)
    archive = F.regexp_extract("entry", r"^(-?\d+)\.json$", 1).cast("long") % 20
    return out.groupBy(archive.alias("archive")).agg(F.count(F.lit(1)).alias("entries"))


def _write_zips(parts, folder):
    """One file for each fifty keys, by Spark's writer, so that any shared folder will do; tasks rename their own files, and no fewer write than there are shuffle partitions, as files take longer than their bytes."""
    tasks = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    made = parts.withColumn("zip", F.expr("p_partkey div 50")).repartition(tasks, "zip").groupBy("zip").applyInPandas(_zipped, "content binary")
    made.select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(folder)


def _zipped(frame):
    import io

    import pandas as pd

    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for key, name in zip(frame["p_partkey"], frame["p_name"], strict=True):
            z.writestr(f"{key}.json", json.dumps({"name": name}))
        z.comment = b"\n"  # the last byte, which the writer adds to each row
    return pd.DataFrame({"content": [data.getvalue()[:-1]]})


@query("select user_id, 'EARLY' as type, concat('m', cast(user_id as varchar)) as message from (select c_custkey as user_id from customer where c_custkey % 3 = 0)")
def append_notification_log(spark, sf_dir):
    path = _folder(spark, "notified")
    decided = table(spark, sf_dir, "customer").filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("user_id"), F.lit("EARLY").alias("decision"), F.concat(F.lit("m"), F.col("c_custkey").cast("string")).alias("message"))
    K.append_notification_log(decided, path, FIRST_DAY)
    return spark.read.parquet(path).select("user_id", "type", "message")


