"""Queries of the scalar functions over canonical views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..bindings import view, with_views
from ..functions import scalars as S
from ..session import table
from .registry import query

_PROPS = "concat('{\"k.1\":\"', cast(event_id % 5 as {s}), '\",\"list\":', case when event_id % 4 = 0 then '[\"a\",\"b\"]' when event_id % 4 = 1 then '[\"a\",1]' when event_id % 4 = 2 then '[]' else '\"a\"' end, ',\"text\":', case when event_id % 3 = 0 then '\"word\"' when event_id % 3 = 1 then '\"  \"' else '7' end, ',\"in\":{\"deep\":\"', case when event_id % 2 = 0 then 'x' else '' end, '\"}}') as j"


def _json(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr("event_id", _PROPS.replace("{s}", "string"))


_JSON = "(select event_id, " + _PROPS.replace("{s}", "varchar") + " from events)"


@query("select p_partkey, concat('b=', cast(p_partkey % 3 as varchar)) as a_b, regexp_replace(concat(p_brand, '#', p_name), '[^a-zA-Z0-9\\-_]', '', 'g') as cleaned from part")
def sanitize_metadata_name(spark, sf_dir):
    m = F.create_map(F.lit("a b"), F.lit("lost"), F.lit("a#b"), F.concat(F.lit("b="), (F.col("p_partkey") % 3).cast("string")))
    return table(spark, sf_dir, "part").select("p_partkey", S.sanitize_metadata_name(m)["a_b"].alias("a_b"), S.clean_name(F.concat("p_brand", F.lit("#"), "p_name")).alias("cleaned"))


@query("select p_partkey, regexp_replace(p_name, '[^a-zA-Z0-9\\-_]', '', 'g') as cleaned from part")
def clean_name(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", S.clean_name("p_name").alias("cleaned"))


@query("select page_id, trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'), ' ') as plain from pages")
def strip_html(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", S.strip_html("html").alias("plain"))


@query("select o_orderkey, case when o_orderkey % 2 = 0 then 'timeline' else 'system' end as name, 'app' as own, case when o_orderkey % 3 = 0 then null else 'json' end as content_type from orders")
def merge_metadata(spark, sf_dir):
    kv = lambda *x: F.create_map(*(F.lit(v) for v in x))
    m = S.merge_metadata(kv("own", "app", "name", "app"), kv("name", "system"), F.when(F.col("o_orderkey") % 2 == 0, kv("name", "timeline")), F.when(F.col("o_orderkey") % 3 != 0, F.lit("json")))
    return table(spark, sf_dir, "orders").select("o_orderkey", m["name"].alias("name"), m["own"].alias("own"), F.try_element_at(m, F.lit("contentType")).alias("content_type"))


@query(with_views("records", "select record_id, concat(cast(record_id as varchar), '-', filename) as upload_name from records"))
def upload_filename(spark, sf_dir):
    return view(spark, sf_dir, "records").select("record_id", S.upload_filename("record_id", "filename").alias("upload_name"))


_LA = "strftime(timezone('America/Los_Angeles', timezone('UTC', ts)), '%Y-%m-%d')"


@query(f"select event_id, concat_ws('/', concat('app', cast(user_id % 4 as varchar)), case when user_id % 3 = 0 then 'study1' end, {_LA}, event_type) as key from events")
def raw_object_key(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", S.raw_object_key(F.concat(F.lit("app"), (F.col("user_id") % 4).cast("string")), F.when(F.col("user_id") % 3 == 0, F.lit("study1")), F.col("ts").cast("timestamp"), "event_type").alias("key"))


@query(f"select event_id, {_LA} as folder_date from events")
def local_folder_date(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", S.local_folder_date(F.col("ts").cast("timestamp")).cast("string").alias("folder_date"))


@query("select p_partkey, md5(p_name) as hex_md5 from part")
def base64_md5_to_hex(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", S.base64_md5_to_hex(F.base64(F.unhex(F.md5("p_name")))).alias("hex_md5"))


@query("select doc_id, md5(text) as digest from documents")
def content_md5(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", S.content_md5("text").alias("digest"))


@query(with_views("participants", "select user_id, case when len(data_groups) > 0 then array_to_string(list_sort(data_groups), ',') end as groups from participants"))
def join_sorted_groups(spark, sf_dir):
    return view(spark, sf_dir, "participants").select("user_id", S.join_sorted_groups("data_groups").alias("groups"))


@query("select o_orderkey, case when o_orderkey % 5 = 0 then null else '[\"' || array_to_string(list_transform(range(1, least(o_orderkey % 13, 10) + 1), lambda i: left('lang' || cast(i * 7 as varchar), 5)), '\",\"') || '\"]' end as languages from orders where o_orderkey % 13 > 0")
def serialize_languages(spark, sf_dir):
    o = table(spark, sf_dir, "orders").filter("o_orderkey % 13 > 0")
    list_ = F.expr("case when o_orderkey % 5 <> 0 then transform(sequence(1, o_orderkey % 13), i -> concat('lang', cast(i * 7 as string))) end")
    return o.select("o_orderkey", S.serialize_languages(list_).alias("languages"))


@query("select c_custkey, case when c_custkey % 6 = 0 then null when c_custkey % 6 = 1 then '|study-b=ext|study=|' else concat('|study-b=|study=e', cast(c_custkey as varchar), '|') end as memberships, case when c_custkey % 6 = 0 then null when c_custkey % 6 = 1 then '|study=|' else concat('|study=e', cast(c_custkey as varchar), '|') end as one, case when c_custkey % 6 = 0 then null else '|other=null|' end as missing from customer")
def serialize_memberships(spark, sf_dir):
    m = F.expr("case when c_custkey % 6 = 0 then null when c_custkey % 6 = 1 then map('study', '<none>', 'study-b', 'ext') else map('study', concat('e', cast(c_custkey as string)), 'study-b', '<none>') end")
    return table(spark, sf_dir, "customer").select("c_custkey", S.serialize_memberships(m).alias("memberships"), S.serialize_memberships(m, "study").alias("one"), S.serialize_memberships(m, "other").alias("missing"))


@query("select c_custkey, case when c_custkey % 2 = 0 then concat('x', cast(c_custkey as varchar)) else concat('x', cast(c_custkey as varchar), ':other') end as external_id from customer")
def strip_study_suffix(spark, sf_dir):
    ext = F.concat(F.lit("x"), F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 2 == 0, F.lit(":study1")).otherwise(F.lit(":other")))
    return table(spark, sf_dir, "customer").select("c_custkey", S.strip_study_suffix(ext, F.lit("study1")).alias("external_id"))


@query("select o_orderkey, case o_orderkey % 3 when 0 then '-daily-upload-report' when 1 then '-weekly-upload-report' else '-daily-retention-report' end as suffix from orders")
def report_suffix(spark, sf_dir):
    kind = F.expr("case o_orderkey % 3 when 0 then 'DAILY' when 1 then 'WEEKLY' else 'DAILY_RETENTION' end")
    return table(spark, sf_dir, "orders").select("o_orderkey", S.report_suffix(kind).alias("suffix"))


@query(f"select event_id, case when json_type(j, '$.text') = 'VARCHAR' and trim(json_extract_string(j, '$.text')) <> '' then json_extract_string(j, '$.text') end as value from {_JSON}")
def json_text(spark, sf_dir):
    return _json(spark, sf_dir).select("event_id", S.json_text("j", "text").alias("value"))


@query(f"select event_id, case event_id % 4 when 0 then 'a,b' when 2 then '' end as value from {_JSON}")
def json_string_list(spark, sf_dir):
    return _json(spark, sf_dir).select("event_id", F.array_join(S.json_string_list("j", "list"), ",").alias("value"))


@query(f"select event_id, nullif(json_extract_string(j, '$.in.deep'), '') as deep, cast(null as varchar) as missing from {_JSON}")
def json_path_value(spark, sf_dir):
    return _json(spark, sf_dir).select("event_id", S.json_path_value("j", "in", "deep").alias("deep"), S.json_path_value("j", "text", "deep").alias("missing"))


@query("select event_id, case when event_id % 2 = 0 then case when event_id % 3 = 0 then null else concat('go ', 'http://u', ' for ', event_type) end else 'see http://u' end as message from events")
def resolve_template(spark, sf_dir):
    m = F.when(F.col("event_id") % 2 == 0, F.lit("go ${url} for ${studyCommitment}")).otherwise(F.lit("see ${url}"))
    return table(spark, sf_dir, "events").select("event_id", S.resolve_template(m, F.when(F.col("event_id") % 3 != 0, F.col("event_type")), F.lit("http://u")).alias("message"))


@query("select c_custkey, ['m0', 'm1', 'm2'][1 + cast(concat('0x', substr(md5(concat(cast(c_custkey as varchar), '2024-01-05')), 1, 8)) as ubigint)::bigint % 3] as message from customer")
def pick_message(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", S.pick_message(F.array(*map(F.lit, ("m0", "m1", "m2"))), "c_custkey", F.lit("2024-01-05")).alias("message"))


@query(with_views("participants", "select user_id, time_zone in ('-07:00', '-05:00', '-11:00', '-01:00') as inside from participants"))
def offset_in_window(spark, sf_dir):
    return view(spark, sf_dir, "participants").select("user_id", S.offset_in_window("time_zone").alias("inside"))


@query("select event_id, datesub('day', timestamp '2024-01-15 12:00:00', ts) as days from events")
def days_between_utc(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", S.days_between_utc(F.lit("2024-01-15 12:00:00").cast("timestamp"), F.col("ts").cast("timestamp")).alias("days"))


@query("select event_id, cast(epoch_us(ts) // 1000 as varchar) as millis from events")
def epoch_millis(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", S.epoch_millis(F.col("ts").cast("timestamp")).alias("millis"))


@query("select o_orderkey, case o_orderkey % 4 when 0 then '2024-02-29' when 3 then '1995-12-01' end as day from orders")
def parse_iso_date(spark, sf_dir):
    s = F.expr("case o_orderkey % 4 when 0 then '2024-02-29' when 1 then '2023-02-29' when 2 then '2024-2-9' else '1995-12-01' end")
    return table(spark, sf_dir, "orders").select("o_orderkey", S.parse_iso_date(s).cast("string").alias("day"))


@query("select o_orderkey, case when o_orderkey % 2 = 0 then o_orderpriority else '' end as a, '' as b from orders")
def blank_fill(spark, sf_dir):
    m = S.blank_fill(F.when(F.col("o_orderkey") % 2 == 0, F.create_map(F.lit("a"), F.col("o_orderpriority"))).otherwise(F.expr("map()").cast("map<string,string>")), ["a", "b"])
    return table(spark, sf_dir, "orders").select("o_orderkey", m["a"].alias("a"), m["b"].alias("b"))


@query("""select o_orderkey, case k when 0 then 'true' end as b, case k when 6 then '1513105011098' end as d, case k when 2 then '3.14159' when 3 then '42' end as f,
    case k when 2 then '3' when 3 then '42' end as i, case k when 0 then 'true' when 1 then 'true' when 2 then '3.14' when 3 then '42' when 4 then '{"a"' when 6 then '2017' end as s,
    case when k <> 5 then j end as t from (select o_orderkey, o_orderkey % 7 as k, case o_orderkey % 7 when 0 then 'true' when 1 then '"true"' when 2 then '3.14159' when 3 then '42' when 4 then '{"a":1}' when 5 then 'null' else '"2017-12-12T18:56:51.098Z"' end as j from orders)""")
def typed_json_value(spark, sf_dir):
    j = F.expr("""case o_orderkey % 7 when 0 then 'true' when 1 then '"true"' when 2 then '3.14159' when 3 then '42' when 4 then '{"a":1}' when 5 then 'null' else '"2017-12-12T18:56:51.098Z"' end""")
    kinds = {"b": "BOOLEAN", "d": "DATE", "f": "DOUBLE", "i": "INTEGER", "t": "LARGETEXT"}
    return table(spark, sf_dir, "orders").select("o_orderkey", *(S.typed_json_value(j, kind).alias(name) for name, kind in kinds.items()), S.typed_json_value(j, "STRING", 4).alias("s"))
