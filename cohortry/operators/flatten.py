"""Projections: nested records to flat, long or wide rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from .filters import export_configured

# Fixed values.
ATTACHMENT_TYPES = ("attachment_blob", "attachment_csv", "attachment_json_blob", "attachment_json_table", "attachment_v2")
METADATA_FIELDS = ("deviceInfo", "startDate", "endDate")
COMMON_COLUMNS = ("recordId", "studyIds", "assessmentGuid", "createdOn", "isTestData", "clientInfo", "healthCode", "participantVersion", "userAgent", "phoneInfo", "dataGroups")
ROSTER_EXCLUDED = ("orgMembership", "type")
LINKED_ACCOUNT = r".+UserId"  # fields with a participant's id in another system
NO_ASSESSMENT_APPS = ("arc", "inv-arc")
CONTAINER_ASSESSMENT = "container"


def table_objects(payloads: DataFrame, schema: DataFrame) -> DataFrame:
    """(health_code, created_date, endpoint_id, table_key, row_no, object): the objects of the tables that the schema has.

    A top-level array has a row per object, an object one; empty objects are left out. The schema, a configuration, is sent to all tasks, so texts aren't shuffled.
    """
    keys = payloads.select("health_code", "created_date", "endpoint_id", F.explode(F.from_json("payload", "map<string,string>")).alias("table_key", "raw"))
    tables = keys.join(F.broadcast(schema.select("endpoint_id", "table_key").distinct()), ["endpoint_id", "table_key"], "left_semi")
    row = F.when(F.startswith("raw", F.lit("[")), F.from_json("raw", "array<string>")).when(F.startswith("raw", F.lit("{")), F.array("raw"))
    rows = tables.select("health_code", "created_date", "endpoint_id", "table_key", F.posexplode(row).alias("row_no", "object"))
    return rows.filter(F.startswith("object", F.lit("{")) & ~F.rlike("object", F.lit(r"^\{\s*\}$")))


def tabulate_json(payloads: DataFrame, schema: DataFrame) -> DataFrame:
    """(health_code, created_date, table_id, row_no, column_id, kind, value): typed cells of all tables.

    ``schema`` has (endpoint_id, table_key, column_id, kind, max_length). Each row also has a cell ``rawData``, the id of its whole
    JSON; cells without a value and columns that the schema lacks are left out.
    """
    names = ["endpoint_id", "table_key", "column_id", "kind", "max_length"]
    whole = schema.select("endpoint_id", "table_key").distinct().select("*", F.lit("rawData").alias("column_id"), F.lit("FILEHANDLEID").alias("kind"), F.lit(None).cast("int").alias("max_length"))
    known = schema.filter("column_id <> 'rawData'").select(*names).unionByName(whole)
    tokens = F.map_concat(F.from_json("object", "map<string,variant>"), F.create_map(F.lit("rawData"), F.parse_json(F.lit("null"))))
    cells = table_objects(payloads, schema).select("*", F.explode(tokens).alias("column_id", "v")).join(F.broadcast(known), names[:3])
    typed = cells.withColumn("token", F.schema_of_variant("v")).withColumn("text", F.to_json("v"))
    nested = F.startswith("text", F.lit("{")) | F.startswith("text", F.lit("["))
    raw = F.when(nested, F.try_element_at(F.from_json("object", "map<string,string>"), "column_id")).otherwise(F.col("text"))  # nested JSON keeps its order of keys
    value = F.coalesce(*(F.when(F.col("kind") == k, S.typed_token("v", "token", raw, k)) for k in S.KINDS))
    value = F.when((F.col("kind") == "STRING") & F.col("max_length").isNotNull(), F.left(value, F.col("max_length"))).otherwise(value)
    value = F.when(F.col("column_id") == "rawData", F.sha2("object", 256)).otherwise(value)
    return typed.select("health_code", "created_date", F.concat_ws(".", "endpoint_id", "table_key").alias("table_id"), "row_no", "column_id", "kind", value.alias("value")).filter("value is not null")


def extract_attachments(rows: DataFrame, json_columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with ids in place of the JSON columns, and (file_id, content) of the contents."""
    ids = rows.withColumns({c: F.sha2(F.col(c), 256) for c in json_columns})
    contents = rows.select(F.explode(F.array(*json_columns)).alias("content")).filter("content is not null").distinct()
    return ids, contents.select(F.sha2("content", 256).alias("file_id"), "content")


def wide_upload_rows(rows: DataFrame, metadata_keys: list[str], data_keys: list[str], common: list[str]) -> DataFrame:
    """Common columns, then one for each metadata and data key, sorted; what is missing is an empty text."""
    cell = lambda c, k: F.coalesce(F.try_element_at(c, F.lit(k)), F.lit(""))
    return rows.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in common), *(cell("metadata", k).alias(k) for k in sorted(metadata_keys)), *(cell("data", k).alias(k) for k in sorted(data_keys)))


def upload_table_row(records: DataFrame, uploads: DataFrame, participants: DataFrame, metadata_keys: list[str]) -> DataFrame:
    """A row per record with an assessment, created when its upload was; some apps' records without one get a container's."""
    guid = F.coalesce("assessment_guid", F.when(F.col("app_id").isin(*NO_ASSESSMENT_APPS), F.lit(CONTAINER_ASSESSMENT)))
    some = records.drop("created_ms").withColumn("assessment_guid", guid).filter("assessment_guid is not null").join(uploads.select("record_id", "created_ms"), "record_id")
    joined = some.join(participants.select("user_id", "health_code", "data_groups"), "user_id")
    return joined.select("record_id", "app_id", "assessment_guid", "created_ms", "health_code", F.coalesce(S.join_sorted_groups("data_groups"), F.lit("")).alias("data_groups"), F.array_contains("data_groups", "test_user").alias("is_test"), S.blank_fill("metadata", metadata_keys).alias("metadata"))


def metadata_json_fields(archives: DataFrame) -> DataFrame:
    """(record_id, fields): the fields of metadata.json as a map; '' unless text that isn't blank, no keys without the file."""
    fields = F.create_map(*(x for k in METADATA_FIELDS for x in (F.lit(k), F.coalesce(S.json_text("metadata_json", k), F.lit("")))))
    return archives.select("record_id", F.when(F.col("metadata_json").isNull(), F.expr("map()").cast("map<string,string>")).otherwise(fields).alias("fields"))


def flatten_answers(result) -> Column:
    """Survey result JSON to a map from question to answer as text; of equal questions the last counts."""
    steps = F.from_json(S._c(result), "struct<stepHistory:array<struct<type:string,identifier:string,value:string>>>").stepHistory
    return F.map_from_entries(F.transform(F.filter(steps, lambda s: (s.type == "answer") & s.value.isNotNull() & s.identifier.isNotNull()), lambda s: F.struct(s.identifier, s.value)))


def answer_columns(config) -> Column:
    """Question identifiers of a survey definition in order; null or no text gives an empty list."""
    steps = F.from_json(S._c(config), "struct<steps:array<struct<type:string,identifier:string>>>").steps
    return F.coalesce(F.transform(F.filter(steps, lambda s: s.identifier.isNotNull()), lambda s: s.identifier), F.expr("cast(array() as array<string>)"))


def participant_version_rows(versions: DataFrame, study: str | None = None) -> DataFrame:
    return versions.select(
        "app_id", "health_code", "participant_version", F.col("created_ms").cast("string").alias("created_on"), F.col("modified_ms").cast("string").alias("modified_on"),
        S.join_sorted_groups("data_groups").alias("data_groups"), S.serialize_languages("languages").alias("languages"), "sharing_scope",
        S.serialize_memberships("study_memberships", study).alias("study_memberships"), "time_zone",
    )


def demographics_rows(versions: DataFrame, study: str | None = None, app_level: bool = True) -> DataFrame:
    """(health_code, participant_version, study_id, category, value, units, invalidity): a row per value.

    ``demographics`` is an array of (study_id, category, units, values of (value, invalidity)); study_id is null at app level.
    An empty list of values gives one row without value; a null category or list gives none.
    """
    usable = versions.filter("health_code is not null and participant_version is not null")
    each = usable.select("health_code", "participant_version", F.explode("demographics").alias("d")).filter("d.category is not null and d.values is not null")
    wanted = F.lit(app_level) & (F.col("d.study_id").isNull() | F.lit(study is None)) | (F.col("d.study_id") == study if study is not None else F.lit(False))
    return each.filter(wanted).select("health_code", "participant_version", "d.study_id", "d.category", "d.units", F.explode_outer("d.values").alias("v")).select("health_code", "participant_version", "study_id", "category", F.col("v.value").alias("value"), "units", F.col("v.invalidity").alias("invalidity"))


def export_annotations(records: DataFrame) -> DataFrame:
    """(record_id, name, type, value): STRING each, but a LONG participantVersion where there is one."""
    texts = records.select("record_id", F.explode("metadata").alias("name", "value")).filter("name <> 'participantVersion'").select("record_id", "name", F.lit("STRING").alias("type"), "value")
    version = records.filter("version is not null").select("record_id", F.lit("participantVersion").alias("name"), F.lit("LONG").alias("type"), F.col("version").cast("string").alias("value"))
    return texts.unionByName(version)


def export_manifest(fanout: DataFrame, studies: DataFrame, apps: DataFrame, bucket: str, exported_on: str) -> DataFrame:
    """(record_id, app_record, study_records): one notice a record, with where its file is at app level and by study.

    ``fanout`` carries (filename, created_ms, content_md5) of its records, the last one the content's digest in Base64; ``studies`` and ``apps``
    have (project_id, folder_id) of their exports.
    """
    of_study = studies.select("study_id", F.struct("project_id", "folder_id").alias("_of_study")).distinct()
    of_app = apps.select("app_id", F.struct("project_id", "folder_id").alias("_of_app")).distinct()
    spread = F.when(F.col("study_id").isNull(), F.concat(F.lit("\0"), F.xxhash64("record_id").cast("string"))).otherwise(F.col("study_id"))  # app-level rows don't meet in one task
    files = fanout.withColumn("md5", S.base64_md5_to_hex("content_md5")).withColumn("_study", spread)
    each = files.join(of_study.withColumnRenamed("study_id", "_study"), "_study", "left").join(of_app, "app_id", "left")
    place = F.when(F.col("study_id").isNull(), F.col("_of_app")).otherwise(F.col("_of_study"))
    key = S.raw_object_key("app_id", "study_id", F.timestamp_millis("created_ms"), S.upload_filename("record_id", "filename"))
    record = F.struct(place["project_id"].alias("project_id"), place["folder_id"].alias("folder_id"), F.lit(bucket).alias("bucket"), key.alias("key"), "md5", F.lit(exported_on).alias("exported_on"))
    pairs = F.collect_list(F.when(F.col("study_id").isNotNull(), F.struct("study_id", "record")))
    grouped = each.select("record_id", "study_id", record.alias("record")).groupBy("record_id")
    return grouped.agg(F.max(F.when(F.col("study_id").isNull(), F.col("record"))).alias("app_record"), F.map_from_entries(F.sort_array(pairs)).alias("study_records"))


def study_table_rows(rows: DataFrame, fanout: DataFrame, studies: DataFrame, participants: DataFrame, apps: DataFrame) -> DataFrame:
    """A copy of an upload row for each of its studies with an upload table, with that study's external id; only beside an app-level export, by an app whose own upload table is on.

    ``rows`` has record_id, user_id and metadata; ``participants`` has external_ids, a map by study; ``apps`` and ``studies`` have upload_table (null is off).
    """
    tabled = apps.filter(F.coalesce("upload_table", F.lit(False))).select("app_id").distinct()
    at_app = fanout.filter("study_id is null").join(tabled, "app_id", "left_semi").select("record_id")
    on = export_configured(studies).filter(F.coalesce("upload_table", F.lit(False))).select("study_id").distinct()
    targets = fanout.filter("study_id is not null").join(at_app, "record_id", "left_semi").join(on, "study_id", "left_semi").select("record_id", "study_id")
    own = participants.select("user_id", F.explode("external_ids").alias("study_id", "_external"))
    each = rows.join(targets, "record_id").join(own, ["user_id", "study_id"], "left")
    more = F.create_map(F.lit("externalId"), S.strip_study_suffix("_external", "study_id"))
    return each.withColumn("metadata", F.when(F.col("_external").isNull(), F.col("metadata")).otherwise(F.map_concat("metadata", more))).drop("_external")


def flatten_roster(participants: DataFrame, excluded: tuple[str, ...] = ROSTER_EXCLUDED) -> DataFrame:
    """Every field but the excluded ones and those of linked accounts as text: objects as JSON, arrays and missing values empty."""
    out = []
    for f in participants.schema.fields:
        if f.name in excluded or re.fullmatch(LINKED_ACCOUNT, f.name):
            continue
        if isinstance(f.dataType, T.ArrayType):
            value = F.lit("")
        elif isinstance(f.dataType, (T.StructType, T.MapType)):
            value = F.coalesce(F.to_json(f.name), F.lit(""))
        else:
            value = F.coalesce(F.col(f.name).cast("string"), F.lit(""))
        out.append(value.alias(f.name))
    return participants.select(*out)


def mask_identifier(df: DataFrame, column: str) -> DataFrame:
    if column not in df.columns:
        raise ValueError(f"no column {column}")
    return df.withColumn(column, F.lit(None).cast(df.schema[column].dataType))


def attachment_columns(schemas: DataFrame) -> DataFrame:
    """(schema_id, columns): rawData and the fields of an attachment type, sorted; ``field_types`` is a map."""
    named = F.map_keys(F.map_filter("field_types", lambda _, t: F.lower(t).isin(*ATTACHMENT_TYPES)))
    return schemas.select("schema_id", F.concat(F.array(F.lit("rawData")), F.array_sort(named)).alias("columns"))


def contact_channel(participants: DataFrame) -> DataFrame:
    """(user_id, channel, address): the verified email, else the verified phone, else invalid."""
    email = F.col("email").isNotNull() & F.coalesce("email_verified", F.lit(False))
    phone = F.col("phone").isNotNull() & F.coalesce("phone_verified", F.lit(False))
    return participants.select("user_id", F.when(email, "email").when(phone, "phone").otherwise("invalid").alias("channel"), F.when(email, F.col("email")).when(phone, F.col("phone")).alias("address"))


def reminder_messages(decisions: DataFrame, participants: DataFrame, commitments: DataFrame, messages: dict[str, list[str]], by_group: dict[str, list[str]], default: str, url: str, date: str) -> DataFrame:
    """(user_id, decision, message): a message of the decision's list by hash, with its templates filled in.

    Before a burst it is the default, unless the user has a commitment: then from the list of the first of the user's groups that has
    one. Users without a message are left out.
    """
    lists = F.create_map(*(x for k, v in messages.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    groups = F.create_map(*(x for k, v in by_group.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    all_ = decisions.join(participants.select("user_id", "data_groups"), "user_id").join(commitments, "user_id", "left")
    group = F.get(F.filter("data_groups", lambda g: F.map_contains_key(groups, g)), 0)
    pre = F.when(F.col("commitment").isNull() | group.isNull(), F.array(F.lit(default))).otherwise(F.try_element_at(groups, group))
    choice = S.pick_message(F.when(F.col("decision") == "PRE_BURST", pre).otherwise(F.try_element_at(lists, "decision")), "user_id", F.lit(date))
    return all_.select("user_id", "decision", S.resolve_template(choice, F.col("commitment"), F.lit(url)).alias("message")).filter("message is not null")


ENVELOPE = "struct<service:string,body:string>"


def route_requests(messages: DataFrame, services: list[str]) -> DataFrame:
    """The messages with service, body and error: bad JSON and unknown services carry an error."""
    parsed = messages.withColumn("m", F.from_json("value", ENVELOPE, {"mode": "PERMISSIVE"}))
    service = F.col("m.service")
    error = F.when(F.try_parse_json("value").isNull(), "bad message").when(service.isNull(), "no service").when(~service.isin(services), "unknown service")
    return parsed.select(*messages.columns, service.alias("service"), F.col("m.body").alias("body"), error.alias("error"))
