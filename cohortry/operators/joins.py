"""Joins of records, participants, studies, apps and their side tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .filters import export_configured

UNKNOWN_ERROR = "Unknown error downloading attachment"  # fixed value


def study_fanout(records: DataFrame, participants: DataFrame, schedule_studies: DataFrame, studies: DataFrame, apps: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(record_id, app_id, study_id) and the columns to ``carry``: a record's configured studies, and a row without study where its app is configured.

    The participant's studies count, of a record with a schedule only those that use the schedule. Records are read once: they meet their user's studies
    and their schedule's as arrays. Records without a schedule are spread by record, so that they don't meet in one task.
    """
    on, none = export_configured(studies).select("study_id").distinct(), F.array().cast("array<string>")
    member = participants.select("user_id", F.explode("study_ids").alias("study_id")).join(on, "study_id", "left_semi").groupBy("user_id").agg(F.collect_set("study_id").alias("_studies"))
    using = schedule_studies.filter("schedule_guid is not null").groupBy(F.col("schedule_guid").alias("_key")).agg(F.collect_set("study_id").alias("_using"))
    app = export_configured(apps).select("app_id").distinct().withColumn("_app", F.lit(True))
    free = F.col("schedule_guid").isNull()
    keyed = records.select("record_id", "app_id", "user_id", "schedule_guid", *carry).withColumn("_key", F.when(free, F.concat(F.lit("\0"), F.xxhash64("record_id").cast("string"))).otherwise(F.col("schedule_guid")))
    each = keyed.join(using, "_key", "left").join(app, "app_id", "left").join(member, "user_id", "left")
    own = F.coalesce("_studies", none)
    picked = F.when(free, own).otherwise(F.array_intersect(own, F.coalesce("_using", none)))
    whole = F.when(F.col("_app"), F.array(F.lit(None).cast("string"))).otherwise(none)
    return each.select("record_id", "app_id", F.explode(F.concat(picked, whole)).alias("study_id"), *carry)


def version_fanout(versions: DataFrame, studies: DataFrame, apps: DataFrame) -> DataFrame:
    """A version's app-level row and one row for each configured study that it is a member of, with ``study_id``."""
    member = versions.withColumn("study_id", F.explode("study_ids")).join(export_configured(studies).select("study_id").distinct(), "study_id", "left_semi")
    whole = versions.join(export_configured(apps).select("app_id"), "app_id", "left_semi").withColumn("study_id", F.lit(None).cast("string"))
    return member.unionByName(whole)


def redrive_versions(ids: DataFrame, versions: DataFrame, studies: DataFrame, apps: DataFrame) -> DataFrame:
    """All versions of the listed users for each destination table."""
    out = version_fanout(versions.join(ids, "user_id", "left_semi"), studies, apps)
    return out.withColumn("table_id", F.concat_ws(".", "app_id", "study_id"))


def backfill_candidates(ids: DataFrame, versions: DataFrame) -> DataFrame:
    return ids.join(versions.select("user_id"), "user_id", "left_anti")


def user_endpoint_pairs(users: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Users with the endpoints whose scope they granted."""
    return users.withColumn("scope", F.explode("scopes")).join(endpoints, "scope").select("user_id", "endpoint_id").distinct()


def timeline_enrich(records: DataFrame, timeline: DataFrame) -> DataFrame:
    """``metadata`` with the timeline's on top, by instance guid; without one it stays."""
    more = timeline.select("instance_guid", F.col("metadata").alias("_more"))
    placed = records.filter("instance_guid is not null").join(more, "instance_guid", "left").withColumn("metadata", F.when(F.col("_more").isNull(), F.col("metadata")).otherwise(F.map_concat("metadata", "_more"))).drop("_more")
    return placed.unionByName(records.filter("instance_guid is null"))


def assessment_lookup(rows: DataFrame, local: DataFrame, shared: DataFrame) -> DataFrame:
    """Title of the local assessment, else the shared one, else null."""
    one, two = (df.select("assessment_guid", F.col("title").alias(name)) for df, name in ((local, "_local"), (shared, "_shared")))
    return rows.join(one, "assessment_guid", "left").join(two, "assessment_guid", "left").withColumn("title", F.coalesce("_local", "_shared")).drop("_local", "_shared")


def resolve_upload_ids(ids: DataFrame, uploads: DataFrame, redrive_type: str) -> DataFrame:
    """``upload_id`` of each listed id, which is an upload or a record id."""
    if redrive_type == "upload_id":
        return ids.select(F.col("id").alias("upload_id"))
    return ids.join(uploads.select(F.col("record_id").alias("id"), "upload_id"), "id").select("upload_id")


def replace_file_handles(rows: DataFrame, summaries: DataFrame, columns: list[str]) -> DataFrame:
    """Attachment ids by zip entry names, else by the failure; blanks stay. Of equal ids the last summary counts."""
    text = F.coalesce("zip_entry", "failure", F.lit(UNKNOWN_ERROR))
    last = summaries.filter("file_handle_id is not null").groupBy("file_handle_id").agg(F.max_by(text, "seq").alias("_text"))
    out, spread = rows, F.concat(F.lit("\0"), F.xxhash64(*rows.columns).cast("string"))
    for c in columns:
        blank = F.col(c).isNull() | (F.trim(c) == "")
        keyed = out.withColumn("_key", F.when(blank, spread).otherwise(F.col(c)))  # blanks match nothing, and don't meet in one task
        out = keyed.join(last.withColumnRenamed("file_handle_id", "_key"), "_key", "left").withColumn(c, F.when(blank, F.col(c)).otherwise(F.coalesce("_text", F.lit(UNKNOWN_ERROR)))).drop("_text", "_key")
    return out.select(*rows.columns)


def date_bin(c, bin_days: int):
    return F.floor(F.unix_date(c) / bin_days).cast("int")


def spread_requests(requests: DataFrame, participants: DataFrame, data_rows: DataFrame, bin_days: int, most: int) -> DataFrame:
    """(health_code, bin, chunk, chunks, request_id, start_date, end_date): a request's row for each bin of dates that it touches among the rows' dates.

    Where a user has more than ``most`` requests in a bin, they are dealt into chunks of about as many.
    """
    dates = data_rows.agg(F.min("upload_date").alias("low"), F.max("upload_date").alias("high"))
    who = requests.join(participants.select("user_id", "health_code"), "user_id").select("request_id", "health_code", "start_date", "end_date")
    clipped = who.withColumn("_from", F.greatest("start_date", dates.select("low").scalar())).withColumn("_to", F.least("end_date", dates.select("high").scalar()))
    bins = F.when(F.col("_from") <= F.col("_to"), F.sequence(date_bin(F.col("_from"), bin_days), date_bin(F.col("_to"), bin_days)))
    each = clipped.select("request_id", "health_code", "start_date", "end_date", F.explode(bins).alias("bin"))
    chunks = each.groupBy("health_code", "bin").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("chunks"))
    return each.join(chunks, ["health_code", "bin"]).withColumn("chunk", F.pmod(F.xxhash64("request_id"), F.col("chunks")).cast("int"))


def user_data_extract(requests: DataFrame, participants: DataFrame, data_rows: DataFrame, bin_days: int = 32, most: int = 500) -> DataFrame:
    """``data_rows`` of each request's user from start to end date, both included, with its request_id.

    Rows meet requests in bins of dates, so a row is only compared with requests near its date; a row without any goes before that. A row
    is copied once for each chunk of a user's requests in its bin.
    """
    spread = spread_requests(requests, participants, data_rows, bin_days, most)
    wanted = spread.groupBy("health_code", "bin").agg(F.max("chunks").alias("_chunks"))
    rows = data_rows.withColumn("bin", date_bin(F.col("upload_date"), bin_days)).join(wanted, ["health_code", "bin"])
    dealt = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))).drop("_chunks")
    return dealt.join(spread.drop("chunks"), ["health_code", "bin", "chunk"]).filter("upload_date between start_date and end_date").select("request_id", *data_rows.columns)


def extract_tables(requests: DataFrame, participants: DataFrame, tables: dict[str, DataFrame], whole: dict[str, DataFrame]) -> DataFrame:
    """(request_id, table_id, kind, row): rows, as JSON, of every mapped table for each request's user and dates, and of the request's app every survey or metadata table whole.

    Mapped tables have health_code and upload_date, the others app_id. All mapped tables are joined at once, and so are all others.
    """
    parts = []
    if tables:
        data = [rows.select("health_code", "upload_date", F.lit(name).alias("table_id"), F.to_json(F.struct(*rows.columns)).alias("row")) for name, rows in tables.items()]
        own = user_data_extract(requests, participants, reduce(DataFrame.unionByName, data))
        parts.append(own.select("request_id", "table_id", F.lit("data").alias("kind"), "row"))
    if whole:
        every = [rows.select("app_id", F.lit(name).alias("table_id"), F.to_json(F.struct(*rows.columns)).alias("row")) for name, rows in whole.items()]
        own = reduce(DataFrame.unionByName, every).join(requests.select("request_id", "app_id"), "app_id")
        parts.append(own.select("request_id", "table_id", F.lit("survey").alias("kind"), "row"))
    return reduce(DataFrame.unionByName, parts)


def canonical_schemas(schemas: DataFrame, table_map: DataFrame) -> DataFrame:
    """(table_id, schema_id, revision): of the schemas mapped to a table the one of highest revision, ties by id.

    Schemas only tell which mappings count, so repeated ones meet as one before the join.
    """
    names = ["app_id", "schema_id", "revision"]
    mapped = table_map.join(schemas.select(*names).distinct(), names, "left_semi")
    return mapped.groupBy("table_id").agg(F.max(F.struct("revision", "app_id", "schema_id")).alias("s")).select("table_id", "s.app_id", "s.schema_id", "s.revision")


def stale_mappings(table_map: DataFrame, tables: DataFrame) -> DataFrame:
    return table_map.join(tables.select("table_id"), "table_id", "left_anti")


def adherence_pairs(accounts: DataFrame, studies: DataFrame, reports: DataFrame) -> DataFrame:
    """Accounts in a reportable study with their weekly report; without one they are left out."""
    each = accounts.select("app_id", "user_id", F.explode("study_ids").alias("study_id")).distinct()
    return each.join(studies.select("app_id", "study_id", "threshold"), ["app_id", "study_id"]).join(reports, ["user_id", "study_id"])


def study_commitment(participants: DataFrame, report_data: DataFrame) -> DataFrame:
    """(user_id, commitment): ``benefits`` of the first Engagement report of 2000-12-31; null if there is none or it can't be read."""
    first = report_data.filter("report_id = 'Engagement' and report_date = '2000-12-31'").groupBy("user_id").agg(F.min_by("data", "seq").alias("data"))
    value = F.get_json_object(F.when(F.try_parse_json("data").isNotNull(), F.col("data")), "$.benefits")
    return participants.select("user_id").join(first, "user_id", "left").select("user_id", value.alias("commitment"))
