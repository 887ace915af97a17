"""Counts and reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .filters import non_staff


def uploads_by_status(uploads: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """(app_id, status, n) of uploads requested from start to end, both included; statuses in lower case, those seen only."""
    return uploads.filter(F.col("requested_ms").between(start_ms, end_ms)).groupBy("app_id", F.lower("status").alias("status")).agg(F.count(F.lit(1)).alias("n"))


def signups_report(participants: DataFrame, start_ms: int, end_ms: int, members: DataFrame) -> DataFrame:
    """(app_id, metric, key, n) for every app and member; ``members`` has (metric, key) of both enums.

    ``by_status`` counts all that aren't staff, ``by_sharing`` the enabled ones of these.
    """
    new = participants.filter(F.col("created_ms").between(start_ms, end_ms))
    own = non_staff(new)
    count = lambda df, metric, key: df.groupBy("app_id", F.lit(metric).alias("metric"), F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    found = count(own, "by_status", "status").unionByName(count(own.filter("status = 'enabled'"), "by_sharing", "sharing_scope"))
    # the enums have a handful of members, so every app times every member stays small
    every = participants.select("app_id").distinct().withColumn("member", F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.lit(k).alias("key")) for m, k in members.select("metric", "key").collect())))).select("app_id", "member.metric", "member.key")
    return every.join(found, ["app_id", "metric", "key"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def first_start_event(events: DataFrame, event_id: str) -> DataFrame:
    return events.filter(F.col("event_id") == event_id).groupBy("app_id", "user_id").agg(F.min("ts_ms").alias("start_ms"))


def whole_days(start: str, end: str):
    """Periods of 24 hours from start to end, toward zero."""
    ms = F.col(end) - F.col(start)
    return F.when(ms >= 0, F.floor(ms / 86_400_000)).otherwise(-F.floor(-ms / 86_400_000)).cast("long")


def retention_histogram(participants: DataFrame, events: DataFrame, request_info: DataFrame, event_id: str = "study_start_date") -> DataFrame:
    """(app_id, metric, day, n): users by days from start to last sign-in and last upload.

    A user whose sign-in lies a day or more before the start is left out of both.
    """
    users = non_staff(participants).select("user_id").join(first_start_event(events, event_id), "user_id").join(request_info.drop("app_id"), "user_id", "left")
    days = users.select("app_id", whole_days("start_ms", "signed_in_ms").alias("by_sign_in"), whole_days("start_ms", "uploaded_ms").alias("by_uploaded_on")).filter("by_sign_in is null or by_sign_in >= 0")
    each = days.select("app_id", F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("day")) for m in ("by_sign_in", "by_uploaded_on")))).alias("e")).select("app_id", "e.metric", "e.day")
    return each.filter("day >= 0").groupBy("app_id", "metric", "day").agg(F.count(F.lit(1)).alias("n"))


def latest_notification(log: DataFrame) -> DataFrame:
    """The newest row of each user, ties by seq; a blank type is UNKNOWN."""
    newest = log.groupBy("user_id").agg(F.max_by(F.struct("time_ms", "type"), F.struct("time_ms", "seq")).alias("n"))
    return newest.select("user_id", "n.time_ms", F.when(F.trim(F.coalesce("n.type", F.lit(""))) == "", "UNKNOWN").otherwise(F.col("n.type")).alias("type"))


def redrive_metrics(results: DataFrame) -> DataFrame:
    """(metric, n): results by ``error`` bucket if there is one, else by final status, sorted by name."""
    return results.groupBy(F.coalesce("error", F.lower("status")).alias("metric")).agg(F.count(F.lit(1)).alias("n")).orderBy("metric")


def rows_by_assessment(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(assessment_guid, n); with a list of ids these alone, empty ones with 0."""
    n = rows.groupBy("assessment_guid").agg(F.count(F.lit(1)).alias("n"))
    return n if ids is None else ids.select("assessment_guid").distinct().join(n, "assessment_guid", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def column_keys(rows: DataFrame) -> DataFrame:
    """(assessment_guid, kind, key, position): the distinct keys of metadata (kind 0) and then of data (1) of each assessment, each sorted and numbered from 1.

    Keys are made distinct within tasks before they are sent, and numbered by a sort that spills, so an assessment may have any number of them.
    """
    part = lambda c, kind: rows.select("assessment_guid", F.lit(kind).alias("kind"), F.explode(F.map_keys(c)).alias("key"))
    own = Window.partitionBy("assessment_guid").orderBy("kind", "key")
    return part("metadata", 0).unionByName(part("data", 1)).distinct().withColumn("position", F.row_number().over(own).cast("long"))


def keys_by_assessment(keys: DataFrame) -> DataFrame:
    """(assessment_guid, metadata_keys, data_keys) of ``column_keys``: arrays, for assessments with few enough keys for a row."""
    of = lambda kind: F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.col("key"))))
    return keys.groupBy("assessment_guid").agg(of(0).alias("metadata_keys"), of(1).alias("data_keys"))


def column_union(rows: DataFrame) -> DataFrame:
    """(assessment_guid, metadata_keys, data_keys), each sorted."""
    return keys_by_assessment(column_keys(rows))


def distinct_attachments(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(file_handle_id): ids in any of the columns that aren't blank."""
    return rows.select(F.explode(F.array(*columns)).alias("file_handle_id")).filter("trim(file_handle_id) <> ''").distinct()


def row_count_reconciliation(expected: DataFrame, written: DataFrame, key: str) -> DataFrame:
    """(key, expected, written, matches) of every destination on either side."""
    count = lambda df, name: df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    both = count(expected, "expected").join(count(written, "written"), key, "full").na.fill(0, ["expected", "written"])
    return both.withColumn("matches", F.col("expected") == F.col("written"))


def out_of_compliance(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("weekly_percent") < F.coalesce("threshold", F.lit(0)))


def report_frame(metrics: DataFrame, app_column: str, report_suffix: str, start: str, scheduler: str = "") -> DataFrame:
    """(app_id, report_id, date) before the metrics' own columns; the date is that of the start, an ISO time, in its own zone."""
    rest = [c for c in metrics.columns if c != app_column]
    date = datetime.fromisoformat(start).date().isoformat()
    return metrics.select(F.col(app_column).alias("app_id"), F.lit(scheduler + report_suffix).alias("report_id"), F.lit(date).alias("date"), *rest)
