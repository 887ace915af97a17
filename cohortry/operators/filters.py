"""Filters: what a job takes on, and why the rest stays out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import offset_in_window

CONSENT_GROUPS = ("clinical_consent", "test_no_consent")  # fixed values
REPORTED_PHASES = ("design", "recruitment", "in_flight")  # fixed values
ROSTER_ROLES = ("researcher", "admin", "superadmin", "study_coordinator")  # fixed values


def shareable_records(records: DataFrame, participants: DataFrame) -> DataFrame:
    """Records of which neither the own scope nor the participant's current one is ``no_sharing``; an unknown scope passes."""
    blocked = participants.filter("sharing_scope = 'no_sharing'").select("user_id")
    return records.filter(~F.col("sharing_scope").eqNullSafe("no_sharing")).join(blocked, "user_id", "left_anti")


def is_export_configured() -> Column:
    return F.coalesce(F.col("export_enabled"), F.lit(False)) & F.coalesce(F.col("configured"), F.lit(False))


def export_configured(df: DataFrame) -> DataFrame:
    return df.filter(is_export_configured())


def demographics_configured(df: DataFrame) -> DataFrame:
    return df.filter(is_export_configured() & F.col("table_id").isNotNull() & F.col("view_id").isNotNull())


def tabulation_configured(apps: DataFrame, vendor: str) -> DataFrame:
    """``providers`` is a map from vendor to settings."""
    return apps.filter(F.col("project_id").isNotNull() & F.col("team_id").isNotNull() & F.coalesce(F.map_contains_key("providers", vendor), F.lit(False)))


def app_whitelist(apps: DataFrame, ids: list[str] | None = None) -> DataFrame:
    return apps.filter(F.col("app_id").isin(ids)) if ids else apps


def reportable_studies(apps: DataFrame, studies: DataFrame, selected: DataFrame | None = None) -> DataFrame:
    """Studies of flagged apps in a reported phase with a schedule; ``selected`` (app_id, study_id) narrows the apps it names."""
    out = studies.join(apps.filter(F.coalesce("adherence_enabled", F.lit(False))).select("app_id"), "app_id", "left_semi")
    out = out.filter(F.col("phase").isin(*REPORTED_PHASES) & F.col("schedule_guid").isNotNull())
    if selected is None:
        return out
    named = selected.select("app_id").distinct().withColumn("_named", F.lit(True))
    return out.join(named, "app_id", "left").join(selected.withColumn("_chosen", F.lit(True)), ["app_id", "study_id"], "left").filter(F.col("_named").isNull() | F.col("_chosen").isNotNull()).drop("_named", "_chosen")


def consented_users(participants: DataFrame, consents: DataFrame) -> DataFrame:
    """Users in a group that needs no consent, or whose last consent isn't withdrawn."""
    last = consents.groupBy("user_id").agg(F.max_by(F.struct(F.col("withdrew_ms").alias("w")), "signed_ms").alias("last"))
    free = F.arrays_overlap("data_groups", F.array(*map(F.lit, CONSENT_GROUPS)))
    return participants.join(last, "user_id", "left").filter(F.coalesce(free, F.lit(False)) | (F.col("last").isNotNull() & F.col("last.w").isNull())).drop("last")


def reminder_cooldown(users: DataFrame, last_notification: DataFrame, burst_days: int, as_of_ms: int) -> DataFrame:
    """Users not reminded within the days of a burst, other than by a note before it."""
    recent = last_notification.filter((F.col("type") != "PRE_BURST") & (F.col("time_ms") > as_of_ms - burst_days * 86_400_000)).select("user_id")
    return users.join(recent, "user_id", "left_anti")


def reminder_eligible_users(participants: DataFrame, consents: DataFrame, last_notification: DataFrame, excluded_groups: list[str], burst_days: int, as_of_ms: int) -> DataFrame:
    out = participants.filter(F.coalesce("phone_verified", F.lit(True)) & F.coalesce(offset_in_window("time_zone"), F.lit(False)))
    out = out.filter(~F.arrays_overlap("data_groups", F.array(*map(F.lit, excluded_groups))))
    return reminder_cooldown(consented_users(out, consents), last_notification, burst_days, as_of_ms)


def burst_start_events(events: DataFrame, config: DataFrame) -> DataFrame:
    """Events whose id is among the start events of the app's config."""
    ids = config.select("app_id", F.explode("start_event_ids").alias("event_id"))
    return events.join(ids, ["app_id", "event_id"], "left_semi")


def non_staff(participants: DataFrame) -> DataFrame:
    return participants.filter(F.size("roles") == 0)


def phone_accounts(accounts: DataFrame, phone_only: bool) -> DataFrame:
    return accounts.filter(F.col("phone").isNotNull()) if phone_only else accounts


def roster_authorized(requests: DataFrame, participants: DataFrame, sponsorships: DataFrame) -> DataFrame:
    """Requests (request_id, user_id, study_id) whose sender may read the roster.

    The email is there and verified, one role is allowed, and a coordinator's organisation sponsors the study.
    """
    allowed = participants.filter(F.col("email").isNotNull() & F.coalesce("email_verified", F.lit(False)) & F.arrays_overlap("roles", F.array(*map(F.lit, ROSTER_ROLES))))
    sent = requests.join(allowed.select("user_id", "roles", "org_id"), "user_id")
    sponsored = sponsorships.select("org_id", "study_id").distinct().withColumn("_sponsored", F.lit(True))
    return sent.join(sponsored, ["org_id", "study_id"], "left").filter(~F.array_contains("roles", "study_coordinator") | F.col("_sponsored").isNotNull()).select(*requests.columns)


def validate_requests(requests: DataFrame, required: list[str], start: str | None = None, end: str | None = None, enums: dict[str, list[str]] | None = None) -> DataFrame:
    """All requests with ``reasons``, an array; a valid request has none."""
    checks = [F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), f"{c} is required") for c in required]
    if start and end:
        checks.append(F.when(F.col(start) > F.col(end), f"{start} is after {end}"))
    checks += [F.when(~F.col(c).isin(members), f"{c} is unknown") for c, members in (enums or {}).items()]
    return requests.withColumn("reasons", F.array_compact(F.array(*checks)))


def schema_key_audit(payloads: DataFrame, schema: DataFrame, ignored: DataFrame | None = None) -> DataFrame:
    """(endpoint_id, table_key, column_id, problem, n): what payloads hold beside the schema (endpoint_id, table_key, column_id).

    Tables that are neither in it nor ignored (endpoint_id, table_key), tables that are neither array nor object, and columns that their
    table lacks; column_id is null but for the last. The schema, a configuration, is sent to all tasks.
    """
    tables = F.broadcast(schema.select("endpoint_id", "table_key").distinct())
    keys = payloads.select("endpoint_id", F.explode(F.from_json("payload", "map<string,string>")).alias("table_key", "raw"))
    other = keys.join(tables, ["endpoint_id", "table_key"], "left_anti")
    if ignored is not None:
        other = other.join(F.broadcast(ignored.select("endpoint_id", "table_key")), ["endpoint_id", "table_key"], "left_anti")
    known = keys.join(tables, ["endpoint_id", "table_key"], "left_semi")
    array, single = F.startswith("raw", F.lit("[")), F.startswith("raw", F.lit("{"))
    odd = known.filter(F.col("raw").isNull() | ~(array | single))
    rows = known.select("endpoint_id", "table_key", F.explode(F.when(array, F.from_json("raw", "array<string>")).when(single, F.array("raw"))).alias("object"))
    names = rows.select("endpoint_id", "table_key", F.explode(F.json_object_keys("object")).alias("column_id"))
    columns = names.join(F.broadcast(schema.select("endpoint_id", "table_key", "column_id")), ["endpoint_id", "table_key", "column_id"], "left_anti")
    none = F.lit(None).cast("string").alias("column_id")
    found = [
        other.select("endpoint_id", "table_key", none, F.lit("unexpected table").alias("problem")), odd.select("endpoint_id", "table_key", none, F.lit("neither array nor object").alias("problem")),
        columns.select("endpoint_id", "table_key", "column_id", F.lit("unexpected column").alias("problem")),
    ]
    return found[0].unionByName(found[1]).unionByName(found[2]).groupBy("endpoint_id", "table_key", "column_id", "problem").agg(F.count(F.lit(1)).alias("n"))


def unexpected_columns(answers: DataFrame, definition: DataFrame) -> DataFrame:
    """(record_id, assessment_guid, name) of answers that the definition (assessment_guid, name) doesn't list."""
    names = answers.select("record_id", "assessment_guid", F.explode(F.map_keys("answers")).alias("name"))
    return names.join(definition, ["assessment_guid", "name"], "left_anti")


def drop_empty_extracts(extracts: DataFrame) -> DataFrame:
    """Groups (request_id, table_id) that have a row; a header alone has a null record."""
    return extracts.groupBy("request_id", "table_id").agg(F.count("record_id").alias("n")).filter("n >= 1")


def error_budget(errors: DataFrame, limit: int = 100) -> DataFrame:
    return errors.groupBy("app_id").agg(F.count(F.lit(1)).alias("bad")).select("app_id", "bad", F.lit(limit).cast("long").alias("bad_limit"), (F.col("bad") < limit).alias("passed"))
