"""Scalar functions: each takes and returns columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sanitize_metadata_name(m) -> Column:
    """Map keys with ``_`` for all but word characters and dots; of keys that become equal the last wins."""
    return F.transform_keys(_c(m), lambda k, _: F.regexp_replace(k, r"[^\w.]", "_"))


def clean_name(s) -> Column:
    return F.regexp_replace(_c(s), r"[^a-zA-Z0-9\-_]", "")


def strip_html(s) -> Column:
    """Text without tags, white space collapsed; entities stay as they are."""
    return F.trim(F.regexp_replace(F.regexp_replace(_c(s), r"<[^>]*>", " "), r"\s+", " "))


def merge_metadata(app, system, timeline, content_type) -> Column:
    """App map under system keys, under timeline map, under the content type."""
    kind = F.when(_c(content_type).isNotNull(), F.create_map(F.lit("contentType"), _c(content_type))).otherwise(F.expr("map()").cast("map<string,string>"))
    none = F.expr("map()").cast("map<string,string>")
    return F.map_concat(*(F.coalesce(_c(m), none) for m in (app, system, timeline)), kind)


def upload_filename(id_, name) -> Column:
    return F.concat(_c(id_).cast("string"), F.lit("-"), _c(name))


def local_folder_date(ts, zone: str = "America/Los_Angeles") -> Column:
    return F.to_date(F.from_utc_timestamp(_c(ts), zone))


def raw_object_key(app, study, ts, filename, zone: str = "America/Los_Angeles") -> Column:
    """app/[study/]date/filename with the date of the zone; a null study is left out."""
    return F.concat_ws("/", _c(app), _c(study), local_folder_date(ts, zone).cast("string"), _c(filename))


def base64_md5_to_hex(b64) -> Column:
    return F.lower(F.hex(F.unbase64(_c(b64))))


def content_md5(content) -> Column:
    return F.md5(_c(content))


def join_sorted_groups(groups) -> Column:
    """Sorted and comma-joined; null or empty gives null."""
    return F.when(F.size(_c(groups)) > 0, F.array_join(F.array_sort(_c(groups)), ","))


def serialize_languages(languages, most: int = 10, width: int = 5) -> Column:
    """The first ``most`` in order, each cut to ``width``, as a JSON array; null or empty gives null."""
    return F.when(F.size(_c(languages)) > 0, F.to_json(F.transform(F.slice(_c(languages), 1, most), lambda x: F.substring(x, 1, width))))


def serialize_memberships(m, study: str | None = None) -> Column:
    """``|study=external|...|`` sorted by the formatted pair; ``<none>`` is empty; with a study only that one (absent: ``null``); null or empty gives null."""
    shown = lambda k, v: F.concat(k, F.lit("="), F.when(v == "<none>", F.lit("")).otherwise(F.coalesce(v, F.lit("null"))))
    if study is not None:
        body = shown(F.lit(study), F.try_element_at(_c(m), F.lit(study)))
    else:
        body = F.array_join(F.array_sort(F.transform(F.map_entries(_c(m)), lambda e: shown(e.key, e.value))), "|")
    return F.when(F.size(_c(m)) > 0, F.concat(F.lit("|"), body, F.lit("|")))


def strip_study_suffix(external_id, study) -> Column:
    suffix = F.concat(F.lit(":"), _c(study))
    return F.when(F.endswith(_c(external_id), suffix), F.substring(_c(external_id), F.lit(1), F.length(_c(external_id)) - F.length(suffix))).otherwise(_c(external_id))


def report_suffix(kind) -> Column:
    k = F.lower(_c(kind))
    return F.when(k.isin("daily", "weekly"), F.concat(F.lit("-"), k, F.lit("-upload-report"))).otherwise(F.concat(F.lit("-"), F.replace(k, F.lit("_"), F.lit("-")), F.lit("-report")))


def _token(json, key: str) -> Column:
    """SQL type of a key's JSON token, null if there is none."""
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json(_c(json)), f"$.{key}", "variant"))


def json_text(json, key: str) -> Column:
    """A non-blank text, else null."""
    value = F.get_json_object(_c(json), f"$.{key}")
    return F.when((_token(json, key) == "STRING") & (F.trim(value) != ""), value)


def json_string_list(json, key: str) -> Column:
    """A list whose every element is text, else null."""
    parts = F.try_variant_get(F.try_parse_json(_c(json)), f"$.{key}", "array<variant>")
    texts = F.transform(parts, lambda v: F.try_variant_get(v, "$", "string"))
    return F.when(F.startswith(_token(json, key), F.lit("ARRAY")) & F.forall(parts, lambda v: F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))), texts)


def json_path_value(json, *keys: str) -> Column:
    """The text found along the keys; null for a missing or empty value or where there is no object."""
    value = F.get_json_object(F.when(F.try_parse_json(_c(json)).isNotNull(), _c(json)), "$" + "".join(f".{k}" for k in keys))
    return F.when(value != "", value)


def resolve_template(message, commitment, url) -> Column:
    """Null where the message asks for a commitment and there is none."""
    m = F.replace(_c(message), F.lit("${url}"), _c(url))
    return F.when(F.contains(m, F.lit("${studyCommitment}")) & _c(commitment).isNull(), F.lit(None)).otherwise(F.replace(m, F.lit("${studyCommitment}"), F.coalesce(_c(commitment), F.lit(""))))


def pick_message(messages, user, date) -> Column:
    """One of the messages by a hash of user and date; null if there is none."""
    n = F.conv(F.substring(F.md5(F.concat(_c(user).cast("string"), _c(date).cast("string"))), 1, 8), 16, 10).cast("bigint")
    return F.when(F.size(_c(messages)) > 0, F.get(_c(messages), F.pmod(n, F.size(_c(messages))).cast("int")))


def offset_minutes(offset) -> Column:
    """``±HH:MM`` in minutes."""
    sign = F.when(F.startswith(_c(offset), F.lit("-")), -1).otherwise(1)
    return sign * (F.substring(_c(offset), 2, 2).cast("int") * 60 + F.substring(_c(offset), 5, 2).cast("int"))


def offset_in_window(offset, low: int = -660, high: int = -60) -> Column:
    return offset_minutes(offset).between(low, high)


def days_between_utc(start, end) -> Column:
    """Whole periods of 24 hours, toward zero."""
    return F.timestamp_diff("DAY", _c(start), _c(end)).cast("bigint")


def epoch_millis(ts) -> Column:
    return F.unix_millis(_c(ts)).cast("string")


def parse_iso_date(s) -> Column:
    """Strictly YYYY-MM-DD, else null."""
    return F.when(F.rlike(_c(s), F.lit(r"^\d{4}-\d{2}-\d{2}$")), F.try_to_date(_c(s), "yyyy-MM-dd"))


def blank_fill(m, keys: list[str]) -> Column:
    """The map with an empty text for each of the keys that it lacks."""
    return F.map_concat(F.map_from_arrays(F.array(*map(F.lit, keys)), F.array(*(F.lit("") for _ in keys))), _c(m))


# Fixed values.
KINDS = ("BOOLEAN", "DATE", "DOUBLE", "INTEGER", "STRING", "LARGETEXT", "FILEHANDLEID")


def typed_token(v, token, raw, kind: str) -> Column:
    """A variant, the name of its type and its JSON as text of a column type; see ``typed_json_value``."""
    v, token, raw = _c(v), _c(token), _c(raw)
    number = token.isin("BIGINT", "DOUBLE") | F.startswith(token, F.lit("DECIMAL"))
    text = F.when(token == "STRING", F.try_variant_get(v, "$", "string"))
    present = token.isNotNull() & (token != "VOID")
    if kind == "BOOLEAN":
        return F.when(token == "BOOLEAN", raw)
    if kind == "DATE":
        return F.when(F.rlike(text, F.lit(r"^\d{4}-\d{2}-\d{2}")), F.unix_millis(F.try_to_timestamp(text)).cast("string"))
    if kind == "DOUBLE":
        return F.when(number, raw)
    if kind == "INTEGER":
        return F.when(number, F.try_variant_get(v, "$", "bigint").cast("string"))
    if kind == "STRING":
        return F.when(present, F.coalesce(text, raw))
    if kind == "LARGETEXT":
        return F.when(present, raw)
    if kind == "FILEHANDLEID":
        return F.when(present, F.sha2(raw, 256))
    return F.lit(None).cast("string")


def typed_json_value(raw, kind: str, max_length: int | None = None) -> Column:
    """A JSON token as text of a column type: the type of the token decides, not its looks.

    BOOLEAN takes booleans, DATE texts in ISO-8601 (to epoch milliseconds), DOUBLE and INTEGER numbers
    (integers are truncated), STRING anything (cut), LARGETEXT the JSON as it stands; any other kind gives null.
    """
    v = F.try_parse_json(_c(raw))
    value = typed_token(v, F.schema_of_variant(v), raw, kind)
    return F.substring(value, 1, max_length) if kind == "STRING" and max_length else value
