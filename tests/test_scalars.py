import pytest
from pyspark.sql import functions as F

from cohortry.functions import scalars as S


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


@pytest.mark.parametrize(
    ("raw", "kind", "length", "want"),
    [
        (None, "STRING", None, None), ("null", "STRING", None, None), ("1", "BOOLEAN", None, None), ('"true"', "BOOLEAN", None, None), ("true", "BOOLEAN", None, "true"),
        ("1513152387123", "DATE", None, None), ('"December 12, 2017 at 18:56:51"', "DATE", None, None), ('"2017-12-12T18:56:51.098Z"', "DATE", None, "1513105011098"), ('"18:56"', "DATE", None, None),
        ('"3.14159"', "DOUBLE", None, None), ("3.14159", "DOUBLE", None, "3.14159"), ("3", "DOUBLE", None, "3"),
        ('"42"', "INTEGER", None, None), ("42", "INTEGER", None, "42"), ("3.14159", "INTEGER", None, "3"),
        ("1024", "STRING", 10, "1024"), ('"foo"', "STRING", 10, "foo"), ('"aaaabbbbccccdddd"', "STRING", 10, "aaaabbbbcc"), ('"foo"', "BINARY", None, None),
        ('{"foo":"foo-value","bar":"bar-value"}', "LARGETEXT", None, '{"foo":"foo-value","bar":"bar-value"}'),
    ],
)
def test_typed_json_value(spark, raw, kind, length, want):
    assert one(spark, S.typed_json_value(F.lit(raw).cast("string"), kind, length)) == (want,)


def test_memberships(spark):
    m = F.create_map(*map(F.lit, ("studyC", "<none>", "studyB", "extB", "studyA", "extA")))
    assert one(spark, S.serialize_memberships(m), S.serialize_memberships(m, "studyA"), S.serialize_memberships(m, "studyX")) == ("|studyA=extA|studyB=extB|studyC=|", "|studyA=extA|", "|studyX=null|")
    assert one(spark, S.serialize_memberships(F.expr("cast(map() as map<string,string>)")), S.serialize_memberships(F.lit(None).cast("map<string,string>"))) == (None, None)


def test_languages_and_groups(spark):
    many = F.array(*(F.lit(f"l{i}") for i in range(11)))
    assert one(spark, S.serialize_languages(F.array(F.lit("es-ES"), F.lit("en-UK"))), S.serialize_languages(F.array(F.lit("language")))) == ('["es-ES","en-UK"]', '["langu"]')
    assert one(spark, S.serialize_languages(many))[0].count(",") == 9
    assert one(spark, S.join_sorted_groups(F.array(F.lit("bbb-group"), F.lit("aaa-group")))) == ("aaa-group,bbb-group",)


def test_template(spark):
    m = F.lit("url=${url} ${url}, studyCommitment=${studyCommitment} ${studyCommitment}")
    assert one(spark, S.resolve_template(m, F.lit("dummy answer"), F.lit("http://e/u"))) == ("url=http://e/u http://e/u, studyCommitment=dummy answer dummy answer",)
    assert one(spark, S.resolve_template(m, F.lit(None).cast("string"), F.lit("u"))) == (None,)


def test_offsets_days_dates(spark):
    assert one(spark, *(S.offset_in_window(F.lit(x)) for x in ("-11:00", "-01:00", "-12:00", "+01:00", "-00:30"))) == (True, True, False, False, False)
    ts = lambda x: F.lit(x).cast("timestamp")
    assert one(spark, S.days_between_utc(ts("2017-06-05 00:00:00"), ts("2017-06-04 04:50:21")), S.days_between_utc(ts("2017-06-05 00:00:00"), ts("2017-06-09 01:50:21"))) == (0, 4)
    assert one(spark, S.parse_iso_date(F.lit("2018-4-3")), S.parse_iso_date(F.lit("2018-02-30"))) == (None, None)


def test_names_and_maps(spark):
    assert one(spark, S.clean_name(F.lit("Assessment A: First Assessment"))) == ("AssessmentAFirstAssessment",)
    assert one(spark, S.sanitize_metadata_name(F.create_map(F.lit("a b"), F.lit("1"), F.lit("a/b"), F.lit("2"))))[0] == {"a_b": "2"}
    assert one(spark, S.report_suffix(F.lit("DAILY")), S.report_suffix(F.lit("DAILY_RETENTION"))) == ("-daily-upload-report", "-daily-retention-report")
    assert one(spark, S.json_string_list(F.lit('{"a":["x",null]}'), "a"), S.json_string_list(F.lit('{"a":[]}'), "a"), S.json_text(F.lit('{"a":" "}'), "a")) == (None, [], None)
    assert one(spark, S.strip_html(F.lit("<p>a<br/> b</p>\n<b>c</b>"))) == ("a b c",)
