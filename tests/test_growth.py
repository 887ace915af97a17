"""What grows with the rows must not grow faster: files, join rows, shuffles."""

import zipfile

from pyspark.sql import functions as F

from cohortry.operators import flatten as L
from cohortry.operators import joins as J
from cohortry.sources import readers as R
from cohortry.sources import sinks as K


def plan(df):
    return df._jdf.queryExecution().toString()


def test_bundle_files_dont_follow_the_requests(spark, tmp_path):
    rows = spark.range(3000).select(F.col("id").alias("request_id"), F.explode(F.array(F.lit(" a"), F.lit("b"))).alias("table_id"), F.when(F.col("id") % 3 == 0, "survey").otherwise("data").alias("kind"), F.to_json(F.struct(F.lit('x,"\n').alias("v"), "id")).alias("row"))
    message = ' two\nlines, "quoted" '
    K.write_extract_bundle(rows, spark.range(100).select(F.col("id").alias("request_id"), F.lit(message).alias("message")), str(tmp_path / "b"))
    assert len(list((tmp_path / "b").rglob("part-*"))) <= 3 * 2 * K.BUNDLE_PARTS
    got = sorted(tuple(r) for kind in ("data", "survey") for r in K.read_extract_bundle(spark, str(tmp_path / "b"), kind).collect())
    assert got == sorted((str(r.request_id), r.table_id, r.row) for r in rows.collect())
    assert sorted(tuple(r) for r in K.read_extract_bundle(spark, str(tmp_path / "b"), "error.log", [7, 70, 700]).collect()) == [("7", message), ("70", message)]


def test_repeated_schemas_meet_their_mappings_once(spark):
    schemas = spark.range(500).select(F.lit("app").alias("app_id"), F.lit("s").alias("schema_id"), (F.col("id") % 2).alias("revision"))
    mapped = spark.range(50).select(F.lit("app").alias("app_id"), F.lit("s").alias("schema_id"), (F.col("id") % 3).alias("revision"), F.concat(F.lit("t"), F.col("id") % 6).alias("table_id"))
    out = J.canonical_schemas(schemas, mapped)
    assert {r.table_id: r.revision for r in out.collect()} == {"t0": 0, "t1": 1, "t3": 0, "t4": 1}
    assert "LeftSemi" in plan(out)


def test_a_schema_of_unknown_size_shuffles_no_cells(spark, tmp_path):
    payloads = spark.createDataFrame([("h", "d", "e", '{"t":[{"a":1},{"a":2}],"u":{"b":"x"}}')], "health_code string, created_date string, endpoint_id string, payload string")
    schema = spark.createDataFrame([("e", "t", "a", "INTEGER", None), ("e", "u", "b", "STRING", 5)], "endpoint_id string, table_key string, column_id string, kind string, max_length int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = L.tabulate_json(payloads, schema)
        assert sorted((r.table_id, r.row_no, r.value) for r in out.collect() if r.column_id != "rawData") == [("e.t", 0, "1"), ("e.t", 1, "2"), ("e.u", 0, "x")]
        assert "SortMergeJoin" not in plan(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_small_archives_are_unpacked_where_they_are_read(spark, tmp_path):
    for i in range(3):
        with zipfile.ZipFile(tmp_path / f"{i}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            for k in range(4):
                z.writestr(f"e{k}", bytes([k]) * 2_000_000)
    data = bytearray((tmp_path / "2.zip").read_bytes())
    data[40] ^= 255
    (tmp_path / "2.zip").write_bytes(bytes(data))
    got = lambda df: sorted((r.path[-5:], r.entry or "", None if r.content is None else len(r.content), bool(r.error)) for r in df.collect())
    want = [(f"{i}.zip", f"e{k}", 2_000_000, False) for i in range(2) for k in range(4)] + [("2.zip", "", None, True)]
    small, dealt = R.expand_archives(spark, str(tmp_path)), R.expand_archives(spark, str(tmp_path), small=0)
    assert got(small) == got(dealt) == want
    assert "Exchange" not in plan(small)
