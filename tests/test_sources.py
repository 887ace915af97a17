import json
import zipfile

import pytest
from pyspark.sql import functions as F

from cohortry.sources import readers as R
from cohortry.sources import sinks as K
from cohortry.streaming import streams as X


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "good.zip", "w") as z:
        for i in range(3):
            z.writestr(f"e{i}", f"content {i}")
    with zipfile.ZipFile(tmp_path / "many.zip", "w") as z:
        for i in range(6):
            z.writestr(f"e{i}", "")
    with zipfile.ZipFile(tmp_path / "large.zip", "w") as z:
        z.writestr("e", "x" * 100)
    (tmp_path / "broken.zip").write_bytes(b"no zip")
    got = {}
    for r in R.expand_archives(spark, str(tmp_path), max_entries=5, max_size=50).collect():
        got.setdefault(r.path.rsplit("/", 1)[1], []).append((r.entry, r.error))
    assert sorted(got["good.zip"]) == [("e0", None), ("e1", None), ("e2", None)]
    assert got["many.zip"] == [(None, "too many entries")] and got["large.zip"] == [(None, "entry too large")] and got["broken.zip"][0][0] is None


def test_odd_archives(spark, tmp_path):
    big = bytes(range(256)) * 400
    with zipfile.ZipFile(tmp_path / "mixed.zip", "w") as z:
        z.writestr("stored", big, zipfile.ZIP_STORED)
        z.writestr("deflated", big, zipfile.ZIP_DEFLATED)
        z.writestr("ü/none", b"", zipfile.ZIP_DEFLATED)
        z.mkdir("folder")
    good = (tmp_path / "mixed.zip").read_bytes()
    (tmp_path / "empty.zip").write_bytes(b"PK\x05\x06" + bytes(18))
    (tmp_path / "cut.zip").write_bytes(good[:5000])
    at = good.index(b"deflated") + 60
    (tmp_path / "changed.zip").write_bytes(good[:at] + bytes([good[at] ^ 255]) + good[at + 1 :])
    with zipfile.ZipFile(tmp_path / "bomb.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("fine", b"fine")
        z.writestr("lies", bytes(5_000_000))
    bomb = (tmp_path / "bomb.zip").read_bytes()
    (tmp_path / "bomb.zip").write_bytes(bomb.replace((5_000_000).to_bytes(4, "little"), (10).to_bytes(4, "little")))
    with zipfile.ZipFile(tmp_path / "packed.zip", "w", zipfile.ZIP_LZMA) as z:
        z.writestr("x", b"y")
    with pytest.warns(UserWarning), zipfile.ZipFile(tmp_path / "twice.zip", "w") as z:
        z.writestr("a", b"1")
        z.writestr("a", b"2")
    got = {}
    for r in R.expand_archives(spark, str(tmp_path), max_size=200_000, tasks=3).collect():
        got.setdefault(r.path.rsplit("/", 1)[1], []).append((r.entry, r.content if r.content is None else bytes(r.content), r.error))
    assert sorted(got.pop("mixed.zip")) == [("deflated", big, None), ("stored", big, None), ("ü/none", b"", None)]
    assert "empty.zip" not in got and got["bomb.zip"] == [(None, None, "entry too large")] and got["twice.zip"] == [(None, None, "repeated entry")]
    assert got.keys() == {"cut.zip", "changed.zip", "bomb.zip", "packed.zip", "twice.zip"}
    assert all(len(rows) == 1 and rows[0][:2] == (None, None) and rows[0][2] for rows in got.values())


def test_archives_of_the_query_follow_the_rows_and_show_errors(spark, tmp_path):
    from cohortry.plans.export_queries import expand_archives

    keys = [*range(1, 2601), 2555]  # the archive of 2550 to 2599 holds a name twice
    spark.createDataFrame([(k, f"ü {k}") for k in keys], "p_partkey long, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    got = {r.archive: r.entries for r in expand_archives(spark, str(tmp_path)).collect()}
    want = {i: sum(k % 20 == i for k in keys if not 2550 <= k < 2600) for i in range(20)}
    assert got == want | {None: 1}


def test_schema_problems(spark, tmp_path):
    column = lambda i, kind, n: {"columnId": i, "columnType": kind, "maxLength": n}
    doc = {"endpoints": [{"endpointId": "e", "scopeName": "s", "url": "u", "tables": [{"tableKey": "t", "columns": [column("a", "STRING", 10), column("b", "STRING", None), column("c", "INTEGER", None), column(None, "INTEGER", None)]}]}]}
    (tmp_path / "s.json").write_text(json.dumps(doc))
    got = {r.column_id: r.problem for r in R.load_endpoint_schemas(spark, str(tmp_path)).collect()}
    assert got["a"] is None and got["c"] is None and got["b"] and got[None]


def test_append_checked_and_tsv(spark, tmp_path):
    df = spark.range(5)
    assert K.append_checked(df, str(tmp_path / "t")) == 5 and K.append_checked(df, str(tmp_path / "t")) == 5
    K.write_tsv(spark.createDataFrame([("x", None, "h")], "col string, none string, healthCode string").coalesce(1), str(tmp_path / "tsv"))
    text = next((tmp_path / "tsv").glob("part-*")).read_text()
    assert text == "healthCode\tcol\tnone\nh\tx\t\n"


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 5)], "k long, v string, seq long")
    new = spark.createDataFrame([(1, "c", 1), (2, "d", 4), (3, "e", 0)], "k long, v string, seq long")
    assert {r.k: r.v for r in K.upsert_latest(old, new, ["k"], "seq").collect()} == {1: "c", 2: "b", 3: "e"}


@pytest.mark.parametrize(("status", "want"), [(200, "ok"), (400, "dropped"), (401, "retry"), (403, "retry"), (404, "dropped"), (412, "dropped"), (500, "retry")])
def test_failures(spark, status, want):
    assert X.classify_failures(spark.range(1).select(F.lit(status).alias("http_status"))).first().outcome == want


def test_completions(spark):
    event = {"eventSource": "aws:s3", "eventName": "ObjectCreated:Put", "eventTime": "t", "s3": {"bucket": {"name": "b"}, "object": {"key": "k", "size": 1}}}
    texts = [json.dumps({"Records": [event, event | {"eventName": "ObjectRemoved:Delete"}, event | {"eventSource": "aws:sns"}]}), "not json", "null", "{}", '{"Records":[]}']
    got = X.upload_completions(spark.createDataFrame([(t,) for t in texts], "value string"), "b").collect()
    assert [tuple(r) for r in got] == [("k", "t")]
