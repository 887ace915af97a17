"""Publications, merges by key range, and CSV sets written at once."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from cohortry.operators import aggregates as A
from cohortry.operators.flatten import COMMON_COLUMNS
from cohortry.sources import merged as M
from cohortry.sources import sinks as K
from cohortry.sources.published import names, publish, published


def rows(spark, path, schema="id long"):
    return sorted(tuple(r) for r in published(spark, path, schema).collect())


def test_failing_count_leaves_the_table_as_it_was(spark, tmp_path):
    path = str(tmp_path / "t")
    assert K.append_checked(spark.range(5), path, "first", expected=5) == 5
    before = sorted(p.name for p in (tmp_path / "t").rglob("*.parquet"))
    with pytest.raises(ValueError, match="6 and 7 rows expected, 7 written|7 written"):
        K.append_checked(spark.range(7), path, "second", expected=6)
    assert rows(spark, path) == [(i,) for i in range(5)] and sorted(p.name for p in (tmp_path / "t").rglob("*.parquet")) == before
    assert K.append_checked(spark.range(5, 12), path, "second", expected=7) == 7 and len(rows(spark, path)) == 12


def test_rows_show_all_at_once_and_a_name_counts_once(spark, tmp_path, monkeypatch):
    from cohortry.sources import published as P

    path = str(tmp_path / "t")
    assert published(spark, path, "id long").count() == 0
    monkeypatch.setattr(P, "move", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        publish(spark.range(3), path, "a")
    monkeypatch.undo()
    assert list((tmp_path / "t").rglob("*.parquet")) and published(spark, path, "id long").count() == 0  # staged rows are none of the table
    assert publish(spark.range(3), path, "a") == 3 and publish(spark.range(100), path, "a") is None
    assert rows(spark, path) == [(0,), (1,), (2,)] and names(spark, path) == ["a"]
    assert publish(spark.range(0), path, "empty") == 0 and len(rows(spark, path)) == 3
    with pytest.raises(ValueError):
        publish(spark.range(3), path, "a/b")


def latest(tables):
    best = {}
    for part in tables:
        for k, seq, v in part:
            if k not in best or seq >= best[k][0]:
                best[k] = (seq, v)
    return {k: v for k, (_, v) in best.items()}


def test_merge_rewrites_touched_files_only(spark, tmp_path):
    path, schema, rng = str(tmp_path / "m"), "k string, seq long, v string", random.Random(4)
    key = lambda: f"k{rng.randrange(3000):05d}"
    tables = [list({k: (k, rng.randrange(50), f"{t}-{k}") for k in [key() for _ in range(900)]}.values()) for t in range(3)]
    tables[1] += [(None, 7, "none"), (None, 3, "older none")]
    frame = lambda part: spark.createDataFrame(part, schema)
    for part in tables:
        M.merge_latest(frame(part), path, ["k"], "seq", rows_per_file=100)
    assert {r.k: r.v for r in M.merged(spark, path).collect()} == latest(tables)
    before = {f.file: (f.low, f.high, f.n) for f in M._files(spark, path, 3)}
    assert len(before) > 5 and max(n for *_, n in before.values()) < 400
    narrow = [("k01000", 99, "new"), ("k01001x", 1, "inserted"), ("k01002", -5, "too old")]
    assert M.merge_latest(frame(narrow), path, ["k"], "seq", rows_per_file=100) == 4
    after = {f.file: (f.low, f.high, f.n) for f in M._files(spark, path, 4)}
    kept = before.keys() & after.keys()
    assert len(kept) >= len(before) - 2 and all(before[f] == after[f] for f in kept)
    assert {r.k: r.v for r in M.merged(spark, path).collect()} == latest([*tables, narrow])
    assert {r.k: r.v for r in M.merged(spark, path, 3).collect()} == latest(tables)  # older versions stay
    edges = [("a", 1, "before all"), ("z", 1, "after all"), (None, 8, "newer none")]
    M.merge_latest(frame(edges), path, ["k"], "seq", rows_per_file=100)
    assert {r.k: r.v for r in M.merged(spark, path).collect()} == latest([*tables, narrow, edges])
    M.merge_latest(frame([]), path, ["k"], "seq")
    assert M.vacuum(spark, path) > 0 and M.versions(spark, path) == [6]
    assert {r.k: r.v for r in M.merged(spark, path).collect()} == latest([*tables, narrow, edges])


def test_of_two_merges_at_once_one_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    frame = lambda v: spark.createDataFrame([(1, 1, v)], "k long, seq long, v string")
    M.merge_latest(frame("a"), path, ["k"], "seq")
    move = M.move

    def late(*args):
        monkeypatch.setattr(M, "move", move)
        M.merge_latest(frame("b"), path, ["k"], "seq")
        move(*args)

    monkeypatch.setattr(M, "move", late)
    with pytest.raises(FileExistsError):
        M.merge_latest(frame("c"), path, ["k"], "seq")
    assert [r.v for r in M.merged(spark, path).collect()] == ["b"]


def result_rows(spark, maps, guid="g"):
    """Rows with the common columns, and (metadata, data) of ``maps``."""
    data = [(i, guid if isinstance(guid, str) else guid(i), m, d) for i, (m, d) in enumerate(maps)]
    df = spark.createDataFrame(data, "i long, guid string, metadata map<string,string>, data map<string,string>")
    common = [F.col("guid").alias(c) if c == "assessmentGuid" else F.concat(F.lit(f'{c[:2]},"\n'), F.col("i").cast("string")).alias(c) if c == "clientInfo" else F.col("i").cast("string").alias(c) for c in COMMON_COLUMNS]
    return df.select(*common, "metadata", "data")


def read_sets(folder):
    """Rows of a CSV set by recordId, and its header; every file must have the same one."""
    out, headers = {}, set()
    for f in folder.rglob("part-*"):
        with f.open(newline="") as h:
            lines = list(csv.reader(h))
        headers.add(tuple(lines[0]))
        for line in lines[1:]:
            assert len(line) == len(lines[0])
            out[line[0]] = dict(zip(lines[0][11:], line[11:], strict=True)) | {"client": line[5]}
    (header,) = headers
    return header, out


def test_narrow_and_wide_sets_are_equal(spark, tmp_path):
    rng = random.Random(2)
    maps = [({f"m{rng.randrange(30):02d}": f"x {i}" for _ in range(rng.randrange(6))} or None, {f"d,{rng.randrange(40):02d}": rng.choice(['q"uote', "", "a,b", "line\nline", "plain"]) for _ in range(rng.randrange(8))}) for i in range(300)]
    guids = lambda i: ("one", "two", "other")[i % 3]
    sets = {}
    for most in (10_000, 1):
        folder = tmp_path / f"csv{most}"
        K.write_assessment_csv(result_rows(spark, maps, guids), {"one": "name-one", "two": "name-two", "nothing": "name-nothing"}, str(folder), rows_per_file=40, most_keys=most)
        sets[most] = {name: read_sets(folder / f"file_name={name}") for name in ("name-one", "name-two", "name-nothing")}
    assert sets[1] == sets[10_000]
    for k, name in enumerate(("name-one", "name-two")):
        header, got = sets[1][name]
        own = {i: m for i, m in enumerate(maps) if i % 3 == k}
        meta, data = (sorted({key for m in own.values() for key in (m[j] or {})}) for j in (0, 1))
        assert list(header) == [*COMMON_COLUMNS, *meta, *data] and len(got) == len(own)
        for i, (m, d) in own.items():
            assert got[str(i)] == {key: {**(m or {}), **d}.get(key, "") for key in meta + data} | {"client": f'cl,"\n{i}'}
    assert sets[1]["name-nothing"] == (COMMON_COLUMNS, {}) and len(list((tmp_path / "csv1/file_name=name-one").rglob("part-*"))) > 1


def test_all_assessments_are_written_by_one_scan(spark, tmp_path):
    result_rows(spark, [({"a": "b"}, {"c": "d"})] * 20, lambda i: f"g{i % 5}").write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("csv", "csv")
    K.write_assessment_csv(df, {f"g{i}": f"n{i}" for i in range(5)}, str(tmp_path / "csv"))
    many = len(tracker.getJobIdsForGroup("csv"))
    spark.sparkContext.setJobGroup("csv1", "csv1")
    K.write_assessment_csv(df, {"g0": "n0"}, str(tmp_path / "csv1"))
    assert many <= len(tracker.getJobIdsForGroup("csv1")) + 3  # jobs don't grow with the assessments
    spark.sparkContext.setJobGroup("", "")


def test_a_million_keys_in_one_assessment(spark, tmp_path):
    n, each = 10, 100_000
    data = spark.range(n).select(F.col("id").alias("i"), F.map_from_entries(F.transform(F.sequence(F.col("id") * each, F.col("id") * each + each - 1), lambda k: F.struct(F.concat(F.lit("key"), k.cast("string")), k.cast("string")))).alias("data"))
    common = [F.lit("g").alias(c) if c == "assessmentGuid" else F.col("i").cast("string").alias(c) for c in COMMON_COLUMNS]
    rows_ = data.select(*common, F.lit(None).cast("map<string,string>").alias("metadata"), "data")
    keys = A.column_keys(rows_.withColumn("assessment_guid", F.col("assessmentGuid")))
    assert keys.agg(F.count(F.lit(1)), F.max("position"), F.count_distinct("position")).first()[:] == (n * each,) * 3
    K.write_assessment_csv(rows_, {"g": "big"}, str(tmp_path / "big"))
    header, got = read_sets(tmp_path / "big/file_name=big")
    assert len(header) == 11 + n * each and len(got) == n
    for i, cells in got.items():
        filled = {k: v for k, v in cells.items() if v and k != "client"}
        assert len(filled) in (each, each - 0) and all(k == f"key{v}" and int(v) // each == int(i) for k, v in filled.items())


def test_compaction(spark, tmp_path, monkeypatch):
    from cohortry.sources import published as P

    path, schema = str(tmp_path / "t"), "id long, kind string"
    frame = lambda a, b: spark.range(a, b).withColumn("kind", F.concat(F.lit("k"), (F.col("id") % 2).cast("string")))
    for k in range(4):
        assert publish(frame(10 * k, 10 * k + 10), path, f"q-{k}", by=("kind",)) == 10
    want = [(i, f"k{i % 2}") for i in range(40)]
    monkeypatch.setattr(P, "move", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        P.compact(spark, path, schema, ("kind",))
    monkeypatch.undo()
    assert rows(spark, path, schema) == want and publish(frame(0, 10), path, "q-0", by=("kind",)) is None
    assert P.compact(spark, path, schema, ("kind",), keep=1) == 3
    assert rows(spark, path, schema) == want and len(names(spark, path)) == 5  # replaced folders are there, and not read
    assert P.vacuum(spark, path) == 3 and rows(spark, path, schema) == want and len(names(spark, path)) == 2
    assert all(publish(frame(0, 10), path, f"q-{k}", by=("kind",)) is None for k in range(4))  # for ever
    publish(frame(40, 50), path, "q-4", by=("kind",))
    assert P.compact(spark, path, schema, ("kind",)) == 3 and P.vacuum(spark, path) == 3
    assert rows(spark, path, schema) == want + [(i, f"k{i % 2}") for i in range(40, 50)]
    assert all(publish(frame(0, 10), path, f"q-{k}", by=("kind",)) is None for k in range(5)) and P.compact(spark, path, schema) == 0
    assert sorted(r.id for r in published(spark, path, schema, F.col("kind") == "k1").collect()) == list(range(1, 50, 2))
