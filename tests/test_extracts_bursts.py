"""Extracts by bins of dates, bursts from day to day, and keys that are null."""

import datetime
import json
import random

from pyspark.sql import functions as F

from cohortry.operators import flatten as L
from cohortry.operators import joins as J
from cohortry.operators import windows as W
from cohortry.sources import readers as R

DAY = 86_400_000
day = lambda n: datetime.date(2020, 1, 1) + datetime.timedelta(days=n)
REQUESTS, ROWS = "request_id long, user_id long, start_date date, end_date date", "record_id long, health_code string, upload_date date, bin int, chunk string"


def extract(spark, requests, people, rows, **how):
    return J.user_data_extract(spark.createDataFrame(requests, REQUESTS), spark.createDataFrame(people, "user_id long, health_code string"), spark.createDataFrame(rows, ROWS).drop("bin", "chunk"), **how)


def brute(requests, people, rows):
    code = dict(people)
    return sorted((q, r) for q, u, a, b in requests for r, h, d, *_ in rows if u in code and code[u] is not None and code[u] == h and None not in (a, b, d) and a <= d <= b)


def test_extract_against_brute_force(spark):
    rng = random.Random(2)
    people = [(u, f"hc{u}") for u in range(12)] + [(50, None)]
    requests = [(i, rng.randrange(14), day(a := rng.randrange(400)), day(a + rng.choice([-3, 0, 1, 30, 200]))) for i in range(150)]
    requests += [(900, 3, None, day(4)), (901, 3, day(4), None), (902, 3, datetime.date(1, 1, 1), datetime.date(9999, 12, 31)), (902, 3, day(0), day(500)), (903, 50, day(0), day(400))]
    rows = [(i, f"hc{rng.randrange(14)}", day(rng.randrange(400)), 0, "") for i in range(800)] + [(5000, None, day(3), 0, ""), (5001, "hc3", None, 0, "")]
    want = brute(requests, people, rows)
    for how in ({}, {"bin_days": 7, "most": 2}, {"bin_days": 1}, {"bin_days": 5000, "most": 3}):
        assert sorted((r.request_id, r.record_id) for r in extract(spark, requests, people, rows, **how).collect()) == want
    assert extract(spark, requests, people, []).count() == 0 and extract(spark, [], people, rows).count() == 0


def test_ten_thousand_overlapping_requests_of_one_user(spark):
    rng = random.Random(3)
    requests = [(i, 1, day(a := rng.randrange(60)), day(a + rng.randrange(100))) for i in range(10_000)] + [(20_000, 2, day(0), day(300))]
    people, rows = [(1, "hot"), (2, "cold")], [(i, "hot", day(rng.randrange(200)), 0, "") for i in range(40)] + [(99, "cold", day(2), 0, "")]
    spread = J.spread_requests(spark.createDataFrame(requests, REQUESTS), spark.createDataFrame(people, "user_id long, health_code string"), spark.createDataFrame(rows, ROWS), 32, 500)
    assert spread.groupBy("health_code", "bin", "chunk").count().agg(F.max("count")).first()[0] < 700
    got = extract(spark, requests, people, rows)
    assert sorted((r.request_id, r.record_id) for r in got.collect()) == brute(requests, people, rows)


def test_tables_are_joined_at_once(spark):
    requests = spark.createDataFrame([(1, "a", 7, day(0), day(9)), (2, "b", 8, day(0), day(9))], "request_id long, app_id string, user_id long, start_date date, end_date date")
    people = spark.createDataFrame([(7, "x"), (8, "y")], "user_id long, health_code string")
    data = {n: spark.createDataFrame([(k, h, day(k)) for k in range(12) for h in "xy"], f"{n}_id long, health_code string, upload_date date") for n in ("one", "two", "three")}
    got = J.extract_tables(requests, people, data, {"survey": spark.createDataFrame([("a", 5), ("a", 6)], "app_id string, v long")})
    assert got.filter("kind = 'data'").groupBy("request_id", "table_id").count().collect().__len__() == 6 and got.filter("kind = 'survey'").count() == 2
    assert {json.loads(r.row)["two_id"] for r in got.filter("table_id = 'two' and request_id = 1").collect()} == set(range(10))
    joins = got._jdf.queryExecution().optimizedPlan().toString().count("Join Inner")
    assert joins == J.extract_tables(requests, people, {"one": data["one"]}, {"survey": spark.createDataFrame([("a", 5)], "app_id string, v long")})._jdf.queryExecution().optimizedPlan().toString().count("Join Inner")


CONFIG = dict(n_miss=3, n_consec=2, n_done=6, cutoff=5)


def test_bursts_from_day_to_day_equal_the_windows_over_thirty_days(spark, tmp_path):
    rng, length = random.Random(11), 9
    starts = [(u, rng.randrange(-5, 28) * DAY + rng.randrange(DAY), s, rng.choice([-420, -60, 60])) for s, u in enumerate(rng.randrange(25) for _ in range(60))]
    done = {(rng.randrange(25), rng.randrange(-6, 31)) for _ in range(380)}
    starts = spark.createDataFrame(starts, "user_id long, ts_ms long, seq long, offset_minutes int").persist()
    acts = spark.createDataFrame([(u, d, rng.choice(["finished", "finished", "assigned"])) for u, d in sorted(done)], "user_id long, day long, status string").persist()
    state, seen = spark.createDataFrame([], W.BURST_STATE), 0
    rows = lambda df: sorted(map(tuple, df.select("user_id", "start_day", "day_idx", "finished", "n_missed", "n_finished", "run", "verdict").collect()))
    by = lambda x: [tuple("" if v is None else v for v in r) for r in x]
    for d in range(-6, 31):
        W.advance_bursts(state, starts, acts, d, length, **CONFIG).write.parquet(str(tmp_path / f"{d}"))
        state = spark.read.schema(W.BURST_STATE).parquet(str(tmp_path / f"{d}"))
        if d % 3 == 0:
            assert by(rows(state)) == by(rows(W.burst_state(starts, acts, d, length, **CONFIG)))
            current = W.current_burst(starts, d, length, 1, 1)
            want = W.burst_decision(W.missed_day_runs(W.burst_calendar(current, acts, d)), **CONFIG)
            got = sorted(map(tuple, W.state_decisions(state, starts, d, length, 1, 1).collect()))
            assert got == sorted(map(tuple, want.collect()))
            seen += len(got)
    assert seen > 30 and state.count() < 25 * 3


def test_null_keys_pass_by_the_joins(spark):
    records = spark.createDataFrame([(1, "i1", {"a": "x"}), (2, None, {"a": "y"}), (3, "none", None)], "record_id long, instance_guid string, metadata map<string,string>")
    timeline = spark.createDataFrame([("i1", {"a": "t", "b": "u"}), (None, {"z": "never"})], "instance_guid string, metadata map<string,string>")
    assert {r.record_id: r.metadata for r in J.timeline_enrich(records, timeline).collect()} == {1: {"a": "t", "b": "u"}, 2: {"a": "y"}, 3: None}
    rows = spark.createDataFrame([(1, "app", 7, "s1"), (2, "app", 7, None), (3, "app", 7, "s9")], "record_id long, app_id string, user_id long, schedule_guid string")
    people = spark.createDataFrame([(7, ["A", "B"])], "user_id long, study_ids array<string>")
    using = spark.createDataFrame([("s1", "A"), ("s1", "A"), (None, "B")], "schedule_guid string, study_id string")
    studies = spark.createDataFrame([("A", True, True), ("B", True, True)], "study_id string, export_enabled boolean, configured boolean")
    apps = spark.createDataFrame([("other", True, True)], "app_id string, export_enabled boolean, configured boolean")
    assert sorted((r.record_id, r.study_id) for r in J.study_fanout(rows, people, using, studies, apps).collect()) == [(1, "A"), (2, "A"), (2, "B")]


def test_study_rows_need_the_apps_own_table(spark):
    fan = spark.createDataFrame([(1, "on", None), (1, "on", "S"), (2, "off", None), (2, "off", "S"), (3, "null", None), (3, "null", "S"), (4, "on", "S"), (5, "on", None), (5, "on", "T")], "record_id long, app_id string, study_id string")
    rows = spark.createDataFrame([(i, 7, {"m": str(i)}) for i in range(1, 6)], "record_id long, user_id long, metadata map<string,string>")
    studies = spark.createDataFrame([("S", True, True, True), ("T", True, True, None)], "study_id string, export_enabled boolean, configured boolean, upload_table boolean")
    apps = spark.createDataFrame([("on", True), ("off", False), ("null", None)], "app_id string, upload_table boolean")
    people = spark.createDataFrame([(7, {"S": "ext:S"})], "user_id long, external_ids map<string,string>")
    got = L.study_table_rows(rows, fan, studies, people, apps).collect()
    assert [(r.record_id, r.study_id, r.metadata) for r in got] == [(1, "S", {"m": "1", "externalId": "ext"})]


def test_roster_leaves_out_linked_accounts(spark):
    df = spark.createDataFrame([("u", "9", "o", "t", "x")], "userId string, otherSystemUserId string, orgMembership string, type string, email string")
    assert L.flatten_roster(df).columns == ["userId", "email"]


def test_ignored_keys(spark, tmp_path):
    point = lambda i, **more: {"endpointId": i, "scopeName": "s", "url": "u", "tables": []} | more
    (tmp_path / "a.json").write_text(json.dumps({"endpoints": [point("e", ignoredKeys=["x", "y", "x", None]), point("f"), point(None, ignoredKeys=["z"])]}))
    (tmp_path / "b.json").write_text("broken")
    assert sorted(map(tuple, R.load_ignored_keys(spark, str(tmp_path)).collect())) == [("e", "x"), ("e", "y")]
