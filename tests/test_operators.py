import random

import pytest
from pyspark.sql import functions as F

from cohortry.operators import aggregates as A
from cohortry.operators import flatten as L
from cohortry.operators import joins as J
from cohortry.operators import windows as W

DAY = 86_400_000


def decide(finished, n_miss, n_consec, n_done, cutoff):
    missed = done = run = 0
    for i, f in enumerate(finished):
        if f:
            done, run = done + 1, 0
            if done >= n_done:
                return None
        else:
            missed, run = missed + 1, run + 1
            if missed >= n_miss:
                return "CUMULATIVE" if not finished[-1] else None
            if run >= n_consec:
                return ("EARLY" if i < cutoff else "LATE") if not finished[-1] else None
    return None


def test_burst_decision_against_a_sequential_model(spark):
    rng, config = random.Random(7), dict(n_miss=3, n_consec=2, n_done=6, cutoff=5)
    days = {u: [rng.random() < 0.7 for _ in range(rng.randint(1, 12))] for u in range(400)}
    rows = [(u, i, i, f) for u, d in days.items() for i, f in enumerate(d)]
    calendar = spark.createDataFrame(rows, "user_id long, day_idx int, day long, finished boolean")
    got = {r.user_id: r.decision for r in W.burst_decision(W.missed_day_runs(calendar), **config).collect()}
    want = {u: v for u, d in days.items() if (v := decide(d, **config))}
    assert got == want


def test_coming_burst_goes_first(spark):
    starts = spark.createDataFrame([(1, 10 * DAY, 1, 0), (1, 5 * DAY, 2, 0), (2, 5 * DAY, 3, 0)], "user_id long, ts_ms long, seq long, offset_minutes int")
    none = spark.createDataFrame([], "user_id long, day long, status string")
    got = W.burst_decisions(starts, none, 9, 9, 0, 0, n_miss=3, n_consec=2, n_done=6, cutoff=5)
    assert sorted(map(tuple, got.collect())) == [(1, "PRE_BURST"), (2, "EARLY")]


def test_retention(spark):
    users = spark.createDataFrame([(i, []) for i in range(5)] + [(9, ["developer"])], "user_id long, roles array<string>")
    start = {0: 5, 1: 4, 2: 4, 3: 5, 9: 5}
    events = spark.createDataFrame([("a", u, "study_start_date", d * DAY) for u, d in start.items()], "app_id string, user_id long, event_id string, ts_ms long")
    seen = {0: (9, 8), 1: (9, 8), 2: (9, 8), 3: (1, 8), 9: (9, 8)}
    info = spark.createDataFrame([("a", u, s * DAY, p * DAY) for u, (s, p) in seen.items()], "app_id string, user_id long, signed_in_ms long, uploaded_ms long")
    h = A.retention_histogram(users, events, info)
    assert {(r.metric, r.day): r.n for r in h.collect()} == {("by_sign_in", 4): 1, ("by_sign_in", 5): 2, ("by_uploaded_on", 3): 1, ("by_uploaded_on", 4): 2}
    curve = {(r.metric, r.day): r.n for r in W.retention_curve(h).collect()}
    assert curve["by_sign_in", 0] == 3 and curve["by_sign_in", 5] == 2 and len(curve) == 11


def test_days_toward_zero(spark):
    df = spark.createDataFrame([(0, -19 * 3_600_000), (0, -25 * 3_600_000), (0, 3 * DAY - 1)], "a long, b long")
    assert [r[0] for r in df.select(A.whole_days("a", "b")).collect()] == [0, -1, 2]


def test_signups_are_zero_filled_and_without_staff(spark):
    people = spark.createDataFrame([("a", "enabled", "no_sharing", [], 1)] * 2 + [("a", "unverified", "no_sharing", [], 1), ("a", "enabled", "no_sharing", ["developer"], 1)], "app_id string, status string, sharing_scope string, roles array<string>, created_ms long")
    members = spark.createDataFrame([("by_status", "enabled"), ("by_status", "disabled"), ("by_status", "unverified"), ("by_sharing", "no_sharing"), ("by_sharing", "all")], "metric string, key string")
    got = {r.key: r.n for r in A.signups_report(people, 0, 2, members).collect()}
    assert got == {"enabled": 2, "disabled": 0, "unverified": 1, "no_sharing": 2, "all": 0}


def test_replace_file_handles(spark):
    rows = spark.createDataFrame([(1, "", ""), (2, "2a", ""), (4, "se", "ue"), (5, "gone", None)], "record_id long, bar string, baz string")
    summaries = spark.createDataFrame([("2a", "old", None, 1), ("2a", "zip-2a", None, 2), ("se", None, "service error", 3), ("ue", None, None, 4), (None, "x", None, 5)], "file_handle_id string, zip_entry string, failure string, seq long")
    got = {r.record_id: (r.bar, r.baz) for r in J.replace_file_handles(rows, summaries, ["bar", "baz"]).collect()}
    assert got == {1: ("", ""), 2: ("zip-2a", ""), 4: ("service error", J.UNKNOWN_ERROR), 5: (J.UNKNOWN_ERROR, None)}


def test_demographics(spark):
    v = "array<struct<value:string,invalidity:string>>"
    demo = f"array<struct<study_id:string,category:string,units:string,values:{v}>>"
    rows = [("h", 1, [(None, "c1", "u", [("foo", None)]), ("s", "c2", None, [("1", None), ("-5.7", None)]), ("s", None, None, [("x", None)]), ("s", "c3", None, None), ("s", "c4", None, [("abc", "invalid"), ("def", None)]), ("s", "c5", None, [])]), (None, 1, [("s", "c", None, [("x", None)])])]
    got = L.demographics_rows(spark.createDataFrame(rows, f"health_code string, participant_version int, demographics {demo}"))
    assert [(r.category, r.value, r.invalidity) for r in got.collect()] == [("c1", "foo", None), ("c2", "1", None), ("c2", "-5.7", None), ("c4", "abc", "invalid"), ("c4", "def", None), ("c5", None, None)]
    one = L.demographics_rows(spark.createDataFrame(rows, f"health_code string, participant_version int, demographics {demo}"), study="s", app_level=False)
    assert "c1" not in [r.category for r in one.collect()]


def test_mask_needs_the_column(spark):
    df = spark.createDataFrame([("x",)], "health_code string")
    assert L.mask_identifier(df, "health_code").first()[0] is None
    with pytest.raises(ValueError):
        L.mask_identifier(df, "other")


def test_roster_and_answers(spark):
    df = spark.createDataFrame([(True, ["a"], {"k": "v"}, None)], "a boolean, b array<string>, c map<string,string>, d string")
    assert tuple(L.flatten_roster(df).first()) == ("true", "", '{"k":"v"}', "")
    text = '{"type":"assessment","stepHistory":[{"type":"answer","identifier":"choiceQ1","value":1},{"type":"answer","identifier":"simpleQ1","value":"test text"}]}'
    assert spark.range(1).select(L.flatten_answers(F.lit(text))).first()[0] == {"choiceQ1": "1", "simpleQ1": "test text"}


def test_latest_notification(spark):
    log = spark.createDataFrame([(1, 5, "EARLY", 1), (1, 9, " ", 2), (2, 3, "LATE", 3)], "user_id long, time_ms long, type string, seq long")
    assert sorted(map(tuple, A.latest_notification(log).collect())) == [(1, 9, "UNKNOWN"), (2, 3, "LATE")]
