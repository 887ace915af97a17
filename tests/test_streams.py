"""Streams that are killed and started again, and keyed state against sequential models."""

import random

import pytest
from pyspark.sql import functions as F

from cohortry.sources import published as P
from cohortry.sources import readers as R
from cohortry.streaming import streams as X

DAY = 86_400_000
MESSAGES = ['{"service":"one","body":"a"}', '{"service":"two","body":"b"}', '{"service":"one","body":"c"}', "broken", '{"service":"three"}']


def run(query):
    query.awaitTermination()
    return query


def dies(query):
    with pytest.raises(Exception, match="killed"):
        query.awaitTermination()


def test_kill_between_two_services_writes(spark, tmp_path, monkeypatch):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    start = lambda: X.route_requests_stream(R.read_object_events(spark, folder), ["one", "two"], out, state)
    spark.createDataFrame([(m,) for m in MESSAGES], "value string").write.text(folder)
    # one: rows of all services are staged, none is published
    monkeypatch.setattr(P, "move", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    dies(start())
    assert X.routed_requests(spark, out).count() == 0
    monkeypatch.undo()
    # two: published, but the batch isn't noted as done
    monkeypatch.setattr(X, "publish", lambda *a, **b: (P.publish(*a, **b), (_ for _ in ()).throw(RuntimeError("killed"))))
    dies(start())
    monkeypatch.undo()
    assert X.routed_requests(spark, out).count() == 5
    run(start())
    spark.createDataFrame([(MESSAGES[1],)], "value string").write.mode("append").text(folder)
    run(start())
    run(start())
    assert sorted((r.target, r.body) for r in X.routed_requests(spark, out).select("target", F.coalesce("body", F.lit("")).alias("body")).collect()) == [("errors", ""), ("errors", ""), ("one", "a"), ("one", "c"), ("two", "b"), ("two", "b")]
    assert [r.body for r in X.routed_requests(spark, out, "one").orderBy("body").collect()] == ["a", "c"]


def attempts(results, limit, delay):
    failed, out = {}, []
    for request, status, at in sorted(results, key=lambda r: r[2]):
        n = failed.get(request, 0) + 1
        outcome = "ok" if 200 <= status < 300 else "dropped" if status == 400 or 404 <= status < 500 else "retry" if n < limit else "dead"
        failed[request] = n if outcome == "retry" else 0
        out.append((request, status, at, outcome, n, at + delay * 2 ** (n - 1) if outcome == "retry" else None))
    return sorted(out, key=str)


def test_attempts(spark, tmp_path, monkeypatch):
    rng = random.Random(9)
    results = [(f"r{rng.randrange(12)}", rng.choice([200, 204, 400, 401, 403, 404, 500, 500, 502, 503]), t) for t in range(400)]
    df = spark.createDataFrame(results, "request_id string, http_status int, time_ms long")
    columns = ["request_id", "http_status", "time_ms", "outcome", "attempt", "next_try_ms"]
    got = lambda d: sorted(map(tuple, d.select(*columns).collect()), key=str)
    want = attempts(results, 3, 10)
    assert got(X.count_attempts(df, 3, 10)) == want
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    start = lambda: X.route_failures(spark.readStream.schema(df.schema).parquet(folder), out, state, limit=3, delay_ms=10)
    for k in range(3):
        df.filter((F.col("time_ms") >= 134 * k) & (F.col("time_ms") < 134 * (k + 1))).write.mode("append").parquet(folder)
        if k == 1:  # the batch is published, then runs again
            monkeypatch.setattr(X, "publish", lambda *a, **b: (P.publish(*a, **b), (_ for _ in ()).throw(RuntimeError("killed"))))
            dies(start())
            monkeypatch.undo()
        run(start())
    assert got(X.routed_failures(spark, out)) == want
    assert {r.outcome for r in X.routed_failures(spark, out, "dead").collect()} == {"dead"}


def test_every_key_once_beyond_the_watermark(spark, tmp_path, monkeypatch):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "k long, g string, v string, arrived timestamp"
    start = lambda buckets=4: X.dedupe_redelivery_ever(spark.readStream.schema(schema).parquet(folder), ["k", "g"], "arrived", "1 hour", out, state, buckets=buckets)

    def deliver(day, keys):
        spark.createDataFrame([(k, g, f"{day}", (day + 1) * DAY) for k, g in keys], "k long, g string, v string, ms long").select("k", "g", "v", F.timestamp_millis("ms").alias("arrived")).write.mode("append").parquet(folder)

    rng, first = random.Random(1), {}
    for day in range(4):
        keys = [(rng.randrange(3000), rng.choice("ab")) for _ in range(2000)] + [(None, "a"), (5, None)] * 2
        for k in keys:
            first.setdefault(k, str(day))
        deliver(day, keys)
        if day == 2:  # rows are published, the keys aren't
            calls = []
            monkeypatch.setattr(X, "publish", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("killed")) if calls else (calls.append(1), P.publish(*a, **b)))
            dies(start())
            monkeypatch.undo()
        run(start())
    got = [(r.k, r.g, r.v) for r in X.delivered_once(spark, out, schema).collect()]
    from collections import Counter
    assert Counter(v for *_, v in got) == Counter(first.values())
    assert {(k, g): v for k, g, v in got} == first


def test_files_of_keys_follow_the_folders(spark, tmp_path):
    """A batch writes a file a folder, not one for each task and bucket."""
    folder, out = str(tmp_path / "in"), tmp_path / "out"
    for a in (0, 1500):  # the second delivery brings half of the first again
        spark.range(a, a + 3000).select("id", F.timestamp_millis(F.lit((a + 1) * DAY)).alias("arrived")).repartition(4).write.mode("append").parquet(folder)
        run(X.dedupe_redelivery_ever(spark.readStream.schema("id long, arrived timestamp").parquet(folder), ["id"], "arrived", "1 hour", str(out), str(tmp_path / "state")))
        assert len(list((out / "keys").rglob("part-*.parquet"))) <= (a // 1500 + 1) * 2 * X.FOLDERS
    assert sorted(r.id for r in X.delivered_once(spark, str(out), "id long, arrived timestamp").collect()) == list(range(4500))


def test_the_filter_spares_lookups(spark, tmp_path):
    """New keys are told from old ones by the Bloom filter alone, but for a few."""
    bucket, bits = X._bloom_bits("_hash", 8, 4)
    keyed = lambda a, b: spark.range(a, b).withColumn("_hash", F.xxhash64("id")).withColumn("_bucket", bucket).withColumn("_bits", bits)
    bitmaps = {r._bucket: bytes(r.bitmap) for r in keyed(0, 8000).select("_bucket", F.explode("_bits").alias("bit")).groupBy("_bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap")).collect()}
    held = lambda r: all(bitmaps[r._bucket][p // 8] >> (p % 8) & 1 for p in r._bits)
    assert all(map(held, keyed(0, 8000).collect()))
    assert sum(map(held, keyed(100_000, 108_000).collect())) < 80


def passed(events, days):
    """Candidates that go out, one after the other."""
    last, out = {}, []
    for user, at, seq, decision, kind in sorted(events, key=lambda e: (e[1], e[3] is not None, e[2])):
        if decision is not None:
            if user in last and last[user] != "PRE_BURST" and at_of[user] > at - days * DAY:
                continue
            out.append((user, at, decision))
        last[user], at_of[user] = (decision or kind), at
    return sorted(out)


at_of: dict = {}


def test_cooldown_state(spark, tmp_path):
    rng, seq, events = random.Random(6), 0, []
    for day in range(12):
        for user in range(40):
            for _ in range(rng.choice([0, 0, 1, 2])):
                seq += 1
                at = day * DAY + rng.randrange(DAY)
                events.append((user, at, seq, rng.choice(["EARLY", "LATE", "PRE_BURST"]), None) if rng.random() < 0.6 else (user, at, seq, None, rng.choice(["EARLY", "PRE_BURST", "", None])))
    schema = "user_id long, time_ms long, seq long, decision string, type string"
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    sizes = []
    for day in [*range(12), 40, 41]:
        part = [e for e in events if day * DAY <= e[1] < (day + 1) * DAY] or [(1000, day * DAY, 10**6 + day, None, "EARLY")]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        q = X.reminder_cooldown_stream(spark.readStream.schema(schema).parquet(folder), 3).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
        run(q)
        sizes.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    at_of.clear()
    assert sorted((r.user_id, r.time_ms, r.decision) for r in spark.read.parquet(out).collect()) == passed(events, 3)
    assert max(sizes[:12]) >= 25 and sizes[-1] <= 4  # a user's entry goes with its days


def test_cooldown_stream_equals_the_batch_join(spark, tmp_path):
    from cohortry.operators.aggregates import latest_notification
    from cohortry.operators.filters import reminder_cooldown

    rng, now = random.Random(3), 30 * DAY
    log = [(rng.randrange(60), rng.randrange(now), k, None, rng.choice(["EARLY", "LATE", "PRE_BURST", ""])) for k in range(150)]
    schema = "user_id long, time_ms long, seq long, decision string, type string"
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for part in (log, [(u, now, 0, "EARLY", None) for u in range(70)]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(folder)
        run(X.reminder_cooldown_stream(spark.readStream.schema(schema).parquet(folder), 5).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start())
    want = reminder_cooldown(spark.range(70).withColumnRenamed("id", "user_id"), latest_notification(spark.createDataFrame(log, schema)), 5, now)
    assert sorted(r.user_id for r in spark.read.parquet(out).collect()) == sorted(r.user_id for r in want.collect())
