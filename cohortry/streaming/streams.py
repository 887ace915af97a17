"""Streams: each has one transformation that batch and stream share.

Sinks of ``foreachBatch`` name what they publish by query and batch, so that a batch that runs again after a failure changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from ..operators.flatten import route_requests
from ..sources.published import publish, published, transaction
from ..sources.readers import EVENTS
from .state import ROCKS, AttemptCounter, ReminderCooldown

ATTEMPTS = "request_id string, http_status int, time_ms long, outcome string, attempt int, next_try_ms long"


def upload_completions(messages: DataFrame, bucket: str) -> DataFrame:
    """(upload_id, event_time) of created objects in the bucket; what can't be read is dropped."""
    each = messages.select(F.explode(F.from_json("value", EVENTS).Records).alias("r"))
    wanted = (F.col("r.eventSource") == "aws:s3") & F.startswith("r.eventName", F.lit("ObjectCreated:")) & (F.col("r.s3.bucket.name") == bucket)
    return each.filter(wanted).select(F.col("r.s3.object.key").alias("upload_id"), F.col("r.eventTime").alias("event_time"))


def classify_failures(results: DataFrame) -> DataFrame:
    """``outcome``: ok, dropped (400 and 404 to 499) or retry."""
    code = F.col("http_status")
    return results.withColumn("outcome", F.when(code.between(200, 299), "ok").when((code == 400) | code.between(404, 499), "dropped").otherwise("retry"))


def count_attempts(results: DataFrame, limit: int, delay_ms: int) -> DataFrame:
    """Results (request_id, http_status, time_ms) with outcome, attempt and next_try_ms: a request's failures are counted until it ends, and the ``limit``-th one is ``dead``.

    The n-th failure is to be tried again after ``delay_ms`` times 2 to the n - 1. In a stream the count is keyed state, which goes when a request ends.
    A request's results count in the order of time, a stream's within each batch.
    """
    known = classify_failures(results.select(F.col("request_id").cast("string").alias("request_id"), F.col("http_status").cast("int").alias("http_status"), F.col("time_ms").cast("long").alias("time_ms")))
    if results.isStreaming:
        results.sparkSession.conf.set(*ROCKS)
        return known.groupBy("request_id").transformWithState(AttemptCounter(limit, delay_ms), ATTEMPTS, "Append", "None")
    own = Window.partitionBy("request_id")
    order = own.orderBy("time_ms", "http_status")
    ended = known.withColumn("_round", F.sum((F.col("outcome") != "retry").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    nth = F.row_number().over(Window.partitionBy("request_id", F.coalesce("_round", F.lit(0))).orderBy("time_ms", "http_status"))
    counted = ended.withColumn("_nth", nth)  # of a run of failures, of which every ``limit``-th ends the request
    out = counted.withColumn("attempt", ((F.col("_nth") - 1) % limit + 1).cast("int")).withColumn("outcome", F.when((F.col("outcome") == "retry") & (F.col("attempt") >= limit), "dead").otherwise(F.col("outcome")))
    wait = (F.lit(delay_ms) * F.pow(F.lit(2), F.col("attempt") - 1)).cast("long")
    return out.select("request_id", "http_status", "time_ms", "outcome", "attempt", F.when(F.col("outcome") == "retry", F.col("time_ms") + wait).alias("next_try_ms"))


def run_through(batch: DataFrame) -> None:
    """Compute all of a batch that is published already: its query's state must be written again before the batch counts as done."""
    batch.write.format("noop").mode("overwrite").save()


def route_failures(stream: DataFrame, path: str, checkpoint: str, limit: int = 5, delay_ms: int = 60_000) -> StreamingQuery:
    """Results of requests by outcome: ``path`` has folders for ok, dropped, retry (with attempt and time of the next try) and dead letters; read them by ``routed_failures``."""

    def send(batch: DataFrame, batch_id: int) -> None:
        if publish(batch, path, transaction(batch.sparkSession, checkpoint, batch_id), by=("outcome",)) is None:
            run_through(batch)

    return count_attempts(stream, limit, delay_ms).writeStream.foreachBatch(send).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def routed_failures(spark, path: str, outcome: str | None = None) -> DataFrame:
    return published(spark, path, ATTEMPTS, None if outcome is None else F.col("outcome") == outcome)


def dedupe_redelivery(stream: DataFrame, keys: list[str], time_column: str, watermark: str) -> DataFrame:
    """Redelivered rows once; a stream remembers keys for the watermark."""
    if stream.isStreaming:
        return stream.withWatermark(time_column, watermark).dropDuplicatesWithinWatermark(keys)
    return stream.dropDuplicates(keys)


def _bloom_bits(key_hash: str, buckets: int, hashes: int):
    """A key's bucket, and its bit positions in the bucket's bitmap of 32,768 bits."""
    bucket = F.pmod(F.col(key_hash), F.lit(buckets)).cast("int")
    return bucket, F.array(*(F.pmod(F.xxhash64(F.col(key_hash), F.lit(i)), F.lit(32_768)).cast("int") for i in range(hashes)))


FOLDERS = 32


def dedupe_redelivery_ever(stream: DataFrame, keys: list[str], arrival_column: str, watermark: str, path: str, checkpoint: str, buckets: int = 1024, hashes: int = 4) -> StreamingQuery:
    """Every key once, however late it comes again: published under ``path`` as ``rows``, read by ``delivered_once``.

    Two memories: the stream's state (on RocksDB) keeps the keys of the last ``watermark``; older ones are in the table ``keys``, in ``FOLDERS`` folders by key hash, each written
    by one task of a batch, with a Bloom filter of 32,768 bits for each of ``buckets`` beside it. A batch's keys that the filter doesn't know are new; only the others, few but for redelivered ones,
    are looked up, in the folders that they fall into. A filter that fills up (some 3,000 keys a bucket) lets more keys through to the lookup and changes no result.
    ``arrival_column`` is when a message came, not when it was sent: rows behind the watermark are lost to state.
    """
    stream.sparkSession.conf.set(*ROCKS)
    once = dedupe_redelivery(stream, keys, arrival_column, watermark)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields if f.name in keys)

    def send(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = transaction(spark, checkpoint, batch_id)
        before = F.col("publication") != name  # a batch that runs again doesn't count as seen by itself
        bucket, bits = _bloom_bits("_hash", buckets, hashes)
        rows = batch.withColumn("_hash", F.xxhash64(*keys)).withColumn("_bucket", bucket).withColumn("_folder", F.col("_bucket") % FOLDERS).withColumn("_bits", bits)
        bitmaps = published(spark, f"{path}/bloom", "_bucket int, _bitmap binary", before).groupBy("_bucket").agg(F.bitmap_or_agg("_bitmap").alias("_bitmap"))
        byte = lambda p: F.conv(F.hex(F.substring(F.col("_bitmap"), F.shiftright(p, 3) + 1, F.lit(1))), 16, 10).cast("int")
        held = F.forall("_bits", lambda p: F.floor(byte(p) / F.pow(F.lit(2), p % 8)) % 2 == 1)
        probed = rows.join(bitmaps, "_bucket", "left").withColumn("_maybe", F.coalesce(held, F.lit(False))).drop("_bitmap").persist()
        try:
            maybe = probed.filter("_maybe")
            folders = [r._folder for r in maybe.select("_folder").distinct().collect()]  # FOLDERS at most
            seen = published(spark, f"{path}/keys", f"{schema}, _folder int", before & F.col("_folder").isin(folders))
            condition = F.col("r._folder") == F.col("s._folder")
            for k in keys:
                condition = condition & F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}"))
            known = maybe.alias("r").join(seen.alias("s"), condition, "left_anti")
            new = probed.filter("not _maybe").unionByName(known.select(*probed.columns)).drop("_maybe").persist()
            try:
                if publish(new.select(*batch.columns), f"{path}/rows", name) is None:
                    run_through(probed)
                publish(new.select(*keys, "_folder").repartition("_folder"), f"{path}/keys", name, by=("_folder",))
                each = new.select("_bucket", F.explode("_bits").alias("_bit"))
                publish(each.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bitmap")), f"{path}/bloom", name)
            finally:
                new.unpersist()
        finally:
            probed.unpersist()

    return once.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def delivered_once(spark, path: str, schema: str) -> DataFrame:
    return published(spark, f"{path}/rows", schema)


def reminder_cooldown_stream(events: DataFrame, burst_days: int, delay: str = "0 seconds") -> DataFrame:
    """Candidates (user_id, time_ms, seq, decision, type) that may be sent: those with a decision, whose user's last notification isn't a reminder of the last ``burst_days``.

    ``events`` has candidates, and notifications, which have a type instead of a decision. A user's state is the last notification alone; a timer at the end
    of its days deletes it. A candidate that passes is sent, so it is the user's last notification from then on. Events of one user count by time,
    notifications before candidates; an event may come ``delay`` later than newer ones.
    """
    known = events.select("user_id", F.col("time_ms").cast("long").alias("time_ms"), F.col("seq").cast("long").alias("seq"), "decision", "type", F.timestamp_millis("time_ms").alias("at"))
    events.sparkSession.conf.set(*ROCKS)
    keyed = known.withWatermark("at", delay).groupBy("user_id")
    return keyed.transformWithState(ReminderCooldown(burst_days), f"user_id {dict(events.dtypes)['user_id']}, time_ms long, seq long, decision string", "Append", "EventTime")


def route_requests_stream(stream: DataFrame, services: list[str], path: str, checkpoint: str) -> StreamingQuery:
    """A batch's messages by target: a service, or ``errors``. One publication a batch has all targets, so no service sees a batch that another doesn't."""

    def fan_out(batch: DataFrame, batch_id: int) -> None:
        routed = route_requests(batch, services)
        publish(routed.withColumn("target", F.when(F.col("error").isNull(), F.col("service")).otherwise("errors")), path, transaction(batch.sparkSession, checkpoint, batch_id), by=("target",))

    return stream.writeStream.foreachBatch(fan_out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def routed_requests(spark, path: str, target: str | None = None) -> DataFrame:
    return published(spark, path, "value string, service string, body string, error string, target string", None if target is None else F.col("target") == target)
