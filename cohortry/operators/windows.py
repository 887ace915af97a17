"""Retention curves and study bursts: running sums and first decisions over days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DAY_MS = 86_400_000


def retention_curve(histogram: DataFrame) -> DataFrame:
    """(app_id, metric, day, n): users with this day or a later one, for all days up to the last."""
    last = histogram.groupBy("app_id", "metric").agg(F.max("day").alias("last"))
    spine = last.select("app_id", "metric", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("day"))
    later = Window.partitionBy("app_id", "metric").orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return spine.join(histogram, ["app_id", "metric", "day"], "left").select("app_id", "metric", "day", F.sum(F.coalesce("n", F.lit(0))).over(later).cast("long").alias("n"))


def local_day(ms: str, offset_minutes: str):
    """Number of the local day since 1970."""
    return F.floor((F.col(ms) + F.col(offset_minutes) * 60_000) / DAY_MS).cast("long")


def dedupe_activities_by_day(activities: DataFrame) -> DataFrame:
    """The first activity of each user and local day (by time, then seq), and how many the day had."""
    day = Window.partitionBy("user_id", "day")
    return activities.withColumn("day", local_day("scheduled_ms", "offset_minutes")).withColumn("of_day", F.count(F.lit(1)).over(day)).withColumn("k", F.row_number().over(day.orderBy("scheduled_ms", "seq"))).filter("k = 1").drop("k")


def burst_calendar(bursts: DataFrame, activities: DataFrame, day: int) -> DataFrame:
    """(user_id, day_idx, day, finished): a row for each day from the burst's start to ``day``."""
    days = bursts.filter(F.col("start_day") <= day).select("user_id", F.posexplode(F.sequence(F.col("start_day"), F.lit(day).cast("long"))).alias("day_idx", "day"))
    done = activities.select("user_id", "day", (F.col("status") == "finished").alias("finished"))
    return days.join(done, ["user_id", "day"], "left").select("user_id", "day_idx", "day", F.coalesce("finished", F.lit(False)).alias("finished"))


def missed_day_runs(calendar: DataFrame) -> DataFrame:
    """The calendar with days missed and finished so far, and the length of the run of missed days."""
    so_far = Window.partitionBy("user_id").orderBy("day_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.max(F.when(F.col("finished"), F.col("day_idx")).otherwise(-1)).over(so_far)
    return calendar.select(
        "*", F.sum((~F.col("finished")).cast("int")).over(so_far).cast("long").alias("n_missed"), F.sum(F.col("finished").cast("int")).over(so_far).cast("long").alias("n_finished"),
        F.when(F.col("finished"), 0).otherwise(F.col("day_idx") - last).cast("long").alias("run"),
    )


def burst_decision(runs: DataFrame, n_miss: int, n_consec: int, n_done: int, cutoff: int) -> DataFrame:
    """(user_id, decision): what the first decisive day says, unless the last day is finished.

    A missed day decides CUMULATIVE at ``n_miss`` missed ones, else EARLY (before ``cutoff``) or LATE at a run of ``n_consec``;
    a finished day ends it at ``n_done`` finished ones.
    """
    per_user = runs.withColumn("verdict", _verdict(n_miss, n_consec, n_done, cutoff)).groupBy("user_id").agg(F.min_by("verdict", F.when(F.col("verdict").isNotNull(), F.col("day_idx"))).alias("decision"), F.max_by("finished", "day_idx").alias("done_today"))
    return per_user.filter("decision is not null and decision <> 'DONE' and not done_today").select("user_id", "decision")


def current_burst(starts: DataFrame, day: int, length: int, head: int = 0, tail: int = 0) -> DataFrame:
    """(user_id, start_day) of the first burst that holds ``day``, outside its first ``head`` and last ``tail`` days."""
    inside = starts.withColumn("start_day", local_day("ts_ms", "offset_minutes")).filter(F.lit(day).between(F.col("start_day"), F.col("start_day") + length - 1))
    first = inside.groupBy("user_id").agg(F.min_by("start_day", F.struct("ts_ms", "seq")).alias("start_day"))
    return first.filter((F.lit(day) >= F.col("start_day") + head) & (F.lit(day) <= F.col("start_day") + length - 1 - tail))


def upcoming_burst(starts: DataFrame, day: int) -> DataFrame:
    """(user_id, decision) of users whose burst starts the day after."""
    return starts.filter(local_day("ts_ms", "offset_minutes") - 1 == day).select("user_id").distinct().withColumn("decision", F.lit("PRE_BURST"))


def burst_decisions(starts: DataFrame, activities: DataFrame, day: int, length: int, head: int, tail: int, n_miss: int, n_consec: int, n_done: int, cutoff: int) -> DataFrame:
    """(user_id, decision) of the day; a coming burst goes before a running one. Starts are read and grouped by user once for both."""
    begun = starts.withColumn("start_day", local_day("ts_ms", "offset_minutes"))
    holds = F.lit(day).between(F.col("start_day"), F.col("start_day") + length - 1)
    users = begun.groupBy("user_id").agg(F.bool_or(F.col("start_day") - 1 == day).alias("coming"), F.min_by("start_day", F.when(holds, F.struct("ts_ms", "seq"))).alias("start_day"))
    inside = (F.lit(day) >= F.col("start_day") + head) & (F.lit(day) <= F.col("start_day") + length - 1 - tail)
    decided = burst_decision(missed_day_runs(burst_calendar(users.filter(~F.col("coming") & inside).select("user_id", "start_day"), activities, day)), n_miss, n_consec, n_done, cutoff)
    return users.filter("coming").select("user_id", F.lit("PRE_BURST").alias("decision")).unionByName(decided)


def bursts_holding(starts: DataFrame, day: int, length: int) -> DataFrame:
    """(user_id, start_day) of all bursts that hold ``day``."""
    return starts.select("user_id", local_day("ts_ms", "offset_minutes").alias("start_day")).filter(F.lit(day).between(F.col("start_day"), F.col("start_day") + length - 1)).distinct()


def _verdict(n_miss: int, n_consec: int, n_done: int, cutoff: int):
    missed = ~F.col("finished")
    return F.when(missed & (F.col("n_missed") >= n_miss), "CUMULATIVE").when(missed & (F.col("run") >= n_consec), F.when(F.col("day_idx") < cutoff, "EARLY").otherwise("LATE")).when(F.col("finished") & (F.col("n_finished") >= n_done), "DONE")


BURST_STATE = "user_id long, start_day long, day_idx long, finished boolean, n_missed long, n_finished long, run long, verdict string"


def burst_state(starts: DataFrame, activities: DataFrame, day: int, length: int, n_miss: int, n_consec: int, n_done: int, cutoff: int) -> DataFrame:
    """The state of every burst that holds ``day``, from all its days: what ``advance_bursts`` makes day by day.

    (user_id, start_day, day_idx, finished, n_missed, n_finished, run, verdict): the last day's counts, and the verdict of the first day that has one.
    """
    bursts = bursts_holding(starts, day, length)
    days = bursts.select("user_id", "start_day", F.posexplode(F.sequence("start_day", F.lit(day).cast("long"))).alias("day_idx", "day"))
    done = activities.select("user_id", "day", (F.col("status") == "finished").alias("finished"))
    calendar = days.join(done, ["user_id", "day"], "left").withColumn("finished", F.coalesce("finished", F.lit(False)))
    own = Window.partitionBy("user_id", "start_day").orderBy("day_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.max(F.when(F.col("finished"), F.col("day_idx")).otherwise(-1)).over(own)
    runs = calendar.select("*", F.sum((~F.col("finished")).cast("long")).over(own).alias("n_missed"), F.sum(F.col("finished").cast("long")).over(own).alias("n_finished"), F.when(F.col("finished"), 0).otherwise(F.col("day_idx") - last).cast("long").alias("run"))
    judged = runs.withColumn("verdict", _verdict(n_miss, n_consec, n_done, cutoff))
    first = F.min_by("verdict", F.when(F.col("verdict").isNotNull(), F.col("day_idx"))).alias("verdict")
    newest = F.max_by(F.struct("day_idx", "finished", "n_missed", "n_finished", "run"), "day_idx").alias("s")
    return judged.groupBy("user_id", "start_day").agg(newest, first).select("user_id", "start_day", F.col("s.day_idx").cast("long").alias("day_idx"), "s.finished", "s.n_missed", "s.n_finished", "s.run", "verdict")


def advance_bursts(state: DataFrame, starts: DataFrame, activities: DataFrame, day: int, length: int, n_miss: int, n_consec: int, n_done: int, cutoff: int) -> DataFrame:
    """The state of ``day`` from that of the day before and the day's own activities: one row a running burst, however long it has run.

    Bursts that ended leave the state. A burst that should have been in yesterday's state and isn't (its start came late) raises no error: its missing days count
    as missed, as they do for a user without activities. Activities of days before ``day`` that come late don't count; ``burst_state`` counts them.
    """
    bursts = bursts_holding(starts, day, length)
    before = state.select("user_id", "start_day", *(F.col(c).alias(f"_{c}") for c in ("n_missed", "n_finished", "run", "verdict")))
    today = activities.filter(F.col("day") == day).select("user_id", (F.col("status") == "finished").alias("finished"))
    idx = (F.lit(day).cast("long") - F.col("start_day")).alias("day_idx")
    each = bursts.join(before, ["user_id", "start_day"], "left").join(today, "user_id", "left").select("*", idx).withColumn("finished", F.coalesce("finished", F.lit(False)))
    missed = (~F.col("finished")).cast("long")
    counted = each.withColumns({
        "n_missed": F.coalesce("_n_missed", "day_idx") + missed, "n_finished": F.coalesce("_n_finished", F.lit(0).cast("long")) + 1 - missed,
        "run": F.when(F.col("finished"), 0).otherwise(F.coalesce("_run", "day_idx") + 1).cast("long"),
    })
    verdict = F.coalesce("_verdict", _verdict(n_miss, n_consec, n_done, cutoff)).alias("verdict")
    return counted.select("user_id", "start_day", "day_idx", "finished", "n_missed", "n_finished", "run", verdict)


def state_decisions(state: DataFrame, starts: DataFrame, day: int, length: int, head: int = 0, tail: int = 0) -> DataFrame:
    """(user_id, decision) of ``day`` from its state: what ``burst_decision`` finds from all days."""
    decided = state.filter("verdict is not null and verdict <> 'DONE' and not finished")
    return decided.join(current_burst(starts, day, length, head, tail), ["user_id", "start_day"], "left_semi").select("user_id", F.col("verdict").alias("decision"))
