"""A table with the latest row of each key, in files by key range. A merge rewrites the files whose range it touches and keeps all others.

A version of the table is a small Parquet table of its files, each with the lowest and highest first key and the number of rows. It is staged and then renamed to
the next number, so readers see a merge as a whole or not at all, and of two merges at once one fails. The driver sees a row for each file, as with any list of files.
"""

from __future__ import annotations

import math
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare
from .published import _path, delete, move, names
from .sinks import upsert_latest


def versions(spark: SparkSession, path: str) -> list[int]:
    return [int(n) for n in names(spark, f"{path}/_files", "version=")]


def _files(spark: SparkSession, path: str, version: int) -> list:
    """(file, low, high, n, blank) by key; ``blank`` counts null first keys."""
    rows = spark.read.parquet(f"{path}/_files/version={version:09d}").collect()
    return sorted(rows, key=lambda r: (r.low is not None, r.low if r.low is not None else 0, r.file))


def merged(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of a version, by default the last."""
    files = _files(spark, path, versions(spark, path)[-1] if version is None else version)
    return spark.read.parquet(*(f"{path}/data/{f.file}" for f in files))


def touched_files(incoming: DataFrame, files: list, key: str) -> list[int]:
    """Numbers of the files that hold a key of ``incoming``, or would: the last one that begins before it."""
    keyed = [i for i, f in enumerate(files) if f.low is not None]
    lows, highs = [files[i].low for i in keyed], [files[i].high for i in keyed]
    blank = [i for i, f in enumerate(files) if f.blank] or [0]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: set[int] = set()
        for frame in frames:
            for v in frame["key"].drop_duplicates():
                if v is None or v != v:
                    found.update(blank)
                    continue
                a, b = bisect_left(highs, v), bisect_right(lows, v)
                found.update(keyed[j] for j in (range(a, b) if a < b else [max(b - 1, 0)]))
        yield pd.DataFrame({"file": sorted(found)}, dtype="int64")

    if not keyed:
        return list(range(len(files)))
    numbers = incoming.select(F.col(key).alias("key")).mapInPandas(run, "file long").distinct().collect()  # at most one a file
    return sorted(r["file"] for r in numbers)


def merge_latest(incoming: DataFrame, path: str, keys: list[str], order: str, rows_per_file: int = 1_000_000) -> int:
    """Of each key (the columns ``keys``) the row of highest ``order``, of equal ones the incoming; the number of the new version.

    Range and statistics are those of the first key; nulls are a key like others. A version's files that no incoming key falls into stay as they are. Replaced files stay for
    readers of older versions until ``vacuum``.
    """
    spark = prepare(incoming.sparkSession)
    now = versions(spark, path)
    files = _files(spark, path, now[-1]) if now else []
    first = keys[0]
    new = upsert_latest(incoming.limit(0), incoming, keys, order).persist()
    try:
        hit = touched_files(new, files, first) if files else []
        old = spark.read.schema(incoming.schema).parquet(*(f"{path}/data/{files[i].file}" for i in hit)) if hit else incoming.limit(0)
        total, folder = sum(files[i].n for i in hit) + new.count(), uuid.uuid4().hex
        rows = upsert_latest(old, new, keys, order)
        rows.repartitionByRange(max(1, math.ceil(total / rows_per_file)), *keys).sortWithinPartitions(*keys).write.parquet(f"{path}/data/{folder}")
    finally:
        new.unpersist()
    written = spark.read.schema(incoming.schema).parquet(f"{path}/data/{folder}").select(F.concat(F.lit(f"{folder}/"), "_metadata.file_name").alias("file"), F.col(first).alias("key"))
    stats = written.groupBy("file").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("key").isNull()).alias("blank"))
    if files:
        gone = {files[i].file for i in hit}
        kept = spark.read.parquet(f"{path}/_files/version={now[-1]:09d}")
        stats = stats.unionByName(kept.filter(~F.col("file").isin(*gone)) if gone else kept)
    version, staged = (now[-1] if now else 0) + 1, f"{path}/_staged/{uuid.uuid4().hex}"
    stats.coalesce(1).write.parquet(staged)
    move(spark, staged, f"{path}/_files/version={version:09d}")
    return version


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete older versions and files that the last version doesn't have; how many files went. No reader or merge may be at work."""
    now = versions(spark, path)
    live = {f.file for f in _files(spark, path, now[-1])}
    at, fs = _path(spark, f"{path}/data")
    gone = 0
    for folder in fs.listStatus(at):
        own = folder.getPath()
        for f in fs.listStatus(own):
            name = f.getPath().getName()
            if name.endswith(".parquet") and f"{own.getName()}/{name}" not in live:
                fs.delete(f.getPath(), False)
                gone += 1
    for v in now[:-1]:
        delete(spark, f"{path}/_files/version={v:09d}")
    delete(spark, f"{path}/_staged")
    return gone
