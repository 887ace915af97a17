"""Tables that grow by publications: each is staged out of readers' sight, counted, and renamed into place as a whole.

A publication is a folder ``publication=NAME`` of Parquet files. Folders whose names begin with an underscore are none of the table, so what a
killed or failed writer leaves behind is never read. A name is published once: a writer that runs again under the same name changes nothing, so
a stream that names its publications by query and batch writes each batch exactly once. The rename of a folder is atomic on file systems like HDFS;
a table has one writer for a name.

``compact`` puts many small publications into one. A list of the names that it replaces is there before it is; once it is published, readers leave those out, and
a name on the list of a compaction counts as published for ever. ``vacuum`` deletes the replaced folders when no reader is at work.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import prepare


COMPACTED = "compacted-"


def _path(spark: SparkSession, path: str):
    """A path and its file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _path(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    at, fs = _path(spark, path)
    fs.delete(at, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder to a name that isn't there yet."""
    (a, fs), (b, _) = _path(spark, source), _path(spark, target)
    fs.mkdirs(b.getParent())
    if fs.exists(b) or not fs.rename(a, b):
        raise FileExistsError(f"{target} can't be published")


def names(spark: SparkSession, path: str, prefix: str = "publication=") -> list[str]:
    """What is published, in the order of names."""
    at, fs = _path(spark, path)
    found = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(n.removeprefix(prefix) for n in found if n.startswith(prefix))


def replaced(spark: SparkSession, path: str) -> DataFrame:
    """(value): the names that published compactions stand for."""
    live = set(names(spark, path))
    if not any(n.startswith(COMPACTED) for n in live) or not exists(spark, f"{path}/_replaced"):
        return spark.createDataFrame([], "value string")
    lists = names(spark, f"{path}/_replaced", COMPACTED)
    every = spark.read.text([f"{path}/_replaced/{COMPACTED}{n}" for n in lists]).select("value", F.regexp_extract("_metadata.file_path", f"/({COMPACTED}[0-9a-f]+)/", 1).alias("list"))
    done = every.filter(F.col("list").isin([n for n in live if n.startswith(COMPACTED)]))
    again = every.join(every.select(F.col("value").alias("list")), "list", "left_semi")  # lists of compactions that are compacted themselves
    return done.select("value").unionByName(again.select("value")).distinct()


def is_published(spark: SparkSession, path: str, name: str) -> bool:
    return exists(spark, f"{path}/publication={name}") or bool(replaced(spark, path).filter(F.col("value") == name).take(1))


def publish(df: DataFrame, path: str, name: str, by: tuple[str, ...] = (), expected: int | None = None) -> int | None:
    """Add the rows of ``df`` as publication ``name``; how many they are, or None if that name is published already.

    Before anything shows, the staged rows are counted again: as many as the frame gave while it was written, and as many
    as expected if that is given. Else the staged files go, the table stays as it was and ValueError is raised. ``by`` are columns for folders within the publication.
    """
    spark = prepare(df.sparkSession)
    if not re.fullmatch(r"[A-Za-z0-9._-]+", name):
        raise ValueError(f"{name!r} can't name a publication")
    target, staged = f"{path}/publication={name}", f"{path}/_staged/{name}-{uuid.uuid4().hex}"
    if is_published(spark, path, name):
        return None
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.partitionBy(*by).parquet(staged)
    written = spark.read.schema(df.schema).parquet(staged).count()
    wanted = {seen.get["n"]} | ({expected} if expected is not None else set())
    if wanted != {written}:
        delete(spark, staged)
        raise ValueError(f"{' and '.join(map(str, sorted(wanted)))} rows expected, {written} written")
    move(spark, staged, target)
    return written


def published(spark: SparkSession, path: str, schema: str, only: Column | None = None) -> DataFrame:
    """The table's rows; none where nothing is published. ``only`` is a condition that may name ``publication``."""
    rows = _live(spark, path, schema)
    return (rows if only is None else rows.filter(only)).drop("publication")


def _live(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table's rows with ``publication``, without replaced ones that aren't deleted yet."""
    now = names(spark, path)
    if not now:
        return spark.createDataFrame([], f"{schema}, publication string")
    rows = spark.read.schema(f"{schema}, publication string").parquet(path)
    old = _leftover(spark, path, now)
    return rows.filter(~F.col("publication").isin(old)) if old else rows


def _leftover(spark: SparkSession, path: str, now: list[str]) -> list[str]:
    """Folders that a compaction replaces: none but between it and ``vacuum``."""
    if not any(n.startswith(COMPACTED) for n in now):
        return []
    return [r.value for r in replaced(spark, path).filter(F.col("value").isin(now)).collect()]


def compact(spark: SparkSession, path: str, schema: str, by: tuple[str, ...] = (), keep: int = 0) -> int:
    """Put all publications but the last ``keep`` by name into one; how many they were. One compaction of a table runs at a time."""
    spark = prepare(spark)
    now = names(spark, path)
    old = set(_leftover(spark, path, now))
    small = [n for n in now if n not in old][: len(now) - len(old) - keep]
    if len(small) < 2:
        return 0
    name = f"{COMPACTED}{uuid.uuid4().hex}"
    rows = _live(spark, path, schema).filter(F.col("publication").isin(small)).drop("publication")
    staged = f"{path}/_staged/{name}"
    (rows.hint("rebalance", *by) if by else rows.hint("rebalance")).write.partitionBy(*by).parquet(staged)
    if spark.read.schema(rows.schema).parquet(staged).count() != rows.count():
        delete(spark, staged)
        raise ValueError("a compaction has other rows than its publications")
    spark.createDataFrame([(n,) for n in small], "value string").coalesce(1).write.text(f"{path}/_replaced/{name}")
    move(spark, staged, f"{path}/publication={name}")
    return len(small)


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete replaced publications and what failed writers left; how many publications went. No reader or writer may be at work."""
    old = _leftover(spark, path, names(spark, path))
    for n in old:
        delete(spark, f"{path}/publication={n}")
    delete(spark, f"{path}/_staged")
    return len(old)


def transaction(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """A name for a batch of the streaming query of this checkpoint, the same whenever the batch runs again."""
    return f"{json.loads(spark.read.text(f'{checkpoint}/metadata').first()[0])['id']}-{batch_id}"
