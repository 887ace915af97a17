"""Shared plumbing of the training-data operators: tables, scratch space, batching.

Everything an operator keeps between two Spark jobs is a Parquet table in the shared
folder that the cluster names in ``spark.checkpoint.dir``, so a lost executor costs only
the tasks it was running.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


BATCH_ROWS = 1000


def bound_batches(spark: SparkSession) -> None:
    """From now on an Arrow batch of the session has ``BATCH_ROWS`` rows at most: texts are long, and a task holds a batch several times."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; a default of our own only on a local master."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "/tmp/checkpoints"
    return f"{root.rstrip('/')}/cohortry-{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    bound_batches(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``saved`` that nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def new_names(columns: list[str], *wanted: str) -> list[str]:
    """The wanted names, each with so many underscores before it that no column has it, in whatever case."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(texts: pa.Array, max_bytes: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column into runs of rows of about ``max_bytes`` (one row at least).

    Yields (first row, end row, bytes, offsets); offsets has one entry more than rows and
    starts at 0. Null is an empty text.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    arr = texts.fill_null("").cast(pa.large_binary())
    n = len(arr)
    if not n:
        return
    _, off_buf, data_buf = arr.buffers()
    offsets = np.frombuffer(off_buf, dtype=np.int64)[arr.offset : arr.offset + n + 1]
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.empty(0, np.uint8)
    a = 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + max_bytes, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def largest(df: DataFrame, column: str, most: int, some: bool = False) -> DataFrame:
    """At most ``most`` rows, those of the largest values of a positive count: all of some size class or none of it.

    The classes are sixteenths of powers of two, so finding the smallest takes few rows, and no task sends more than it keeps.
    With ``some``, if the largest class alone is too large, the rows of it whose hashes fall in the first slices that fit.
    """
    size = F.floor(F.log2(column) * 16)
    classes = df.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("size")).collect()  # some hundred rows
    least, total = None, 0
    for r in classes:
        total += r.n
        if total > most:
            break
        least = r["size"]
    if least is None and some and classes:
        first = df.filter(size >= classes[0]["size"]).withColumn("_slice", F.pmod(F.xxhash64(*df.columns), F.lit(4096)))
        total, end = 0, 0
        for r in first.groupBy("_slice").count().orderBy("_slice").collect():  # 4,096 rows at most
            total += r["count"]
            if total > most:
                break
            end = r["_slice"] + 1
        return first.filter(F.col("_slice") < end).drop("_slice")
    return df.filter(size >= least) if least is not None else df.limit(0)


def crc32_mod(col: str, k: int):
    """crc32 of an id written as text, modulo ``k``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % k
