"""Best-fit packing of tokenised documents into sequences of a fixed size, in bulk-synchronous supersteps.

Documents (pieces) are range-sorted by length. Superstep after superstep, ever smaller documents join those that are still without a place.
Every gap offers them slots: as many of the largest length among them as it holds, the last one with what is left.
A sweep over documents and slots in descending size gives each document its successor: the smallest slot of those that
hold it and that no longer document takes. Slots open and documents close brackets, and a document's slot is
the bracket that it closes: its rank and its class's offset give the nesting depth of a row, and within one depth a document follows its slot.
So a conflict over a slot is resolved by rank, no slot is given twice, and a depth holds at most two rows of a size. Then gaps shrink, and documents
that found no slot try again in the next superstep; for those larger than all gaps new sequences are opened. Ranks, depths, matches and gaps are Spark tables; the driver
sees only counts by size (at most ``capacity``) and their running sums.

Defined results: a null text is an empty document with only the end id; texts of any length are cut, whole, into pieces of ``capacity``; repeated rows and rows
with equal or null ids are packed each on its own, ranked by doc_id (null first), piece and content, then as they were read; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bpe import vocabulary
from .common import discard, saved, scratch_path

ROWS = 2_000


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Piece lengths of a document of n ids: only the first may be shorter than ``capacity``."""
    head = n % capacity
    return [head] * (head > 0) + [capacity] * (n // capacity)


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32) of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = vocabulary(path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                for doc_id, encoded in zip(part.column(0).to_pylist(), bpe.encode_batch(part.column(1).to_pylist()), strict=True):
                    ids, at = memoryview(encoded + end), 0
                    for k, size in enumerate(cut_lengths(len(ids) // 4, capacity)):
                        rows.append((doc_id, k, at, size, zlib.crc32(ids[4 * at : 4 * (at + size)])))
                        at += size
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _by_size(values: np.ndarray) -> Column:
    """The entry of ``values`` at a row's size."""
    return F.get(F.from_json(F.lit(json.dumps([int(v) for v in values])), "array<long>"), F.col("size").cast("int"))


def ranked(rows: DataFrame, counts: np.ndarray, *key: str) -> DataFrame:
    """``rows`` with k, a rank from 0 among the rows of one size; ``counts`` are the rows of each size, which is ranked in parts of ``ROWS``. No two rows of a size have one ``key``."""
    if counts.max() <= ROWS:  # each size is one part
        return rows.withColumn("k", F.row_number().over(Window.partitionBy("size").orderBy(*key)).cast("long") - 1)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*key), _by_size(np.maximum(1, -(-counts // ROWS)))).cast("int"))
    each = salted.groupBy("size", "salt").count().withColumn("block", F.expr(f"salt div {ROWS}"))
    ahead = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    blocks = each.groupBy("size", "block").agg(F.sum("count").alias("n")).select("size", "block", F.coalesce(F.sum("n").over(ahead("size", "block")), F.lit(0)).alias("first"))
    inner = each.withColumn("base", F.coalesce(F.sum("count").over(ahead("size", "block", "salt")), F.lit(0)))  # running sums in blocks of parts, and over blocks
    bases = inner.join(blocks, ["size", "block"]).select("size", "salt", (F.col("base") + F.col("first")).alias("base"))
    own = Window.partitionBy("size", "salt").orderBy(*key)
    return salted.withColumn("k", F.row_number().over(own) - 1).join(bases, ["size", "salt"]).withColumn("k", F.col("k") + F.col("base")).drop("salt", "base")


def counts_of(rows: DataFrame, capacity: int) -> np.ndarray:
    """Rows of each size from 0 to ``capacity``."""
    out = np.zeros(capacity + 1, np.int64)
    for r in rows.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect():  # at most ``capacity`` rows
        out[r["size"]] = r["n"]
    return out


def slot_counts(gaps: np.ndarray, low: int, high: int) -> np.ndarray:
    """Slots of each size that gaps (counts by size) larger than ``low`` offer to lengths up to ``high``."""
    out, sizes = np.zeros_like(gaps), np.arange(low + 1, len(gaps))
    more = np.maximum(1, sizes // high) - 1
    np.add.at(out, sizes - more * high, gaps[low + 1 :])
    out[high] += (more * gaps[low + 1 :]).sum()
    return out


def depths(slots: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unmatched larger slots before each size, and the documents of each size that find a slot."""
    before, matched, depth = np.zeros_like(slots), np.zeros_like(docs), 0
    for size in range(len(slots) - 1, 0, -1):
        before[size] = depth
        matched[size] = min(docs[size], depth + slots[size])
        depth += slots[size] - matched[size]
    return before, matched


def sweep(slots: DataFrame, docs: DataFrame, n_slots: np.ndarray, before: np.ndarray) -> DataFrame:
    """Each of ``docs`` (size, k, ...) that has a slot, with the ``sequence_id`` of it.

    Slots and documents are ranked from 0 among those of their size. A slot lies one deeper than the slot
    before it, and the next document closes the deepest slot that is open.
    """
    opened = slots.select("size", (_by_size(before) + F.col("k")).alias("depth"), F.lit(0).alias("kind"), F.col("sequence_id").alias("held"))
    closing = docs.withColumn("depth", _by_size(before + n_slots) - 1 - F.col("nth")).filter("depth >= 0").withColumn("kind", F.lit(1)).drop("nth")
    order = Window.partitionBy("depth").orderBy(F.desc("size"), "kind")  # at most two rows of a size
    both = opened.unionByName(closing, allowMissingColumns=True)
    return both.withColumn("sequence_id", F.lag("held").over(order)).filter("kind = 1").drop("depth", "kind", "held")


def pack(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    cut = saved(pieces(docs, path, capacity, end_id).withColumnRenamed("length", "size").withColumn("row", F.monotonically_increasing_id()), "pieces")  # equal rows differ by ``row``
    left = counts_of(cut, capacity)
    ranks = saved(ranked(cut, left, "doc_id", "piece", "start", "ids_crc32", "row").drop("row").orderBy("size", "k"), "ranks")
    discard(cut)
    opened, left[capacity] = int(left[capacity]), 0  # whole sequences
    placed, root, step = np.zeros_like(left), scratch_path(spark, "placed"), 0
    gaps, free, low, sizes = None, np.zeros_like(left), capacity, np.arange(capacity + 1)
    while left.any():
        high = int(np.flatnonzero(left)[-1])
        low = min(low, high)
        low = low * 3 // 4 if low > capacity // 4 else low // 2
        band = np.where(sizes > low, left, 0)
        stuck = np.where(sizes > np.flatnonzero(free)[-1:].sum(), band, 0)  # larger than all gaps
        half = stuck[: capacity // 2 + 1]
        fresh = int(stuck.sum()) if not half.any() else -(-int((stuck * sizes).sum()) // capacity)
        ids = spark.range(opened, opened + fresh).select(F.col("id").alias("sequence_id"), F.lit(capacity).cast("long").alias("size"))
        held = ids if gaps is None else gaps.unionByName(ids) if fresh else gaps
        opened, free[capacity] = opened + fresh, free[capacity] + fresh
        n_slots = slot_counts(free, low, high)
        before, matched = depths(n_slots, band)
        more = F.greatest(F.lit(1), F.floor(F.col("size") / high)) - 1
        own = held.filter(F.col("size") > low).select("sequence_id", F.col("size").alias("gap"), more.alias("more"), F.explode(F.sequence(F.lit(0).cast("long"), more)).alias("slot"))
        size = F.when(F.col("slot") < F.col("more"), F.lit(high).cast("long")).otherwise(F.col("gap") - F.col("more") * high)
        slots = ranked(own.select("sequence_id", "slot", size.alias("size")), n_slots, "sequence_id", "slot")
        waiting = ranks.filter(F.col("size").between(low + 1, high)).withColumn("nth", F.col("k") - _by_size(placed)).filter("nth >= 0")
        found = sweep(slots, waiting, n_slots, before)
        found.write.parquet(f"{root}/step={step}")
        taken = spark.read.schema(found.schema).parquet(f"{root}/step={step}")
        left, placed, step = left - matched, placed + matched, step + 1
        if left.any():
            rest = held.unionByName(taken.select("sequence_id", (-F.col("size")).alias("size"))).groupBy("sequence_id").agg(F.sum("size").alias("size")).filter("size > 0")
            old, gaps = gaps, saved(rest, "gaps")
            if old is not None:
                discard(old)
            free = counts_of(gaps, capacity)
    columns = ["doc_id", "piece", "start", F.col("size").alias("length"), "ids_crc32", "sequence_id"]
    whole = ranks.filter(F.col("size") == capacity).withColumn("sequence_id", F.col("k")).select(*columns, F.lit(0).cast("long").alias("offset"))
    if not step:
        return whole
    if gaps is not None:
        discard(gaps)
    before = Window.partitionBy("sequence_id").orderBy(F.desc("size"), "k").rowsBetween(Window.unboundedPreceding, -1)
    shared = spark.read.schema(found.schema).parquet(*(f"{root}/step={i}" for i in range(step)))
    return whole.unionByName(shared.select(*columns, F.coalesce(F.sum("size").over(before), F.lit(0)).cast("long").alias("offset")))
