"""Exact dedup of whole texts by a cuckoo-filter index of live digests.

A text's digest is its SHA-256; its first bits name one of the index's shards. A shard holds a cuckoo filter with a fingerprint of each
live digest, and behind it the digests themselves, bucketed as the filter buckets them, each with its rows' number and the row that stays. A digest
that the filter doesn't know is new and goes in. A hit is verified against the bucket's contents: it joins the digest that equals it, or is new
after all. A digest whose last row is deleted leaves the filter. When eviction finds no place, the shard's filter is built anew from the
stored digests in twice the buckets; when shards hold more than ``SHARD`` digests on average, the index is built anew from them with more shards.

Rows are added up by digest within each task before they are sent to shards, so a text that a third of all rows hold sends a few rows a task.
Contents are compared by all 256 bits of the digest and the text's length in bytes, so texts themselves aren't sent.

Defined results: a null text is an empty one; the largest doc_id stays, a null one only where there is no other; of rows of one text and
doc_id one stays; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import discard, new_names, saved

SHARD, SLOTS, KICKS, COMBINED, AT_ONCE = 2_000, 4, 500, 100_000, 1_024
KEYS = "shard int, digest binary, n_bytes long, keep_id long, keep_row long, n long, slots binary"  # a digest's row, or with slots a shard's filter
NAMES = [c.split()[0] for c in KEYS.split(", ")]


class CuckooFilter:
    """16-bit fingerprints in buckets of ``SLOTS``; a key is 64 bits and has two buckets."""

    def __init__(self, buckets: int, slots: np.ndarray | None = None) -> None:
        self.buckets = buckets  # a power of two
        self.slots = np.zeros((buckets, SLOTS), np.uint16) if slots is None else slots
        self.rng = np.random.default_rng(buckets)

    @staticmethod
    def sized(n: int) -> CuckooFilter:
        """One that n keys fill to 85 % at most."""
        buckets = 8
        while buckets * SLOTS * 0.85 < n:
            buckets *= 2
        return CuckooFilter(buckets)

    @staticmethod
    def of_bytes(data: bytes) -> CuckooFilter:
        slots = np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy()
        return CuckooFilter(len(slots), slots)

    def to_bytes(self) -> bytes:
        return self.slots.tobytes()

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint (never 0), bucket and other bucket of each key."""
        marks = (keys >> np.uint64(48)).astype(np.uint16)
        marks[marks == 0] = 1
        one = (keys & np.uint64(self.buckets - 1)).astype(np.int64)
        return marks, one, self.other(one, marks)

    def other(self, bucket: np.ndarray, marks: np.ndarray) -> np.ndarray:
        return bucket ^ ((marks.astype(np.uint64) * np.uint64(0x5BD1E995) >> np.uint64(3)) & np.uint64(self.buckets - 1)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        marks, one, two = self.places(keys)
        return ((self.slots[one] == marks[:, None]) | (self.slots[two] == marks[:, None])).any(axis=1)

    def repeated(self, keys: np.ndarray) -> np.ndarray:
        """Keys that the filter can't tell from one before them: it would know them by then."""
        marks, one, two = self.places(keys)
        _, first = np.unique(np.minimum(one, two) << 16 | marks, return_index=True)
        return np.isin(np.arange(len(keys)), first, invert=True)

    def insert(self, keys: np.ndarray) -> bool:
        """Whether all keys found a place; if not, some are missing and the filter must be built anew."""
        marks, bucket, two = self.places(keys)
        fresh = np.ones(len(keys), bool)  # those that haven't seen their other bucket
        for _ in range(KICKS):
            if not len(marks):
                return True
            order = np.argsort(bucket, kind="stable")
            marks, bucket, fresh = marks[order], bucket[order], fresh[order]
            rank = np.arange(len(bucket)) - np.searchsorted(bucket, bucket, side="left")
            free = self.slots[bucket] == 0
            fits = rank < free.sum(axis=1)
            nth = np.cumsum(free, axis=1) == (rank + 1)[:, None]
            at = (nth & free).argmax(axis=1)
            self.slots[bucket[fits], at[fits]] = marks[fits]
            marks, bucket, fresh, rank = marks[~fits], bucket[~fits], fresh[~fits], rank[~fits]
            first = ~fresh & (np.r_[True, bucket[1:] != bucket[:-1]] if len(bucket) else np.zeros(0, bool))  # one eviction a bucket and round
            slot = self.rng.integers(0, SLOTS, len(bucket))
            old = self.slots[bucket[first], slot[first]].copy()
            self.slots[bucket[first], slot[first]] = marks[first]
            marks[first] = old
            move = fresh | first
            bucket[move] = self.other(bucket[move], marks[move])
            fresh = np.zeros(len(marks), bool)
        return not len(marks)

    def delete(self, keys: np.ndarray) -> None:
        """Keys that are in; of each the fingerprint goes once."""
        for mark, *buckets in zip(*self.places(keys), strict=True):
            for b in buckets:
                at = np.flatnonzero(self.slots[b] == mark)
                if len(at):
                    self.slots[b, at[0]] = 0
                    break


def filled(keys: np.ndarray, buckets: int = 8) -> CuckooFilter:
    """A filter of distinct digests' keys; overflow doubles its buckets."""
    index = CuckooFilter(max(buckets, CuckooFilter.sized(len(keys)).buckets))
    while not index.insert(keys):
        index = CuckooFilter(index.buckets * 2)
    return index


class Shard:
    """A filter and the contents behind it: digest, length, row that stays and number of rows, and where those of a bucket are."""

    def __init__(self, rows: list[dict]) -> None:
        stored = [r for r in rows if r["slots"] is None]
        self.hold([[r["digest"], r["n_bytes"], r["keep_id"], r["keep_row"], r["n"]] for r in stored])
        slots = [r["slots"] for r in rows if r["slots"] is not None]
        self.filter = CuckooFilter.of_bytes(slots[0]) if slots else filled(self.keys())

    def hold(self, contents: list[list]) -> None:
        self.contents, self.buckets = contents, {}
        for i, c in enumerate(contents):
            self.buckets.setdefault(bucket_key(c[0]), []).append(i)

    def keys(self) -> np.ndarray:
        return filter_keys([c[0] for c in self.contents])

    def find(self, digest: bytes, n_bytes: int) -> int | None:
        return next((i for i in self.buckets.get(bucket_key(digest), ()) if self.contents[i][0] == digest and self.contents[i][1] == n_bytes), None)

    def add(self, rows: list[dict]) -> None:
        """Rows (digest, n_bytes, keep_id, keep_row, n) of texts' digests, repeated ones among them. Only what the filter knows is looked up."""
        for a in range(0, len(rows), AT_ONCE):
            part, new = rows[a : a + AT_ONCE], []
            keys = filter_keys([r["digest"] for r in part])
            for r, hit in zip(part, self.filter.contains(keys) | self.filter.repeated(keys), strict=True):
                i = self.find(r["digest"], r["n_bytes"]) if hit else None
                if i is None:
                    new.append(r["digest"])
                    self.buckets.setdefault(bucket_key(r["digest"]), []).append(len(self.contents))
                    self.contents.append([r["digest"], r["n_bytes"], r["keep_id"], r["keep_row"], r["n"]])
                    continue
                c = self.contents[i]
                c[4] += r["n"]
                if rank(r["keep_id"], r["keep_row"]) > rank(c[2], c[3]):
                    c[2:4] = r["keep_id"], r["keep_row"]
            if new and not self.filter.insert(filter_keys(new)):
                self.filter = filled(self.keys(), self.filter.buckets * 2)

    def hits(self, rows: list[dict]) -> list[list]:
        """The contents that equal one of the rows."""
        known = self.filter.contains(filter_keys([r["digest"] for r in rows])) if rows else []
        found = {self.find(r["digest"], r["n_bytes"]) for r, hit in zip(rows, known, strict=True) if hit}
        return [self.contents[i] for i in found if i is not None]

    def settle(self, rows: list[dict]) -> None:
        """What is left of digests after a deletion (n 0: nothing)."""
        for r in rows:
            i = self.find(r["digest"], r["n_bytes"])
            if i is None:
                continue
            if r["n"]:
                self.contents[i][2:] = r["keep_id"], r["keep_row"], r["n"]
            else:
                self.filter.delete(filter_keys([r["digest"]]))
                self.buckets[bucket_key(r["digest"])].remove(i)
                self.contents[i][4] = 0
        self.hold([c for c in self.contents if c[4]])

    def table(self, shard: int) -> pa.Table:
        return state_rows(shard, [[*c, None] for c in self.contents] + [[None] * 5 + [self.filter.to_bytes()]])


def state_rows(shard: int, rows: list[list]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[]] * 6
    types = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.table([pa.array([shard] * len(rows), pa.int32()), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=NAMES)


def rank(doc_id: int | None, row: int) -> tuple:
    return doc_id is not None, doc_id or 0, row


def bucket_key(digest: bytes) -> int:
    """The part of a digest that fingerprint and buckets are made of, whatever the number of buckets."""
    return int.from_bytes(digest[8:16], "little")


def filter_keys(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(d[8:16] for d in digests), "<u8").astype(np.uint64)


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", row: Column | None = None) -> DataFrame:
    """(doc_id, row, digest, n_bytes) of every row; ``row`` tells rows apart once the table is saved."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), (F.monotonically_increasing_id() if row is None else row).alias("row"), F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))


def combined(rows: DataFrame) -> DataFrame:
    """(digest, n_bytes, keep_id, keep_row, n): each task's rows added up by digest, some ten thousand at a time."""

    def flush(tables: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(tables)
        order = pc.sort_indices(t, sort_keys=[("digest", "ascending"), ("n_bytes", "ascending"), ("doc_id", "ascending"), ("row", "ascending")], null_placement="at_start")
        t = t.take(order)
        out = t.group_by(["digest", "n_bytes"], use_threads=False).aggregate([("doc_id", "last", pc.ScalarAggregateOptions(skip_nulls=False)), ("row", "last"), ("row", "count")])
        yield from out.select(["digest", "n_bytes", "doc_id_last", "row_last", "row_count"]).rename_columns(["digest", "n_bytes", "keep_id", "keep_row", "n"]).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= COMBINED:
                yield from flush(held)
                held, n = [], 0
        if n:
            yield from flush(held)

    return rows.select("digest", "n_bytes", "doc_id", "row").mapInArrow(run, "digest binary, n_bytes long, keep_id long, keep_row long, n long")


def shard_of(bits: int):
    """The first bits of the digest."""
    return F.shiftright(F.conv(F.substring(F.hex("digest"), 1, 7), 16, 10).cast("int"), 28 - bits)


def bits_for(n: int) -> int:
    bits = 0
    while (SHARD << bits) < n and bits < 28:
        bits += 1
    return bits


def applied(state: DataFrame | None, rows: DataFrame, bits: int, how: str) -> DataFrame:
    """The next state of the shards with ``rows`` added (``add``) or settled (``settle``), or what they hold of ``rows`` (``hits``)."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        number = key[0].as_py()
        shard = Shard(table.filter(pc.equal(table["kind"], 0)).to_pylist())
        found = getattr(shard, how)(table.filter(pc.equal(table["kind"], 1)).to_pylist())
        return state_rows(number, [[*c, None] for c in found]) if how == "hits" else shard.table(number)

    both = rows.select(shard_of(bits).alias("shard"), *NAMES[1:-1], F.lit(None).cast("binary").alias("slots"), F.lit(1).alias("kind"))
    if state is not None:
        both = state.withColumn("kind", F.lit(0)).unionByName(both)
    return both.groupBy("shard").applyInArrow(run, KEYS)


class LiveIndex:
    """The live digests of a collection that grows and shrinks. Its state is two tables in the shared folder: members and shards."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.bits = spark, 0
        self.members: DataFrame | None = None
        self.state: DataFrame | None = None

    def insert(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", row: Column | None = None) -> DataFrame:
        """The rows' (doc_id, row, digest, n_bytes), now members. ``row``, for a first insertion, tells rows apart; else they are numbered."""
        rows = digests(docs, id_column, text_column, row)
        if self.members is not None:
            top = self.members.agg(F.max("row")).first()[0]
            rows = rows.withColumn("row", F.col("row") + F.lit(-1 if top is None else top) + 1)
        new = saved(rows, "digests")
        bits = max(self.bits, bits_for(self.size() + new.count()))
        state = self.state
        if state is not None and bits > self.bits:  # digests that change shards: their filters are built anew from them
            state = state.filter("slots is null").withColumn("shard", shard_of(bits))
        self._turn(saved(applied(state, combined(new), bits, "add"), "shards"), bits)
        self._members(new if self.members is None else saved(self.members.unionByName(new), "members"))
        return new

    def delete(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> None:
        """Removes a member of the same doc_id and text for each row; rows that aren't members remove nothing."""
        if self.members is None:
            return
        key = ["doc_id", "digest", "n_bytes"]
        gone = digests(docs, id_column, text_column).groupBy(*key).agg(F.count(F.lit(1)).alias("k"))
        same = [F.col(f"m.{c}").eqNullSafe(F.col(f"g.{c}")) for c in key]
        touched = saved(self.members.alias("m").join(gone.alias("g"), same[0] & same[1] & same[2]).select("m.*", "g.k"), "touched")
        order = F.row_number().over(Window.partitionBy(*key).orderBy("row"))
        removed = saved(touched.withColumn("nth", order).filter("nth <= k").select("row", "digest", "n_bytes"), "removed")
        left = saved(self.members.join(removed.select("row"), "row", "left_anti"), "members")
        hit = removed.select("digest", "n_bytes").distinct()
        kept = left.join(hit, ["digest", "n_bytes"], "left_semi").groupBy("digest", "n_bytes").agg(F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "row")).alias("top"), F.count(F.lit(1)).alias("n"))
        rows = hit.join(kept, ["digest", "n_bytes"], "left").select("digest", "n_bytes", F.col("top.doc_id").alias("keep_id"), F.col("top.row").alias("keep_row"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))
        self._turn(saved(applied(self.state, rows, self.bits, "settle"), "shards"), self.bits)
        self._members(left)
        discard(touched, removed)

    def size(self) -> int:
        return 0 if self.state is None else self.state.filter("slots is null").count()

    def groups(self) -> DataFrame:
        """(digest, n_bytes, keep_id, keep_row, n) of the live texts."""
        return self.state.filter("slots is null").select("digest", "n_bytes", "keep_id", "keep_row", "n")

    def lookup(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
        """(doc_id, keep_id): of rows that needn't be members the id of the live row with their text, null where there is none."""
        rows = digests(docs, id_column, text_column)
        found = applied(self.state, combined(rows), self.bits, "hits").select("digest", "n_bytes", "keep_id") if self.state is not None else None
        return rows.select("doc_id", F.lit(None).cast("long").alias("keep_id")) if found is None else rows.join(found, ["digest", "n_bytes"], "left").select("doc_id", "keep_id")

    def _turn(self, state: DataFrame, bits: int) -> None:
        old, self.state, self.bits = self.state, state, bits
        if old is not None:
            discard(old)

    def _members(self, members: DataFrame) -> None:
        old, self.members = self.members, members
        if old is not None:
            discard(old)


def judged(docs: DataFrame, id_column: str, text_column: str, row: Column | None = None) -> DataFrame:
    """Per row: doc_id, row, digest, keep_id, group_size, kept. Only texts of several rows are joined back; Spark splits hot ones' partitions."""
    index = LiveIndex(docs.sparkSession)
    rows = index.insert(docs, id_column, text_column, row)
    several = saved(index.groups().filter("n > 1"), "several")
    discard(index.state)
    out, single = rows.join(several, ["digest", "n_bytes"], "left"), F.col("n").isNull()
    return out.select(
        "doc_id", "row", "digest", F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("row") == F.col("keep_row"))).alias("kept"),
    )


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    return judged(docs, id_column, text_column).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def first_rows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that stay, with all their columns, whatever their names."""
    (mark,) = new_names(docs.columns, "row")
    marked = saved(docs.withColumn(mark, F.monotonically_increasing_id()), "rows")
    dropped = judged(marked, id_column, text_column, F.col(mark)).filter(~F.col("kept")).select(F.col("row").alias(mark))
    return marked.join(dropped, mark, "left_anti").select(*docs.columns)
