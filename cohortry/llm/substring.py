"""Substring dedup: words covered by a window of words that an earlier document holds too.

Each window has an anchor, the least hash among the runs of half its words that it holds, so that equal windows
have equal anchors and neighbouring windows mostly share one. Windows in a row with one anchor make a block.
A count-min sketch stands before the exact grouping: each task counts the anchors of its blocks in ``ROWS`` rows
of cells, the sketches are added per range of cells, and which cells hold two or more is kept. A window that
occurs twice has an anchor that is counted twice at least, so none is lost. In the second pass only blocks whose
anchor passes are grouped, exactly: equal blocks by content find the smallest doc_id that holds them, and only where an
anchor has blocks of different content are the windows of each such content, taken once, compared one by one.
The sketch is at most ``MOST_BITS`` wide in each row; on inputs that fill it, more blocks pass and the result stays the same.

Defined results: a null or empty text has no words and loses none; texts under ``window`` words lose none; a
null id counts as the largest; rows with equal ids don't take words from each other, and each keeps its
own row; very long texts are read whole, and columns of any other name are kept. Two windows are equal if their 64-bit hashes are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blobs import pack_cells, unpack_cells
from .common import discard, new_names, saved, slices
from .words import mix, window_hashes, word_hashes, word_spans

ROWS = 2
SHARDS = 64
LEAST_BITS, MOST_BITS = 18, 28
FLUSH = 500_000
NO_ID = (1 << 63) - 1
_C = np.uint64(0x9E3779B97F4A7C15)


def _least(x: np.ndarray, span: int) -> np.ndarray:
    """The least of each ``span`` consecutive entries."""
    done = 1
    while done * 2 <= span:
        x = np.minimum(x[: len(x) - done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (span - done)], x[span - done :])


def text_blocks(texts: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, window hashes, and of each block its first window among these, row from there, first word number, anchor) of a slice of rows."""
    half = (size + 1) // 2
    span = size - half + 1
    for a, _, data, offsets in slices(texts):
        starts, ends, first = word_spans(data, offsets)
        if len(starts) < size:
            continue
        runs = window_hashes(word_hashes(data, starts, ends, lower=False), half)
        n = len(starts) - size + 1
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))[:n]
        good = np.flatnonzero(np.arange(n) + size <= first[row + 1])
        if not len(good):
            continue
        row, at = row[good], good - first[row[good]]
        hashes = mix(runs[:n] * _C + runs[size - half : size - half + n])[good]
        anchors = mix(_least(runs, span)[good])
        new = np.ones(len(good), bool)
        new[1:] = (anchors[1:] != anchors[:-1]) | (row[1:] != row[:-1])
        here = np.arange(len(good))
        begin = np.flatnonzero((here - np.maximum.accumulate(np.where(new, here, 0))) % span == 0)  # a periodic text has no block without an end
        yield a, hashes, begin, row[begin], at[begin], anchors[begin]


def _cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    return ((hashes >> np.uint64(32 * row)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def passing(hashes: np.ndarray, maps: list[np.ndarray], bits: int) -> np.ndarray:
    """Places of the hashes whose cells all count two or more."""
    hit = np.arange(len(hashes))
    for k, bitmap in enumerate(maps):
        cells = _cells(hashes[hit], k, bits)
        hit = hit[np.flatnonzero((bitmap[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1)]
    return hit


def repeated_cells(rows: DataFrame, hashes_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int) -> list[bytes]:
    """Per row of the merged sketch of all hashes, a bit map of the cells that count two or more."""
    shard_cells = (1 << bits) // SHARDS

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def sent() -> Iterator[pa.RecordBatch]:
            hashes = np.concatenate(held)
            held.clear()
            for row in range(ROWS):
                cells = np.sort(_cells(hashes, row, bits))
                new = np.ones(len(cells), bool)
                new[1:] = cells[1:] != cells[:-1]
                more = np.unique(cells[~new])
                cells = cells[new]
                edges = np.arange(SHARDS + 1) * shard_cells
                a, b = np.searchsorted(cells, edges), np.searchsorted(more, edges)
                shard = [row * SHARDS + i for i in range(SHARDS)]
                blobs = [[pack_cells(x[e[i] : e[i + 1]] - np.uint32(edges[i])) for i in range(SHARDS)] for x, e in ((cells, a), (more, b))]
                yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), *(pa.array(x, pa.binary()) for x in blobs)], names=["shard", "once", "more"])

        total = 0
        for batch in batches:
            for hashes in hashes_of(batch):
                if len(hashes):
                    held.append(hashes)
                    total += len(hashes)
                if total > FLUSH:
                    yield from sent()
                    total = 0
        if held:
            yield from sent()

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for shard, once, more in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                have = counts.setdefault(shard, np.zeros(shard_cells, np.uint8))
                for blob in (once, more):
                    cells = unpack_cells(blob)
                    have[cells] = np.minimum(have[cells] + 1, 2)
        for shard, have in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([np.packbits(have >= 2, bitorder="little").tobytes()], pa.binary())], names=["shard", "bits"])

    got = rows.mapInArrow(sketches, "shard int, once binary, more binary").repartition("shard").mapInArrow(added, "shard int, bits binary")
    found = {r.shard: bytes(r.bits) for r in got.toLocalIterator()}  # at most ROWS * 2**MOST_BITS bits
    return [b"".join(found.get(row * SHARDS + i, bytes(shard_cells // 8)) for i in range(SHARDS)) for row in range(ROWS)]


def repeated_blocks(rows: DataFrame, size: int, bits: int) -> DataFrame:
    """(anchor, content, doc_id, key, at, hashes) of each block whose anchor's cells all count two or more; ``rows`` has doc_id, key, text."""
    shared = rows.sparkSession.sparkContext.broadcast(repeated_cells(rows.select("text"), lambda batch: (x[-1] for x in text_blocks(batch.column(0), size)), bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = [np.frombuffer(x, np.uint8) for x in shared.value]
        for batch in batches:
            ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a, hashes, begin, row, at, anchors in text_blocks(batch.column(2), size):
                hit = passing(anchors, maps, bits)
                if not len(hit):
                    continue
                length = np.diff(begin, append=len(hashes))
                content = mix(mix(hashes[begin[hit]] * _C + hashes[begin[hit] + length[hit] - 1]) + length[hit].astype(np.uint64))
                use = np.zeros(len(begin), bool)
                use[hit] = True
                offsets = np.concatenate([[0], np.cumsum(length[hit])])
                windows = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(hashes[np.repeat(use, length)].view(np.int64)))
                row = a + row[hit]
                yield pa.RecordBatch.from_arrays([pa.array(anchors[hit].view(np.int64)), pa.array(content.view(np.int64)), pa.array(ids[row]), pa.array(keys[row]), pa.array(at[hit].astype(np.int32)), windows], names=["anchor", "content", "doc_id", "key", "at", "hashes"])

    return rows.select("doc_id", "key", "text").mapInArrow(run, "anchor long, content long, doc_id long, key long, at int, hashes array<long>")


def sketch_bits(expected: float) -> int:
    """Two cells or more for each expected hash, within the bounds."""
    return min(max(int(2 * expected).bit_length(), LEAST_BITS), MOST_BITS)


def _bits(rows: DataFrame, size: int) -> int:
    """For one word for each six bytes of text, and two anchors in each ``size - size/2 + 2`` words."""
    return sketch_bits((rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / (3 * (size - (size + 1) // 2 + 2)))


def removals(rows: DataFrame, size: int) -> DataFrame:
    """(key, spans): the runs of windows (at, n) of a row that start in a document with a smaller doc_id, by word number."""
    blocks = saved(repeated_blocks(rows, size, _bits(rows, size)), "blocks")
    of = ["anchor", "content"]
    # of each content the first document; contents of one anchor that differ are compared window by window
    firsts = saved(blocks.groupBy(*of).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")), "firsts")
    mixed = saved(firsts.groupBy("anchor").agg(F.min("first").alias("low"), F.max("first").alias("high")).filter("low < high").select("anchor"), "mixed")
    contents = firsts.join(mixed, "anchor", "left_semi")
    holders = blocks.join(contents.select(*of, F.col("first").alias("doc_id")), [*of, "doc_id"]).groupBy(*of, "doc_id").agg(F.first("hashes").alias("hashes"))
    windows = saved(holders.select(*of, F.col("doc_id").alias("first"), F.posexplode("hashes").alias("i", "hash")), "windows")
    earlier = saved(windows.groupBy("hash").agg(F.min("first").alias("low"), F.max("first").alias("high")).filter("low < high").select("hash", "low"), "earlier")  # so that Spark can split the join's largest partitions
    parts = windows.join(earlier, "hash").filter("low < first").groupBy(*of).agg(F.collect_set("i").alias("also"))  # at most size - size/2 + 1 a block
    wanted = saved(firsts.join(parts, of, "left").filter("first < last or also is not null").select(*of, "first", "also"), "wanted")
    whole = F.array(F.struct("at", "n"))
    single = F.transform(F.coalesce("also", F.array().cast("array<int>")), lambda i: F.struct((F.col("at") + i).alias("at"), F.lit(1).alias("n")))
    spans = blocks.select(*of, "doc_id", "key", "at", F.size("hashes").alias("n")).join(wanted, of).select("key", F.explode(F.when(F.col("first") < F.col("doc_id"), whole).otherwise(single)).alias("span"))
    found = saved(spans.groupBy("key").agg(F.collect_list("span").alias("spans")), "spans")
    discard(blocks, firsts, mixed, windows, earlier, wanted)
    return found


def _kept(data: bytes | None, spans: list[dict] | None, size: int) -> tuple[int, list[bytes]]:
    words = data.split() if data else []
    if not spans or len(words) < size:
        return len(words), words
    cover = np.zeros(len(words) + 1, np.int32)
    at, n = (np.array([s[c] for s in spans]) for c in ("at", "n"))
    np.add.at(cover, at, 1)
    np.add.at(cover, at + n + size - 1, -1)
    keep = np.flatnonzero(np.cumsum(cover[:-1]) == 0)
    return len(words), [words[i] for i in keep.tolist()]


def _with_removals(docs: DataFrame, size: int, spans: str) -> DataFrame:
    """All columns of ``docs`` and one named ``spans``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    ids = docs.select(doc_id.alias("doc_id")).groupBy("doc_id").count().filter("count > 1")
    key = F.xxhash64(doc_id, text) if ids.take(1) else doc_id  # an id is the shorter key
    rows = docs.select(doc_id.alias("doc_id"), key.alias("key"), text.alias("text"))
    (own,) = new_names([*docs.columns, spans], "key")
    found = removals(rows, size).select(F.col("key").alias(own), F.col("spans").alias(spans))
    return docs.withColumn(own, key).join(found, own, "left").drop(own)


def digests(docs: DataFrame, size: int = 50) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, sha = [], [], []
            for data, spans in zip(batch.column(1).cast(pa.large_binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
                n, kept = _kept(data, spans, size)
                n_words.append(n)
                n_removed.append(n - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return _with_removals(docs.select("doc_id", "text"), size, "spans").select(F.col("doc_id").cast("long"), F.col("text").cast("string"), "spans").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, size: int = 50) -> DataFrame:
    """The same rows and columns; a text that loses words becomes its kept words joined by one space, others stay as they are."""
    names = docs.columns
    (spans,) = new_names(names, "spans")
    at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, texts = batch.columns[:-1], batch.column(at).to_pylist()
            lengths = columns[chars].to_pylist() if chars is not None else []
            for i, own in enumerate(batch.columns[-1].to_pylist()):
                if own:
                    texts[i] = b" ".join(_kept(texts[i].encode(), own, size)[1]).decode()
                    if chars is not None:
                        lengths[i] = len(texts[i])
            columns[at] = pa.array(texts, columns[at].type)
            if chars is not None:
                columns[chars] = pa.array(lengths, columns[chars].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return _with_removals(docs, size, spans).select(*names, spans).mapInArrow(run, docs.schema)
