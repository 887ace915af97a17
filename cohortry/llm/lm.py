"""A log-bilinear language model, trained in numpy with noise-contrastive estimation.

Two context words, each by its class, predict the class of the next token: with context vectors r and
target vectors q, s(t | c1, c2) = (r1[c1] + r2[c2]) . q[t] + b[t]. A target's class is one of the ``TARGETS`` most frequent
words, the end, or one of ``BUCKETS`` shapes of the other words (last sign, characters outside
ASCII, last letters); the first context's is one of the ``CONTEXTS`` most frequent words or a shape, the second's always
a shape. These numbers don't grow with the input. Inside a shape a word has its share of the training counts after absolute
discounting, and unknown words share what the discount frees. So the probabilities of all known
tokens and of one unknown word per shape sum to 1 after any context.

Training tables are counts over all training texts: every task adds up its (context, context, target)
counts and the sums are merged by Spark into shards. One task then trains on all of them, in ``PASSES`` passes with
the expected noise of the unigram counts; nothing is trained per shard or averaged.
Scores come from one batched matrix product over all context pairs with exact normalisers.

The counts of the ``HOT`` most frequent words go to every task; a text's other words are joined with the
table of counts by Spark.

Defined results: a null or empty text is the end token alone; rows with equal ids and texts are all
returned. Words are compared by 64-bit hashes. Without training texts all tokens are unknown.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blobs import from_planes, pack_cells, planes, unpack_cells
from .common import crc32_mod, largest, saved, slices
from .words import mix, word_hashes, word_spans

BUCKETS, TARGETS, CONTEXTS, HOT = 48, 768, 64, 200_000
DIM, PASSES, SHARDS, NOISE = 32, 40, 16, 25
END = np.uint64(0x656E64)  # stands for the end token among word hashes


def shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Bucket of each word: last sign (3) x characters outside ASCII (2) x last two letters (8)."""
    if not len(starts):
        return np.empty(0, np.int64)
    lower = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.int64)
    last = lower[ends - 1]
    sign = np.where(last == 46, 1, np.where(last == 44, 2, 0))
    high = np.concatenate([[0], np.cumsum(data >= 128)])
    at = np.maximum(ends - 1 - (sign > 0), starts)
    letters = mix((lower[at] * 256 + lower[np.maximum(at - 1, starts)]).astype(np.uint64)) & np.uint64(7)
    return (sign * 2 + (high[ends] > high[starts])) * 8 + letters.astype(np.int64)


def _tokens(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, word hashes, shapes, index of each row's first word) of slices of rows."""
    for a, _, data, offsets in slices(texts):
        starts, ends, first = word_spans(data, offsets)
        yield a, word_hashes(data, starts, ends, lower=True), shapes(data, starts, ends), first


def word_counts(texts: DataFrame) -> DataFrame:
    """(hash, bucket, n) of all words of ``text``; the end token has bucket -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ends = [], 0

        def sent() -> pa.RecordBatch:
            hashes, buckets = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            found, at, n = np.unique(hashes, return_index=True, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(buckets[at].astype(np.int32)), pa.array(n.astype(np.int64))], names=["hash", "bucket", "n"])

        for batch in batches:
            ends += batch.num_rows
            for _, hashes, buckets, _ in _tokens(batch.column(0)):
                held.append((hashes, buckets.astype(np.int8)))
                if sum(len(x) for x, _ in held) > 2_000_000:
                    yield sent()
        if held:
            yield sent()
        yield pa.RecordBatch.from_arrays([pa.array([int(END)], pa.int64()), pa.array([-1], pa.int32()), pa.array([ends], pa.int64())], names=["hash", "bucket", "n"])

    return texts.select("text").mapInArrow(run, "hash long, bucket int, n long").groupBy("hash").agg(F.min("bucket").alias("bucket"), F.sum("n").alias("n")).filter("n > 0")


@dataclass
class Classes:
    """The frequent words: sorted hashes, and for each its target class, context class, shape and count."""

    hashes: np.ndarray
    target: np.ndarray  # below TARGETS for the most frequent, else TARGETS + shape
    context: np.ndarray  # below CONTEXTS for the most frequent, else CONTEXTS + shape
    bucket: np.ndarray
    n: np.ndarray

    targets = TARGETS + BUCKETS + 1  # the last is the end
    firsts = CONTEXTS + BUCKETS + 1  # the last is the text's start
    seconds = BUCKETS + 1

    def of(self, hashes: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place among the frequent words (-1: none), target class, context class."""
        if not len(self.hashes):
            return np.full(len(hashes), -1), TARGETS + buckets, CONTEXTS + buckets
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hot = self.hashes[at] == hashes
        return np.where(hot, at, -1), np.where(hot, self.target[at], TARGETS + buckets), np.where(hot, self.context[at], CONTEXTS + buckets)

    def sequences(self, hashes, buckets, first) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of a slice of texts with their ends: place, target class, context pair and row of each token."""
        rows = len(first) - 1
        place, target, context = self.of(hashes, buckets)
        sizes = np.diff(first) + 1
        row = np.repeat(np.arange(rows), sizes)
        word = np.ones(len(row), bool)
        stops = np.cumsum(sizes) - 1
        word[stops] = False
        out_place, out_target = np.full(len(row), -2), np.full(len(row), self.targets - 1)
        out_place[word], out_target[word] = place, target
        by_word, by_shape = np.full(len(row), self.firsts - 1), np.full(len(row), self.seconds - 1)
        by_word[word], by_shape[word] = context, buckets
        starts = stops - sizes + 1
        one, two = np.empty_like(by_word), np.empty_like(by_shape)
        one[0], one[1:] = 0, by_word[:-1]
        one[starts] = self.firsts - 1
        two[:2], two[2:] = 0, by_shape[:-2]
        two[starts] = self.seconds - 1
        two[(starts + 1)[sizes > 1]] = self.seconds - 1
        return out_place, out_target, one * self.seconds + two, row


def frequent(counts: DataFrame) -> Classes:
    top = largest(counts.filter("bucket >= 0"), "n", HOT, some=True).toPandas().sort_values(["n", "hash"], ascending=[False, True])
    rank = np.arange(len(top))
    bucket = top["bucket"].to_numpy(np.int64)
    target, context = np.where(rank < TARGETS, rank, TARGETS + bucket), np.where(rank < CONTEXTS, rank, CONTEXTS + bucket)
    hashes = top["hash"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Classes(hashes[order], target[order], context[order], bucket[order], top["n"].to_numpy(np.int64)[order])


def context_counts(texts: DataFrame, classes: Classes) -> DataFrame:
    """(shard, cells, n): how often each (context pair, target) occurs; a cell's shard is its number modulo SHARDS."""
    size = classes.firsts * classes.seconds * classes.targets
    wide = -(-size // SHARDS)
    shared = texts.sparkSession.sparkContext.broadcast(classes)

    def blobs(shard: int, cells: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([pack_cells(cells)], pa.binary()), pa.array([planes(n)], pa.binary())], names=["shard", "cells", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.uint32)
        for batch in batches:
            for _, hashes, buckets, first in _tokens(batch.column(0)):
                _, target, pair, _ = shared.value.sequences(hashes, buckets, first)
                cells, n = np.unique(pair * classes.targets + target, return_counts=True)
                total[cells] += n.astype(np.uint32)
        for shard in range(SHARDS):
            own = total[shard::SHARDS]
            cells = np.flatnonzero(own)
            if len(cells):
                yield blobs(shard, cells, own[cells])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for shard, cells, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                total.setdefault(shard, np.zeros(wide, np.int64))[unpack_cells(cells)] += from_planes(n)
        for shard, own in total.items():
            cells = np.flatnonzero(own)
            yield blobs(shard, cells, np.minimum(own[cells], 2**32 - 1))

    schema = "shard int, cells binary, n binary"
    return texts.select("text").mapInArrow(count, schema).repartition("shard").mapInArrow(merge, schema)


@dataclass
class LogBilinear:
    r1: np.ndarray
    r2: np.ndarray
    q: np.ndarray
    b: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.r1, self.r2, self.q, self.b]

    def log_probabilities(self) -> np.ndarray:
        """Natural logarithms for each context pair (rows) and target class, normalised."""
        contexts = (self.r1[:, None, :] + self.r2[None, :, :]).reshape(-1, self.q.shape[1])
        out = contexts @ self.q.T
        out += self.b
        out -= out.max(axis=1, keepdims=True)
        out -= np.log(np.exp(out).sum(axis=1, keepdims=True))
        return out


def nce_train(counts: np.ndarray, unigram: np.ndarray, dim: int = DIM, passes: int = PASSES, rate: float = 0.2, seed: int = 5) -> LogBilinear:
    """Train on counts[first word, second word, target] against noise from the unigram shares.

    Each step takes a block of first words with all their counts. The noise term is its expectation over
    NOISE draws a token instead of draws, so a step is a few matrix products and the result is the same
    on every run.
    """
    rng = np.random.default_rng(seed)
    firsts, seconds, targets = counts.shape
    small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    model = LogBilinear(small(firsts, dim), small(seconds, dim), small(targets, dim), np.log(unigram).astype(np.float32))
    squares = [np.full(x.shape, 1e-3, np.float32) for x in model.parts()]
    log_kq = np.log(NOISE * unigram).astype(np.float32)
    kq = (NOISE * unigram).astype(np.float32)
    held = np.flatnonzero(counts.sum(axis=(1, 2)))
    for turn in range(passes):
        for block in np.array_split(rng.permutation(held), max(1, len(held) // 8)):
            own = counts[block].reshape(-1, targets)
            tokens = own.sum(axis=1, keepdims=True)
            h = (model.r1[block][:, None, :] + model.r2[None, :, :]).reshape(-1, dim)
            true = 1 / (1 + np.exp(-np.clip(h @ model.q.T + model.b - log_kq, -30, 30)))
            grad = (own * (1 - true) - tokens * kq * true) / max(float(tokens.sum()), 1.0)
            by_h = (grad @ model.q).reshape(len(block), seconds, dim)
            steps = (by_h.sum(axis=1), by_h.sum(axis=0), grad.T @ h, grad.sum(axis=0))
            for array, square, at, g in zip(model.parts(), squares, (block, slice(None), slice(None), slice(None)), steps, strict=True):
                square[at] += g * g
                array[at] += rate * g / np.sqrt(square[at])
    return model


def train(counts: DataFrame, classes: Classes, unigram: np.ndarray) -> LogBilinear:
    """``counts``: the table of context_counts, of a size that doesn't depend on the input; ``unigram``: token counts of the target classes."""
    share = (unigram + 0.5) / (unigram + 0.5).sum()
    shape = (classes.firsts, classes.seconds, classes.targets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(int(np.prod(shape)), np.float32)
        for batch in batches:
            for shard, cells, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                total[unpack_cells(cells) * SHARDS + shard] = from_planes(n)
        model = nce_train(total.reshape(shape), share)
        yield pa.RecordBatch.from_arrays([pa.array([x.astype("<f4").tobytes()], pa.binary()) for x in model.parts()], names=["r1", "r2", "q", "b"])

    row = counts.coalesce(1).mapInArrow(run, "r1 binary, r2 binary, q binary, b binary").first()
    return LogBilinear(*(np.frombuffer(x, "<f4").reshape(-1, DIM) for x in row[:3]), np.frombuffer(row[3], "<f4"))


@dataclass
class Scorer:
    classes: Classes
    model: LogBilinear
    discount: np.ndarray  # of each bucket
    tokens: np.ndarray  # training tokens in each bucket
    unknown: np.ndarray  # probability of an unknown word in each bucket
    total: int  # N
    types: int  # V
    ends: int

    def __post_init__(self):
        self._table = None

    def table(self) -> np.ndarray:
        if self._table is None:
            self._table = self.model.log_probabilities().astype(np.float32)
        return self._table

    def __getstate__(self):
        return self.__dict__ | {"_table": None}


SCORED = "doc_id long, key long, hash long, bucket int, n_tokens long, n_known long, base double, score double"


def _partial_scores(rows: DataFrame, scorer: Scorer) -> DataFrame:
    """A row per text with what its frequent words give, and a row for each other word."""
    shared = rows.sparkSession.sparkContext.broadcast(scorer)  # bounded by HOT and the model's size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, table = shared.value, shared.value.table()
        norm = np.log10(s.total + 0.5 * (s.types + 1))
        hot_base = np.append(np.log10(s.classes.n + 0.5) - norm, np.log10(s.ends + 0.5) - norm)
        inside = np.log10(np.maximum(s.classes.n - s.discount[s.classes.bucket], 1e-9) / np.maximum(s.tokens[s.classes.bucket], 1e-9))
        inside = np.append(np.where(s.classes.target < TARGETS, 0.0, inside), 0.0)
        for batch in batches:
            ids, keys = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            for a, hashes, buckets, first in _tokens(batch.column(2)):
                place, target, pair, row = s.classes.sequences(hashes, buckets, first)
                score = table[pair, target].astype(np.float64) / np.log(10)
                known = place != -1
                at = np.where(place == -2, len(inside) - 1, place)
                score[known] += inside[at[known]]
                base = np.where(known, hot_base[at], 0.0)
                known &= (place != -2) | (s.ends > 0)
                n = len(first) - 1
                sums = [np.bincount(row, w, minlength=n) for w in (known.astype(float), base, score)]
                rare = np.flatnonzero(place[place != -2] == -1)
                of = row[place == -1]
                own_ids, own_keys = pa.array(ids[a : a + n], pa.int64(), from_pandas=True), keys[a : a + n]
                none = pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays([own_ids, pa.array(own_keys, pa.int64()), none, pa.nulls(n, pa.int32()), pa.array(np.diff(first) + 1, pa.int64()), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])], names=[x.split()[0] for x in SCORED.split(", ")])
                m = len(rare)
                if m:
                    yield pa.RecordBatch.from_arrays([own_ids.take(pa.array(of)), pa.array(own_keys[of], pa.int64()), pa.array(hashes[rare].view(np.int64)), pa.array(buckets[rare].astype(np.int32)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()), pa.nulls(m, pa.float64())], names=[x.split()[0] for x in SCORED.split(", ")])

    return rows.select("doc_id", "key", "text").mapInArrow(run, SCORED)


def fit(docs: DataFrame) -> tuple[Scorer, DataFrame]:
    """The model and the table of counts (hash, bucket, n), from texts whose crc32(doc_id as text) mod 5 is not 1."""
    spark = docs.sparkSession
    training = docs.filter(crc32_mod("doc_id", 5) != 1).select(F.col("text").cast("string").alias("text"))
    counts = saved(word_counts(training), "counts")
    classes = frequent(counts)
    top = pd.DataFrame({"hash": classes.hashes[classes.target < TARGETS].view(np.int64)}) if len(classes.hashes) else pd.DataFrame({"hash": np.empty(0, np.int64)})
    inner = counts.filter("bucket >= 0").join(F.broadcast(spark.createDataFrame(top, "hash long")), "hash", "left_anti")  # at most TARGETS rows
    by_bucket = inner.groupBy("bucket").agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("types"), F.sum((F.col("n") == 1).cast("long")).alias("once"), F.sum((F.col("n") == 2).cast("long")).alias("twice")).toPandas().set_index("bucket").reindex(range(BUCKETS), fill_value=0).astype(float)
    total, types, ends = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.col("bucket") == -1, F.col("n"))), F.lit(0))).first()
    discount = ((by_bucket.once + 0.5) / (by_bucket.once + 2 * by_bucket.twice + 1)).clip(0.1, 0.95).to_numpy()
    tokens = by_bucket.tokens.to_numpy()
    unknown = np.where(tokens > 0, discount * by_bucket.types.to_numpy() / np.maximum(tokens, 1), 1.0)
    unigram = np.zeros(classes.targets)
    np.add.at(unigram, classes.target, classes.n * (classes.target < TARGETS))
    unigram[TARGETS : TARGETS + BUCKETS] = tokens
    unigram[-1] = ends
    model = train(saved(context_counts(training, classes), "contexts"), classes, unigram)
    return Scorer(classes, model, discount, tokens, unknown, int(total), int(types), int(ends)), counts


def scores(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scorer, counts = fit(rows)
    spark = docs.sparkSession
    partial = saved(_partial_scores(rows.withColumn("key", F.xxhash64("doc_id", "text")), scorer), "scores")
    shapes_of = spark.createDataFrame([(i, float(d), float(t), float(u)) for i, (d, t, u) in enumerate(zip(scorer.discount, scorer.tokens, scorer.unknown, strict=True))], "bucket int, discount double, tokens double, unknown double")
    rare = partial.filter("hash is not null").select("doc_id", "key", "hash", "bucket").join(counts.select("hash", "n"), "hash", "left").join(F.broadcast(shapes_of), "bucket")
    norm = float(np.log10(scorer.total + 0.5 * (scorer.types + 1)))
    n = F.coalesce("n", F.lit(0))
    rare = rare.select(
        "doc_id", "key", F.lit(0).alias("rows"), F.lit(0).alias("n_tokens"), (n > 0).cast("long").alias("n_known"),
        (F.log10(n + 0.5) - norm).alias("base"),
        F.log10(F.when(n > 0, (n - F.col("discount")) / F.col("tokens")).otherwise(F.col("unknown"))).alias("score"),
    )
    main = partial.filter("hash is null").select("doc_id", "key", F.lit(1).alias("rows"), "n_tokens", "n_known", "base", "score")
    added = main.unionByName(rare).groupBy("doc_id", "key").agg(*(F.sum(c).alias(c) for c in ("rows", "n_tokens", "n_known", "base", "score")))
    each = added.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    whole = lambda c: F.expr(f"{c} div rows").alias(c)  # noqa: E731  equal rows have equal sums
    return each.select("doc_id", (crc32_mod("doc_id", 5) == 1).alias("held_out"), whole("n_tokens"), whole("n_known"), F.lit(scorer.total).cast("long").alias("train_tokens"), (F.col("base") / F.col("rows")).alias("base_score"), (F.col("score") / F.col("rows")).alias("score"))
