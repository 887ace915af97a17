"""Toxicity scores by the nearest labelled examples under exact TF-IDF cosine.

Terms are all lower-cased words of the examples, and beginnings of five bytes of their longer words. A term's weight is
its idf, from document frequencies over all documents, times how surely it goes with the label in
the examples (never 0, so no term is left out). The examples, a bounded sample of labelled rows, stand in an
inverted index. Lists of rare terms are read whole; those of frequent terms are cut into
blocks of examples, and a block's largest weight per term bounds what they can add to the cosines of
its examples. A block is read for a text only if it can hold a nearer example than those found, so the neighbours
are exact (cosines count to five decimals; of equal ones the lower place wins). Examples with equal vectors are one
entry with counts. Neighbours vote with weights that fall with distance; a logistic curve through
leave-one-out votes of the examples turns votes into probabilities.

Defined results: a null or empty text, and any text without a term of the examples, is scored like the examples without a
term; without labelled examples every score is 0; repeated label rows count once, toxic if one is; ids, source,
language and labels of a scored row are never read. Rows with equal ids are scored each on its own. Terms are told
apart by 64-bit hashes, and words that no example holds don't count in a text's length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, crc32_mod, discard, saved, slices
from .words import mix, word_hashes, word_spans

EXAMPLES = 4_000
NEIGHBOURS = 25
BLOCK = 64
WAVE = 4  # blocks read between two looks at the bounds
TEXTS = 128  # texts searched at once
FEW = 8  # texts whose rare terms' lists are added up at once
FREQUENT = 16  # a term in more than a 16th of the entries is frequent


BEGINNING = 5
_LETTERS = np.array([(c + 32 if 65 <= c <= 90 else c) if chr(c).isalnum() or c > 127 else 32 for c in range(256)], np.uint8)
_MARK = np.uint64(0x5851F42D4C957F2D)


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of some texts, repeated ones too, and the text each stands in.

    Words are lower-cased runs of ASCII letters and digits and of characters outside ASCII.
    """
    data = _LETTERS[data]
    starts, ends, first = word_spans(data, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    longer = ends - starts > BEGINNING
    begun = word_hashes(data, starts[longer], starts[longer] + BEGINNING, False)
    return np.concatenate([word_hashes(data, starts, ends, False), mix(begun + _MARK)]), np.concatenate([text, text[longer]])


@dataclass
class Bags:
    """Texts as rows of (term, count), terms rising: row i is ``terms[at[i]:at[i + 1]]``."""

    at: np.ndarray
    terms: np.ndarray
    counts: np.ndarray

    def part(self, a: int, b: int) -> Bags:
        s = slice(self.at[a], self.at[b])
        return Bags(self.at[a : b + 1] - self.at[a], self.terms[s], self.counts[s])


def bags(data: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray) -> Bags:
    """The terms of the sorted ``vocabulary`` in each text."""
    n = len(offsets) - 1
    hashes, text = term_hashes(data, offsets)
    if not len(hashes) or not len(vocabulary):
        return Bags(np.zeros(n + 1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))
    own, which = np.unique(hashes, return_inverse=True)
    place = np.searchsorted(vocabulary, own)
    place[place == len(vocabulary)] = 0
    place = np.where(vocabulary[place] == own, place, -1)[which]
    known = place >= 0
    keys, counts = np.unique(text[known] * len(vocabulary) + place[known], return_counts=True)
    at = np.searchsorted(keys, np.arange(n + 1) * len(vocabulary))
    return Bags(at, keys % len(vocabulary), counts)


class BlockMaxIndex:
    """Entries as unit vectors; ``tops[t]`` has the largest weight of the frequent term t in each block."""

    def __init__(self, at: np.ndarray, terms: np.ndarray, weights: np.ndarray, n_terms: int, block: int = BLOCK):
        self.block, self.entries = block, len(at) - 1
        self.blocks = max(-(-self.entries // block), 1)
        order = np.argsort(terms, kind="stable")
        entry = np.repeat(np.arange(self.entries), np.diff(at))[order].astype(np.int32)
        self.size = np.bincount(terms, minlength=n_terms)
        frequent = np.flatnonzero(self.size * FREQUENT > self.entries)
        self.slot = np.full(n_terms, -1, np.int32)
        self.slot[frequent] = np.arange(len(frequent))
        slot, weight = self.slot[terms[order]], weights[order].astype(np.float32)
        dense = np.zeros((len(frequent), self.blocks * block), np.float32)
        dense[slot[slot >= 0], entry[slot >= 0]] = weight[slot >= 0]
        self.dense = np.ascontiguousarray(dense.reshape(len(frequent), self.blocks, block).transpose(1, 0, 2))
        self.tops = self.dense.max(axis=2).T.copy() if len(frequent) else np.zeros((0, self.blocks), np.float32)
        self.entry, self.weight = entry[slot < 0], weight[slot < 0]
        self.size[frequent] = 0
        self.start = np.cumsum(self.size) - self.size

    def nearest(self, at: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """For each row the k entries of largest cosine (ties: the lower place) and these cosines; cosine 0 is no neighbour."""
        n, width = len(at) - 1, self.blocks * self.block
        text, slot = np.repeat(np.arange(n), np.diff(at)), self.slot[terms]
        rare = slot < 0
        known = np.empty((n, self.blocks, self.block), np.float32)
        listed_text, listed_terms, listed_weights = text[rare], terms[rare], weights[rare]
        for a in range(0, n, FEW):
            b = min(a + FEW, n)
            s = slice(*np.searchsorted(listed_text, [a, b]))
            size = self.size[listed_terms[s]]
            which = np.repeat(np.arange(len(size)), size)
            at_list = np.arange(len(which)) + (self.start[listed_terms[s]] - (np.cumsum(size) - size))[which]
            cell = ((listed_text[s] - a) * width)[which] + self.entry[at_list]
            known[a:b] = np.bincount(cell, listed_weights[s][which] * self.weight[at_list], (b - a) * width).reshape(b - a, self.blocks, self.block)
        frequent = np.zeros((n, len(self.tops)), np.float32)
        frequent[text[~rare], slot[~rare]] = weights[~rare]
        bounds = known.max(axis=2) + frequent @ self.tops
        keys = np.zeros((n, self.blocks, self.block), np.int64)
        best, least = np.zeros((n, k), np.int64), np.zeros(n)
        places = width - 1 - np.arange(width).reshape(self.blocks, self.block)
        order = np.argsort(-bounds.max(axis=0), kind="stable")
        for w in range(0, self.blocks, WAVE):
            wave = order[w : w + WAVE]
            open_ = (bounds[:, wave] > 0) & (bounds[:, wave] >= least[:, None] - 2e-5)
            for j, b in enumerate(wave.tolist()):
                rows = np.flatnonzero(open_[:, j])
                if len(rows):
                    cosine = np.rint((known[rows, b] + frequent[rows] @ self.dense[b]) * 1e5).astype(np.int64)
                    keys[rows, b] = np.where(cosine > 0, cosine * width + places[b], 0)
            rows = np.flatnonzero(open_.any(axis=1))
            if len(rows):
                both = np.concatenate([best[rows], keys[np.ix_(rows, wave)].reshape(len(rows), -1)], axis=1)
                best[rows] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
                least[rows] = best[rows].min(axis=1) // width / 1e5
        best = -np.sort(-best, axis=1)
        return np.where(best > 0, width - 1 - best % width, -1), best // width / 1e5


NO_ENTRIES = Bags(np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))
NO_TERM = Bags(np.zeros(2, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))  # one text


@dataclass
class ToxicityModel:
    vocabulary: np.ndarray  # hashes of the terms, rising
    term_weights: np.ndarray
    entries: Bags  # different examples with a term
    rows: np.ndarray  # examples of each entry
    toxic: np.ndarray  # toxic ones of these
    ids: np.ndarray  # an example's id of each entry
    zero: tuple[int, int]  # rows and toxic rows of the examples without a term
    prior: float
    curve: tuple[float, float] = (0.0, 1.0)
    k: int = NEIGHBOURS

    @cached_property
    def index(self) -> BlockMaxIndex | None:
        """Built where it is first searched, and not sent."""
        return BlockMaxIndex(self.entries.at, self.entries.terms, self.weigh(self.entries), len(self.vocabulary)) if len(self.rows) else None

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "index"}

    def weigh(self, rows: Bags) -> np.ndarray:
        w = (1 + np.log(rows.counts)) * self.term_weights[rows.terms]
        text = np.repeat(np.arange(len(rows.at) - 1), np.diff(rows.at))
        return w / np.sqrt(np.bincount(text, w * w, len(rows.at) - 1))[text]

    def votes(self, rows: Bags, own: np.ndarray | None = None, label: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log-odds of the weighted votes, and the voters' entries (-1: none) and cosines; ``own``: each row's entry, of which one row of ``label`` is left out."""
        n = len(rows.at) - 1
        y = np.full(n, float(self.zero[1] - label * (own is not None)))
        total = np.full(n, float(self.zero[0] - (own is not None)))
        found, cosines = np.full((n, self.k), -1), np.zeros((n, self.k))
        some = np.flatnonzero(np.diff(rows.at))
        if self.index is not None and len(some):
            at = np.concatenate([[0], rows.at[some + 1]])
            near, c = self.index.nearest(at, rows.terms, self.weigh(rows), self.k)
            there = near >= 0
            n_rows, n_toxic = np.where(there, self.rows[near], 0).astype(float), np.where(there, self.toxic[near], 0).astype(float)
            if own is not None:
                mine = near == own[some][:, None]
                n_rows -= mine
                n_toxic -= mine * label
            w = c**2 / np.maximum(1.02 - c, 0.02) * np.log1p(n_rows) / np.maximum(n_rows, 1)
            y[some], total[some], found[some], cosines[some] = (w * n_toxic).sum(axis=1), (w * n_rows).sum(axis=1), near, c
        p = np.clip((y + self.prior) / (total + 1), 1e-12, 1 - 1e-12)
        return np.log(p) - np.log1p(-p), found, cosines

    def scores(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Scores, voters' entries and cosines of runs of texts."""
        a, b = self.curve
        for _, _, data, offsets in slices(texts):
            rows = bags(data, offsets, self.vocabulary)
            for i in range(0, len(offsets) - 1, TEXTS):
                odds, found, cosines = self.votes(rows.part(i, min(i + TEXTS, len(offsets) - 1)))
                yield 1 / (1 + np.exp(-(a + b * odds))) if len(self.rows) or self.zero[0] else np.zeros(len(odds)), found, cosines


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a logistic curve by Newton's steps with a little shrinkage towards (0, 1)."""
    w, X, start = np.array([0.0, 1.0]), np.stack([np.ones_like(x), x], 1), np.array([0.0, 1.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(X @ w, -30, 30)))
        step = np.linalg.solve((X * (n * p * (1 - p))[:, None]).T @ X + np.eye(2), X.T @ (y - n * p) - (w - start))
        w = w + np.clip(step, -2, 2)
    return (float(w[0]), float(w[1])) if w[1] > 0 else (0.0, 1.0)


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def _term_counts(sample: DataFrame) -> DataFrame:
    """Examples, and toxic ones, that hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(1).to_numpy(zero_copy_only=False)
            for a, _, data, offsets in slices(batch.column(0)):
                hashes, text = term_hashes(data, offsets)
                order = np.lexsort((text, hashes))
                hashes, text = hashes[order], text[order]
                new = np.ones(len(hashes), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
                own, which = np.unique(hashes[new], return_inverse=True)
                bad = np.bincount(which, labels[a + text[new]] > 0, len(own)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([_signed(own), pa.array(np.bincount(which, minlength=len(own)).astype(np.int64)), pa.array(bad)], names=["term", "n", "n_toxic"])

    return sample.select("text", "toxic").mapInArrow(run, "term long, n long, n_toxic long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic"))


def _document_frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[int, np.ndarray]:
    """Rows, and rows that hold each term, over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # terms of the bounded examples

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, counts = 0, np.zeros(len(shared.value), np.int64)
        for batch in batches:
            rows += batch.num_rows
            for _, _, data, offsets in slices(batch.column(0)):
                counts += np.bincount(bags(data, offsets, shared.value).terms, minlength=len(counts))
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"term": np.append(-1, held), "n": np.append(rows, counts[held])})

    got = docs.select(F.col("text").cast("string")).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(vocabulary) + 1, np.int64)
    out[got["term"].to_numpy()] = got["n"].to_numpy()  # -1, all rows, is the last place
    return int(out[-1]), out[:-1].astype(float)


def association(n: np.ndarray, n_toxic: np.ndarray, rows: int, toxic: int) -> np.ndarray:
    """From 0.0004 to about 1: how surely the log-odds of the label differ with the term."""
    a, b = n_toxic + 0.5, n - n_toxic + 0.5
    other_a, other_b = toxic - n_toxic + 0.5, rows - toxic - (n - n_toxic) + 0.5
    z2 = np.log(a * other_b / (b * other_a)) ** 2 / (1 / a + 1 / b + 1 / other_a + 1 / other_b)
    return (0.02 + z2 / (z2 + 20)) ** 2


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> ToxicityModel:
    """Learn from labelled rows whose crc32(doc_id as text) mod 4 is not 2.

    ``examples`` bounds the labelled rows learnt from: those of the smallest hash of their id.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (crc32_mod("doc_id", 4) != 2))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    share = min(1.0, 1.05 * examples / max(usable.count(), 1))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32))
    given = usable.filter(place < int(share * (1 << 32))).orderBy(place, "doc_id").limit(examples)  # a little more than ``examples`` rows are sorted
    sample = saved(rows.join(F.broadcast(given), "doc_id"), "examples")  # at most ``examples`` rows are broadcast
    n, bad = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("toxic") > 0).cast("int")), F.lit(0))).first()
    if not n:
        return ToxicityModel(np.empty(0, np.uint64), np.empty(0), NO_ENTRIES, np.empty(0), np.empty(0), np.empty(0), (0, 0), 0.5)
    counts = _term_counts(sample).toArrow()  # terms of the bounded examples
    hashes = counts["term"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    vocabulary = hashes[order]
    total, df = _document_frequencies(rows, vocabulary)
    strength = association(counts["n"].to_numpy().astype(float)[order], counts["n_toxic"].to_numpy().astype(float)[order], n, bad)
    weights = (np.log((1 + total) / (1 + df)) + 1) * strength
    shared = sample.sparkSession.sparkContext.broadcast(vocabulary)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1)):
                own = bags(data, offsets, shared.value)
                lists = [pa.ListArray.from_arrays(pa.array(own.at.astype(np.int32)), pa.array(v.astype(np.int32))) for v in (own.terms, own.counts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), *lists], names=["doc_id", "toxic", "terms", "counts"])

    got = (
        sample.mapInArrow(vectors, "doc_id long, toxic int, terms array<int>, counts array<int>")
        .groupBy("terms", "counts")
        .agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"), F.sum((F.col("toxic") > 0).cast("int")).alias("toxic"))
        .toArrow()
    )
    discard(sample)
    none = pc.equal(pc.list_value_length(got["terms"]), 0)
    zero = tuple(pc.sum(got.filter(none)[c]).as_py() or 0 for c in ("n", "toxic"))
    got = got.filter(pc.invert(none)).combine_chunks()
    toxic, ids, rows_of = (got[c].to_numpy() for c in ("toxic", "doc_id", "n"))
    got = got.take(np.lexsort((rows_of, ids, toxic == 0)))  # toxic entries share blocks
    at = np.concatenate([[0], np.cumsum(pc.list_value_length(got["terms"]).to_numpy().astype(np.int64))]).astype(np.int64)
    entries = Bags(at, *(got[c].combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("terms", "counts")))
    model = ToxicityModel(vocabulary, weights, entries, got["n"].to_numpy(), got["toxic"].to_numpy(), got["doc_id"].to_numpy(), zero, min(max(bad / n, 0.5 / n), 1 - 0.5 / n))
    votes, y, weight = [], [], []
    if len(got):
        left_out = _leave_one_out(docs.sparkSession, model)
        for label, own_rows in ((1, model.toxic), (0, model.rows - model.toxic)):
            votes, y, weight = [*votes, left_out[label]], [*y, np.full(len(got), label)], [*weight, own_rows]
    for label, zero_rows in ((1, zero[1]), (0, zero[0] - zero[1])):
        if zero_rows:
            votes, y, weight = [*votes, model.votes(NO_TERM, np.array([-2]), label)[0]], [*y, [label]], [*weight, [zero_rows]]
    n_rows = np.concatenate(weight).astype(float)
    used = n_rows > 0
    model.curve = _logistic(np.concatenate(votes)[used], (np.concatenate(y) * n_rows)[used], n_rows[used])
    del got, counts
    pa.default_memory_pool().release_unused()  # to the driver's other work
    return model


def _leave_one_out(spark: SparkSession, model: ToxicityModel) -> np.ndarray:
    """Each entry's votes as one of a clean row (first line) and of a toxic one, without that row. Tasks search the index, which isn't built on the driver."""
    shared, n = spark.sparkContext.broadcast(model), len(model.rows)  # bounded by the parameters of fit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                part = np.arange(i, min(i + TEXTS, n))
                own = [shared.value.votes(shared.value.entries.part(i, i + len(part)), part, label)[0] for label in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(part), *map(pa.array, own)], names=["entry", "clean", "toxic"])

    got = spark.range(0, n, TEXTS).mapInArrow(run, "entry long, clean double, toxic double").toArrow()
    out = np.zeros((2, n))
    out[:, got["entry"].to_numpy()] = got["clean"].to_numpy(), got["toxic"].to_numpy()
    shared.destroy()
    return out


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score and evidence (ids and cosines of the nearest examples) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the parameters of fit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = shared.value.ids
        for batch in batches:
            values, evidence = [], []
            for own, found, cosines in shared.value.scores(batch.column(1)):
                values += own.tolist()
                evidence += [[{"doc_id": int(ids[i]), "cosine": c} for i, c in zip(f, cs, strict=True) if i >= 0] for f, cs in zip(found[:, :5].tolist(), cosines[:, :5].tolist(), strict=True)]
            evidence = pa.array(evidence, pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64()), evidence], names=["doc_id", "score", "evidence"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double, evidence array<struct<doc_id:long,cosine:double>>")


def keep_clean(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """Rows whose score is under ``threshold``, all columns unchanged."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [own < threshold for own, _, _ in shared.value.scores(batch.column(at))]
            yield batch.filter(pa.array(np.concatenate([np.empty(0, bool), *clean]), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def digests(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, evidence."""
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", (crc32_mod("doc_id", 4) == 2).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"), "evidence")
