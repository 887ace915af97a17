"""Document fingerprints from prefix polynomial hashes.

With H[i] = sum of s[j] * b**j for j < i, modulo 2**31 - 1 and for two bases b, the hash of any span is
(H[j] - H[i]) / b**i, so equal spans have equal hashes wherever they stand, and the longest common
extension of two places is found by binary search on the length.

A fingerprint holds the length, the hash of the whole text, the hashes of up to ``GRID`` prefixes at
multiples of a power of two, and the smallest ``SKETCH`` mixed hashes of all spans of ``SPAN`` code
points. Two fingerprints are as alike as the larger of: their longest common prefix on the shared
grid (binary search) over the longer length, and the estimated Jaccard likeness of their span sets.

A document's edited text ends in the first part of the next document in descending doc_id. Documents are
dealt into ranges of doc_id; the first row of each range also goes to the range before, and tasks
stream over their sorted rows.

Defined results: a null text is empty; null ids come last; rows with equal ids follow each other by
text; a single row is its own next one; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions
from .words import mix

P = (1 << 31) - 1
BASES = (1_186_338_991, 771_645_347)
GRID, SKETCH, SPAN = 64, 32, 24
MOST_RANGES = 100_000
_P, _SHIFT = np.uint64(P), np.uint64(31)
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _reduce(x: np.ndarray) -> np.ndarray:
    """x modulo 2**31 - 1, for uint64 below 2**63; x itself is used as working space."""
    for _ in range(2):
        high = x >> _SHIFT
        x &= _P
        x += high
    x[x >= _P] -= _P
    return x


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo P for i < n."""
    have = _tables.get(base)
    if have is None or len(have[0]) < n:
        have = tuple(_grown(b, 1 << max(12, int(n - 1).bit_length())) for b in (base, pow(base, -1, P)))
        if n <= 1 << 20:  # keep no tables for a rare giant text
            _tables[base] = have
    return have


def _grown(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, _reduce(out * np.uint64(pow(base, len(out), P)))])
    return out[:n]


class Prefix:
    """Prefix arrays of a text, for both bases."""

    def __init__(self, text: str, head: Prefix | None = None, keep: int = 0):
        """With ``head``, the text follows the first ``keep`` code points of head's."""
        own = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
        self.n = keep + len(own)
        self.sums = []
        for k, base in enumerate(BASES):
            up = _powers(base, self.n + 1)[0]
            sums = np.empty(self.n + 1, np.uint64)
            if head is None:
                sums[0] = 0
            else:
                sums[: keep + 1] = head.sums[k][: keep + 1]
            tail = sums[keep + 1 :]
            steps = own * up[keep : self.n]
            np.cumsum((steps & _P) + (steps >> _SHIFT), out=tail)
            tail += sums[keep]
            _reduce(tail)
            self.sums.append(sums)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of under 62 bits for each span."""
        both = []
        for base, sums in zip(BASES, self.sums, strict=True):
            down = _powers(base, self.n + 1)[1]
            both.append(_reduce((sums[ends] + _P - sums[starts]) * down[starts]))
        return (both[0] << np.uint64(31)) | both[1]

    def windows(self, size: int, head: np.ndarray | None = None) -> np.ndarray:
        """A 31-bit hash of each span of ``size`` code points; ``head`` has the first ones already."""
        done, n = 0 if head is None else len(head), self.n - size + 1
        if n <= done:
            return np.empty(0, np.uint64) if head is None else head[: max(n, 0)]
        sums = self.sums[0]
        own = sums[done + size :] + _P
        own -= sums[done:n]
        own *= _powers(BASES[0], self.n + 1)[1][done:n]
        own = mix(_reduce(own)) >> np.uint64(32)
        return own if head is None else np.concatenate([head, own])

    def common(self, i: int, other: Prefix, j: int) -> int:
        """Length of the longest common extension of place i here and place j of ``other``."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            mid = (low + high + 1) // 2
            if self.spans(np.array([i]), np.array([i + mid]))[0] == other.spans(np.array([j]), np.array([j + mid]))[0]:
                low = mid
            else:
                high = mid - 1
        return low


def fingerprint(p: Prefix, windows: np.ndarray | None = None) -> str:
    """``windows``: those of p, if at hand."""
    whole = int(p.spans(np.array([0]), np.array([p.n]))[0])
    step = 1
    while p.n > GRID * step:
        step *= 2
    places = np.arange(step, p.n + 1, step)
    grid = mix((p.sums[0][places] << _SHIFT) | p.sums[1][places]) >> np.uint64(32)
    spans = p.windows(SPAN) if windows is None else windows
    if not len(spans):
        spans = mix(np.array([whole], np.uint64)) >> np.uint64(32)
    return f"{p.n:x}.{whole:016x}.{grid.astype('>u4').tobytes().hex()}.{_smallest(spans).astype('>u4').tobytes().hex()}"


def _smallest(values: np.ndarray) -> np.ndarray:
    some = 4 * SKETCH
    if len(values) > some:
        least = np.unique(np.partition(values, some - 1)[:some])
        if len(least) >= SKETCH:
            return least[:SKETCH]
    return np.unique(values)[:SKETCH]


def likeness(a: str, b: str) -> float:
    """0 to 1; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    (n, _, grid_a, sketch_a), (m, _, grid_b, sketch_b) = a.split("."), b.split(".")
    n, m = int(n, 16), int(m, 16)
    step_a, step_b = (next(1 << i for i in range(64) if x <= GRID << i) for x in (n, m))
    step = max(step_a, step_b)
    low, high = 0, min(n, m) // step
    while low < high:
        mid = (low + high + 1) // 2
        i, j = 8 * (mid * step // step_a), 8 * (mid * step // step_b)
        low, high = (mid, high) if grid_a[i - 8 : i] == grid_b[j - 8 : j] else (low, mid - 1)
    own, other = ({x[i : i + 8] for i in range(0, len(x), 8)} for x in (sketch_a, sketch_b))
    both = own & other
    union = sorted(own | other)[:SKETCH] if both else own
    return max(low * step / max(n, m), sum(x in both for x in union) / len(union))


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _row(doc_id, text: str, prefix: Prefix, windows: np.ndarray, own: str, next_text: str, next_print: str) -> tuple:
    n = len(text)
    keep = n - n // 3
    tail = next_text[: n // 3]
    changed = Prefix(tail, prefix, keep)
    edited = fingerprint(changed, changed.windows(SPAN, windows[: max(keep - SPAN + 1, 0)]))
    return doc_id, n, hashlib.sha256((text[:keep] + tail).encode("utf-8", "surrogatepass")).hexdigest(), own, edited, likeness(own, edited), likeness(own, next_print)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range and descending id; a row with ``edge`` ends its range."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    waiting = None
    for batch in batches:
        out = []
        for edge, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            prefix = Prefix(text)
            windows = prefix.windows(SPAN)
            own = fingerprint(prefix, windows)
            if waiting is not None:
                out.append(_row(*waiting, text, own))
            waiting = None if edge else (doc_id, text, prefix, windows, own)
        if out:
            columns = list(zip(*out, strict=True))
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    tasks = shuffle_partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ranges = min(4 * tasks, MOST_RANGES)
    cuts = np.unique(np.array(rows.select("doc_id").approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.25 / ranges)))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        at = len(cuts) - np.searchsorted(cuts, ids.fillna(0).to_numpy(), side="right")
        return pd.Series(np.where(ids.isna(), len(cuts) + 1, at))

    dealt = rows.withColumn("range", range_of("doc_id"))
    firsts = rows.select("doc_id").withColumn("range", range_of("doc_id")).groupBy("range").agg(F.max("doc_id").alias("first")).orderBy("range").toPandas()  # a row per range
    if firsts.empty:
        return spark.createDataFrame([], SCHEMA)
    firsts["before"] = np.roll(firsts["range"], 1)
    edges = spark.createDataFrame([(int(r), None if pd.isna(f) else int(f), int(b)) for r, f, b in firsts[["range", "first", "before"]].itertuples(index=False)], "of int, first long, before int")
    heads = rows.join(F.broadcast(edges), F.col("doc_id").eqNullSafe(F.col("first"))).groupBy("before", "doc_id").agg(F.min("text").alias("text"))
    every = dealt.select("range", F.lit(0).alias("edge"), "doc_id", "text").unionByName(heads.select(F.col("before").alias("range"), F.lit(1).alias("edge"), "doc_id", "text"))
    ordered = every.repartition(tasks, "range").sortWithinPartitions("range", "edge", F.desc_nulls_last("doc_id"), "text")
    return ordered.select("edge", "doc_id", "text").mapInArrow(_stream, SCHEMA)
