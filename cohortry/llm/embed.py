"""Near-duplicate embeddings by spherical-cap filters of structured random product codes.

After a random rotation, one of ``ROTATIONS``, a vector is split in two halves; a filter is a pair of code words, one of each
half's random code, and a unit vector passes it if the halves' products with the two code words sum to
``alpha`` or more. The passing filters are listed from the two sorted score lists, without a look at the
others. Vectors meet in the filters that they share, and every pair there is verified by its cosine in
double precision; a pair counts in the smallest filter that both pass. The number of filters follows the
number of vectors, and ``alpha`` is set so that a pair at the threshold shares ``SHARED`` filters on average.

Equal vectors are one node with a count. A filter with many vectors is dealt into tiles of pairs of parts, so no
task holds more than two parts. Tiles return counts of links and a spanning forest, not pairs.

Defined results: vectors that are null, empty or zero or hold null or non-finite numbers link with nothing;
vectors of different lengths don't link; rows with equal ids stay apart; a null id is never the name of
others' component.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import erfc, sqrt
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, saved
from .graph import components

ROTATIONS, SHARED, PART, IN_FILTER, LIFTED = 8, 8.0, 512, 300, 64


def share_passing(alpha: float, cosine: float) -> float:
    """Of vectors at this cosine to one that passes a filter, the share that passes too."""
    x = alpha + np.linspace(0, 6, 2001)
    density = np.exp(-x * x / 2)
    tail = np.array([0.5 * erfc((alpha - cosine * v) / sqrt(2 * (1 - cosine * cosine))) for v in x])
    return float((density * tail).sum() / density.sum())


def plan(n: int, cosine: float) -> tuple[int, float]:
    """Code words of each half, and alpha, for n vectors."""
    words = 16
    while True:
        low, high = 0.0, 6.0
        for _ in range(40):
            alpha = (low + high) / 2
            many = words * words * (1 - NormalDist().cdf(alpha)) * share_passing(alpha, cosine) > SHARED / ROTATIONS
            low, high = (alpha, high) if many else (low, alpha)
        if n * (1 - NormalDist().cdf(low)) <= IN_FILTER or words >= 4096:
            return words, low
        words *= 2


def codes(d: int, words: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotation, and the code of each half. Vectors of few dimensions are rotated into ``LIFTED``, where filters depend less on each other; products stay."""
    rng, wide = np.random.default_rng(seed), max(d, LIFTED)
    rotation = np.linalg.qr(rng.standard_normal((wide, wide)))[0][:d]
    return rotation, rng.standard_normal((wide // 2, words)), rng.standard_normal((wide - wide // 2, words))


def decode(one: np.ndarray, two: np.ndarray, alpha: float) -> np.ndarray:
    """Numbers of all filters whose two scores sum to alpha or more, ascending."""
    order = np.argsort(-two)
    below = -two[order]
    first = np.flatnonzero(one >= alpha + below[0])
    n = np.searchsorted(below, one[first] - alpha, side="right")
    starts = np.repeat(np.cumsum(n) - n, n)
    return np.sort(np.repeat(first, n) * len(two) + order[np.arange(n.sum()) - starts])


def all_filters(x: np.ndarray, words: int, alpha: float, rotated: list) -> list[np.ndarray]:
    """Numbers of the filters that each unit vector passes, over all rotations, ascending."""
    half, out = rotated[0][0].shape[1] // 2, []
    for k, (rotation, one, two) in enumerate(rotated):
        y = x @ rotation
        s, t = y[:, :half] @ one, y[:, half:] @ two
        out.append([decode(u, v, alpha) + k * words * words for u, v in zip(s, t, strict=True)])
    return [np.concatenate(own) for own in zip(*out, strict=True)]


def _units(blobs: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(blobs), kind).reshape(len(blobs), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _clean(rows: DataFrame, kind: str) -> DataFrame:
    """(vec_id, vector): its bytes, null where it links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column(1).to_pylist():
                x = np.array(v, kind) if v and None not in v else np.empty(0)
                good = len(x) and np.isfinite(x).all() and (x != 0).any()
                out.append((x + 0.0).astype(kind).tobytes() if good else None)  # -0 is 0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["vec_id", "vector"])

    return rows.mapInArrow(run, "vec_id long, vector binary")


def _filters(nodes: DataFrame, d: int, kind: str, words: int, alpha: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rotated = [codes(d, words, seed) for seed in range(ROTATIONS)]
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                found = all_filters(_units(part.column(2).to_pylist(), kind), words, alpha, rotated)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.list_(pa.int32()))], names=["node", "copies", "vector", "filters"])

    return nodes.select("node", "copies", "vector").mapInArrow(run, "node long, copies long, vector binary, filters array<int>")


def _tile(kind: str, cosine: float):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        part = group.column("part").to_numpy()
        p, q = group.column("p")[0].as_py(), group.column("q")[0].as_py()
        node, copies = group.column("node").to_numpy(), group.column("copies").to_numpy().astype(float)
        x = _units(group.column("vector").to_pylist(), kind)
        filters = group.column("smaller").combine_chunks()
        row = np.repeat(np.arange(len(node)), np.diff(filters.offsets.to_numpy()))
        number = filters.values.to_numpy()[filters.offsets[0].as_py() : filters.offsets[-1].as_py()]
        names, column = np.unique(number, return_inverse=True)
        passed = np.zeros((len(node), len(names)), np.float32)
        passed[row, column] = 1
        link = (x @ x.T >= cosine) & (passed @ passed.T == 0)
        np.fill_diagonal(link, False)
        if p != q:
            link &= part[:, None] != part[None, :]
        counts = link @ copies
        label = np.arange(len(node))
        while True:
            least = np.minimum(label, np.where(link, label[None, :], len(node)).min(axis=1, initial=len(node)))
            least = least[least]
            if (least == label).all():
                break
            label = least
        hit = np.flatnonzero(counts)
        return pa.table({"node": node[hit], "links": counts[hit].astype(np.int64), "root": node[label[hit]]})

    return run


def _links(nodes: DataFrame, d: int, kind: str, cosine: float) -> DataFrame:
    """(node, links, root) of one tile each: how many rows its node links with, and a node reached."""
    words, alpha = plan(nodes.count(), cosine)
    listed = saved(_filters(nodes, d, kind, words, alpha), "filters")
    each = listed.select("*", F.posexplode("filters").alias("pos", "filter")).withColumn("smaller", F.slice("filters", F.lit(1), F.col("pos"))).drop("filters", "pos")  # a tile needs the filters before its own
    sizes = saved(listed.select(F.explode("filters").alias("filter")).groupBy("filter").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("filter", F.ceil(F.col("n") / PART).cast("int").alias("parts")), "sizes")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    dealt = each.join(sizes, "filter").withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tiles = dealt.select("filter", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "part", "node", "copies", "vector", "smaller")
    return tiles.groupBy("filter", "p", "q").applyInArrow(_tile(kind, cosine), "node long, links long, root long")


def near_duplicates(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    element = vectors.schema["embedding"].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    rows = saved(_clean(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>" if kind == "<f4" else "array<double>")), kind).withColumn("node", F.xxhash64("vector", F.lit(3))), "vectors")
    good = rows.filter(F.col("vector").isNotNull())
    nodes = saved(good.groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"), F.min("vec_id").alias("least")), "nodes")
    width = F.octet_length("vector") / int(kind[2])
    found = None
    for (d,) in nodes.select(width.cast("int")).distinct().collect():  # the lengths of vectors that occur
        own = _links(nodes.filter(width == d), d, kind, cosine)
        found = own if found is None else found.unionByName(own)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    found = saved(found, "tiles")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = saved(nodes.select("node", "copies", "least").join(groups, "node", "left").join(counts, "node", "left").withColumn("group", F.coalesce("component", "node")), "named")
    smallest = saved(named.groupBy("group").agg(F.min("least").alias("component_id")), "smallest")  # so that Spark can split the joins' largest partitions
    answers = saved(named.join(smallest, "group").select("node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "answers")
    linked = good.join(answers, "node").select("vec_id", "n_links", "component_id")
    alone = rows.filter(F.col("vector").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = saved(linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))), "joined")
    discard(rows, nodes, found, named, smallest, answers)
    return out
