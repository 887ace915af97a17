"""Exact Jaccard join of word-shingle sets, with skipping by set relations.

Shingles have one global order: rare ones first (by hash), then those that a task saw more than once,
by how often. Two sets of similarity t or more share a shingle among the first |x| - ceil(t |x|) + 1 of each, so
index lists are kept of these only, each sorted by set size with the shingle's position.

Index level: a count-min sketch drops shingles of one set; in a list only the block of sizes that can match is
read, positions bound the overlap, and parities bound the difference of two sets: 512 bits in the lists, then
as many as a set has shingles for the pairs that are left. A pair is given in the first list it meets in, as far as the four
entries before tell, and its number of entries still to come bounds what it can share.
Answer level: equal sets are one node. First each list links each node with the one before it and with the
first, and each node's likeliest pair of these is verified, a pair a node at most; what is found groups nodes, and nodes of one group need no more comparison for their
component. Lists whose nodes lie in one group are then skipped whole; in the others each entry gives its likeliest pair with
another group, which is verified as before, while that links more than a hundredth of the grouped nodes. Only then all pairs across
groups are taken, and of these a pair (x, y) falls away if a set r, highly similar to x with its similarity
known, has a known similarity to y that is too far off: Jaccard distance is a metric. All
others are verified on whole sets. Long lists are dealt into tiles of two parts each. To verify, each text is sent to its pair's
end of more pairs, whose own text is sent once for each ``PER_TASK`` of them.

``join`` gives components only, by these short cuts: links inside a group are not looked for. ``links`` takes none
of them and gives every link between different sets, and with ``members`` which rows have each set.

Defined results: a null or empty text has an empty set and is its own component; a text with fewer words
than a shingle has its whole word sequence as one; rows with equal ids or texts are all returned; a null id
is never the name of a component of others, and alone gives null; very long texts are read whole; other columns, whatever their
names, play no part. Sets are of 63-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, largest, new_names, saved, slices
from .graph import components
from .substring import passing, repeated_cells, sketch_bits
from .words import mix, window_hashes, word_hashes, word_spans

FREQUENT, LONG_LIST = 200_000, 5_000
PER_TASK = 256
LIKELY_TURNS = 2
TOP, TRUE, NONE = np.uint64(1 << 63), np.ones(1, bool), np.empty(0, np.uint64)
PARITY_BITS, PREVIOUS, TILE_ROWS = 512, 4, 20_000
PARITY = [f"b{i}" for i in range(PARITY_BITS // 64)]
BEFORE = [f"before{i}" for i in range(PREVIOUS)]


def shingle_sets(texts: pa.Array, k: int, ranks: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, shingles, offsets per row) of slices of rows; each row's distinct shingles in the global order.

    Shingles are 63-bit hashes. ``ranks``: the frequent ones, from less to more frequent.
    """
    by_hash = rank_of = None
    if ranks is not None and len(ranks):
        rank_of = np.argsort(ranks)
        by_hash = ranks[rank_of]
    for a, _, data, offsets in slices(texts):
        starts, ends, first = word_spans(data, offsets)
        words = word_hashes(data, starts, ends, lower=True)
        order = window_hashes(words, k) >> np.uint64(1)
        if by_hash is not None and len(order):
            at = np.minimum(np.searchsorted(by_hash, order), len(by_hash) - 1)
            order = np.where(by_hash[at] == order, TOP + rank_of[at].astype(np.uint64), order)
        out = []
        for i, j in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if j - i >= k:
                own = np.sort(order[i : j - k + 1])
                out.append(own[np.concatenate([TRUE, own[1:] != own[:-1]])])
            else:
                out.append(window_hashes(words[i:j], j - i) >> np.uint64(1) if j > i else NONE)
        shingles = np.concatenate([NONE, *out])
        often = np.flatnonzero(shingles >= TOP)
        if len(often):
            shingles[often] = ranks[(shingles[often] - TOP).astype(np.int64)]
        yield a, shingles, np.cumsum([0, *map(len, out)])


def _nodes(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A hash of each row's set, of whatever order; 0 for an empty set."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes ^ np.uint64(0xA5A5A5A5)), dtype=np.uint64)])
    sizes = np.diff(offsets).astype(np.uint64)
    return np.where(sizes > 0, mix(sums[offsets[1:]] - sums[offsets[:-1]] + sizes) | np.uint64(1), np.uint64(0)).view(np.int64)


def _parity(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``PARITY_BITS`` bits of each row's set, a bit being the parity of the shingles that fall on it: rows x words of 64 bits."""
    bit, n, out = (mix(hashes) & np.uint64(PARITY_BITS - 1)).astype(np.int64), len(offsets) - 1, []
    for a in range(0, n, 2048):
        b = min(a + 2048, n)
        row = np.repeat(np.arange(b - a), np.diff(offsets[a : b + 1]))
        odd = np.bincount(row * PARITY_BITS + bit[offsets[a] : offsets[b]], minlength=(b - a) * PARITY_BITS) & 1
        out.append(np.packbits(odd.astype(np.uint8).reshape(b - a, PARITY_BITS), axis=1).view(np.int64))
    return np.concatenate(out) if out else np.empty((0, len(PARITY)), np.int64)


def _wide_parity(hashes: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The parity of each row's set in as many bits as its shingles, rounded up to a power of two, 256 at least."""
    bit, out = mix(hashes), []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        size = 1 << max(8, (b - a - 1).bit_length())
        odd = np.bincount((bit[a:b] & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
        out.append(np.packbits(odd.astype(np.uint8), bitorder="little").tobytes())
    return pa.array(out, pa.binary())


def _wide_differ(one: bytes, two: bytes) -> int:
    """In how many bits two parities differ, the longer one folded to the length of the shorter."""
    x, y = (np.frombuffer(b, np.uint64) for b in (one, two))
    size = min(len(x), len(y))
    folded = np.bitwise_xor.reduce(x.reshape(-1, size), axis=0) ^ np.bitwise_xor.reduce(y.reshape(-1, size), axis=0)
    return int(np.bitwise_count(folded).sum())


def _differ(bits_n: np.ndarray, bits_m: np.ndarray) -> np.ndarray:
    """In how many bits two parities differ; for each there is a shingle of one set alone."""
    return np.bitwise_count((bits_n ^ bits_m).view(np.uint64)).sum(axis=-1, dtype=np.int64)


def _may_match(n, m, differ: np.ndarray, percent: int) -> np.ndarray:
    """False where sizes or differing bits rule the similarity out."""
    total = n.astype(np.int64) + m
    return (np.minimum(n, m) * 100 >= np.maximum(n, m) * percent) & (differ <= total - 2 * -(-percent * total // (100 + percent)))


def index_length(n: np.ndarray, percent: int) -> np.ndarray:
    """How many of the first shingles of the smaller set of a pair must be looked at."""
    return n - -(-2 * percent * n // (100 + percent)) + 1


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - -(-n * percent // 100) + 1


def _summaries(docs: DataFrame, k: int) -> DataFrame:
    """Rows (doc_id, print, node, n, parities) of all documents, and with n = -1 (count, shingle) of shingles that a task saw in two."""
    fields = ["doc_id", "print", "node", "n", *PARITY]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held = [*fields, "wide"], []

        def repeated() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            found, n = found[n > 1], n[n > 1]
            return pa.RecordBatch.from_arrays([pa.array(n), pa.nulls(len(n), pa.int64()), pa.array(found.view(np.int64)), pa.array(np.full(len(n), -1)), *(pa.nulls(len(n), pa.int64()) for _ in PARITY), pa.nulls(len(n), pa.binary())], names=names)

        total = 0
        for batch in batches:
            for a, hashes, offsets in shingle_sets(batch.column(1), k):
                n = len(offsets) - 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, n), batch.column(2).slice(a, n), pa.array(_nodes(hashes, offsets)), pa.array(np.diff(offsets)), *(pa.array(x) for x in _parity(hashes, offsets).T.copy()), _wide_parity(hashes, offsets)], names=names)
                held.append(hashes)
                total += len(hashes)
                if total > 1_000_000:
                    yield repeated()
                    total = 0
        if held:
            yield repeated()

    return docs.select("doc_id", "text", "print").mapInArrow(run, ", ".join(f"{c} long" for c in fields) + ", wide binary")


def _postings(docs: DataFrame, ranks: np.ndarray, counts: np.ndarray, copied: tuple[np.ndarray, np.ndarray], expected: int, k: int, percent: int) -> DataFrame:
    """(token, part, node, n, at) of the first shingles of each node that a count-min sketch saw twice; lists of frequent shingles are dealt into parts.

    ``copied``: nodes that many rows have, ascending, and the one id whose row counts; what more copies there are give the same entries again.
    """
    order = np.argsort(ranks)
    send = docs.sparkSession.sparkContext.broadcast
    shared = send((ranks, ranks[order], counts[order], *copied))

    def firsts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        by_rank, _, _, nodes, first = shared.value
        ids = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
        for a, hashes, offsets in shingle_sets(batch.column(1), k, by_rank):
            node, n = _nodes(hashes, offsets), np.diff(offsets)
            use = n > 0
            if len(nodes):
                at = np.minimum(np.searchsorted(nodes, node), len(nodes) - 1)
                use &= (nodes[at] != node) | (first[at] == ids[a : a + len(n)])
            row = np.repeat(np.arange(len(n)), n)
            place = np.arange(len(hashes)) - offsets[row]
            good = np.flatnonzero((place < prefix_length(n, percent)[row]) & use[row])
            yield hashes[good], node[row[good]], n[row[good]], place[good]

    docs, bits = docs.select("doc_id", "text"), sketch_bits(expected)
    seen = send(repeated_cells(docs, lambda batch: (mix(token) for token, *_ in firsts(batch)), bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, by_hash, often, _, _ = shared.value
        maps = [np.frombuffer(x, np.uint8) for x in seen.value]
        for batch in batches:
            for columns in firsts(batch):
                hit = passing(mix(columns[0]), maps, bits)
                token, node, n, place = (x[hit] for x in columns)
                part = np.zeros(len(token), np.int64)
                if len(by_hash) and len(token):
                    at = np.minimum(np.searchsorted(by_hash, token), len(by_hash) - 1)
                    parts = np.where(by_hash[at] == token, often[at] // LONG_LIST + 1, 1)
                    part = (mix(node.view(np.uint64)) % parts.astype(np.uint64)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(part.astype(np.int32)), pa.array(node), pa.array(n.astype(np.int32)), pa.array(place.astype(np.int32))], names=["token", "part", "node", "n", "at"])

    return docs.mapInArrow(run, "token long, part int, node long, n int, at int")


def _shared_lists(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries of lists that hold two nodes or more, and the saved table of these lists."""
    two = saved(lists.groupBy("token").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high").select("token"), "shared")
    return lists.join(two, "token", "left_semi"), two


def _arrays(batch: pa.RecordBatch, names: list[str]) -> list[np.ndarray]:
    """Columns as arrays, the parity as one of rows x words."""
    return [*(batch.column(c).to_numpy() for c in names), np.stack([batch.column(b).to_numpy() for b in PARITY], 1)]


PAIRS = "x long, y long, differ long, size long"


def _pairs(x: np.ndarray, y: np.ndarray, differ: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.stack([np.minimum(x, y), np.maximum(x, y), differ, size], 1).astype(np.int64)


def _pair_batch(found: list[np.ndarray]) -> pa.RecordBatch:
    """Each pair once, with its differing bits and the size of the larger set."""
    pairs = np.concatenate([np.empty((0, 4), np.int64), *found])
    pairs = pairs[np.lexsort(pairs.T[:2])]
    new = np.ones(len(pairs), bool)
    new[1:] = (pairs[1:, :2] != pairs[:-1, :2]).any(axis=1)
    return pa.RecordBatch.from_arrays([pa.array(pairs[new, i]) for i in range(4)], names=["x", "y", "differ", "size"])


def _narrowed(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs that the parities in full width leave; ``nodes`` has (node, size, wide) and is a saved table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            differ = np.array([_wide_differ(x, y) for x, y in zip(batch.column(5).to_pylist(), batch.column(6).to_pylist(), strict=True)], np.int64)
            good = pa.array(_may_match(n, m, differ, percent))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good), pa.array(differ).filter(good), batch.column(2).filter(good)], names=["x", "y", "differ", "size"])

    of = lambda c: nodes.select(F.col("node").alias(c), F.col("size").alias(f"n_{c}"), F.col("wide").alias(f"wide_{c}"))
    pairs = saved(pairs, "pairs")
    large = pairs.filter(F.col("size") > PARITY_BITS).join(of("x"), "x").join(of("y"), "y").select("x", "y", "size", "n_x", "n_y", "wide_x", "wide_y").mapInArrow(run, PAIRS)
    out = saved(pairs.filter(F.col("size") <= PARITY_BITS).unionByName(large), "narrowed")
    discard(pairs)
    return out


def _likeliest(pairs: DataFrame) -> DataFrame:
    """Each node's pair of fewest differing bits: at most a pair a node."""
    ends = pairs.select(F.explode(F.array(F.struct(F.col("x").alias("u"), F.col("y").alias("v")), F.struct(F.col("y").alias("u"), F.col("x").alias("v")))).alias("e"), "differ").select("e.u", "e.v", "differ")
    best = ends.groupBy("u").agg(F.min_by("v", F.struct("differ", "v")).alias("v"))
    return best.select(F.least("u", "v").alias("x"), F.greatest("u", "v").alias("y")).distinct()


def _neighbours(lists: DataFrame, percent: int) -> DataFrame:
    """(x, y, differ) of each node with the one before it in each part of a list, and with the part's first.

    Nodes with the most shared shingles come first: what many edited copies were made from has no shingles of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = last = None  # of the part that the batch before ended in
        for batch in batches:
            columns = _arrays(batch, ["token", "part", "node", "n"])
            if not len(columns[0]):
                continue
            if last is not None:
                columns = [np.concatenate([[h, x], y]) for h, x, y in zip(head, last, columns, strict=True)]
            token, part, node, n, bits = columns
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (part[1:] != part[:-1])
            heads = np.maximum.accumulate(np.where(new, np.arange(len(token)), 0))
            i = np.flatnonzero(~new)
            found = []
            for j in (i - 1, heads[i]):
                differ = _differ(bits[i], bits[j])
                good = (node[i] != node[j]) & _may_match(n[i], n[j], differ, percent)
                found.append(_pairs(node[i[good]], node[j[good]], differ[good], np.maximum(n[i[good]], n[j[good]])))
            head, last = ([x[at] for x in columns] for at in (heads[-1], len(token) - 1))
            yield _pair_batch(found)

    ordered = lists.select("token", "part", "node", "n", *PARITY, "own").repartition("token", "part").sortWithinPartitions("token", "part", "own", "n", "node")
    return ordered.mapInArrow(run, PAIRS).distinct()


def _windows(low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) for all low[i] <= j < high[i], some hundred thousand pairs at a time; all of an i come at once."""
    ends = np.cumsum(high - low)
    a = 0
    while a < len(low):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + 200_000, side="right")))
        counts = (high - low)[a:b]
        i = np.repeat(np.arange(a, b), counts)
        yield i, np.arange(len(i)) - np.repeat(np.cumsum(counts) - counts, counts) + low[i]
        a = b


def _across(lists: DataFrame, percent: int, best: bool = False) -> DataFrame:
    """(x, y, differ, size) of all nodes of different groups in a list that sizes, positions and parities leave.

    ``lists`` has the length of each entry's list, the tokens of the node's entries before it, the nearest ``PREVIOUS`` of them, and the number of those after it.
    A pair is given where it meets first: not in a list whose token comes after one that both have among those before it. So no overlap is missed
    before the place it meets at, and what comes after bounds the overlap of the sets and of the stored entries.
    With ``best`` an entry gives its likeliest pair with the largest group of its list and with the others, so pairs are at most twice the entries, whatever the size of the groups.

    A list of more than ``LONG_LIST`` entries is dealt by node into parts, and each two parts meet in a tile of their own.
    """

    def pairs(token, low, high, mine, node, group, n, at, after, before, bits) -> Iterator[np.ndarray]:
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        tile = np.cumsum(new) - 1
        order = np.lexsort((group, tile))  # entries of the largest group of a tile meet no one of their own
        run = np.ones(len(order), bool)
        run[1:] = (tile[order][1:] != tile[order][:-1]) | (group[order][1:] != group[order][:-1])
        of_run = np.cumsum(run) - 1
        sizes = np.bincount(of_run)
        by_size = np.lexsort((sizes, tile[order][run]))
        largest = np.zeros(len(sizes), bool)
        largest[by_size[np.append(np.diff(tile[order][run][by_size]) != 0, True)]] = True
        in_largest = np.empty(len(order), bool)
        in_largest[order] = largest[of_run]

        n, at, after = (x.astype(np.int64) for x in (n, at, after))
        place = (tile << 32) + n
        rest = np.flatnonzero(~in_largest)
        least, most = (tile[rest] << 32) - (-n[rest] * percent // 100), (tile[rest] << 32) + n[rest] * 100 // percent
        mates = np.flatnonzero(in_largest)
        sides = [(mates, np.searchsorted(place[mates], least), np.searchsorted(place[mates], most, side="right")), (rest, np.searchsorted(place[rest], least), np.arange(len(rest)))]
        indexed, prefix = at < index_length(n, percent), prefix_length(n, percent)
        for others, start, end in sides:
            for i, j in _windows(start, np.maximum(start, end)):
                i, j = rest[i], others[j]
                keep = (group[i] != group[j]) & np.where(n[j] <= n[i], indexed[j], indexed[i]) & ((mine[i] != mine[j]) | (low[i] == high[i]))
                i, j = i[keep], j[keep]
                both = -(-percent * (n[i] + n[j]) // (100 + percent))
                keep = (np.minimum(n[i] - at[i], n[j] - at[j]) >= both) & (1 + np.minimum(after[i], after[j]) >= np.minimum(prefix[i] - n[i], prefix[j] - n[j]) + both)
                i, j = i[keep], j[keep]
                differ = _differ(bits[i], bits[j])
                keep = _may_match(n[i], n[j], differ, percent)
                i, j, differ = i[keep], j[keep], differ[keep]
                earlier = np.zeros(len(i), bool)
                for x in before:
                    for y in before:
                        earlier |= (x[i] == y[j]) & (x[i] != token[i])
                i, j, differ = i[~earlier], j[~earlier], differ[~earlier]
                if best and len(i):
                    order = np.lexsort((node[j], differ, i))
                    order = order[np.append(True, np.diff(i[order]) != 0)]
                    i, j, differ = i[order], j[order], differ[order]
                if len(i):
                    yield _pairs(node[i], node[j], differ, np.maximum(n[i], n[j]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0

        def found(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            *rest, bits = columns
            for more in pairs(*rest[:9], rest[9:], bits):
                yield _pair_batch([more])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(_arrays(batch, ["token", "low", "high", "part", "node", "group", "n", "at", "after", *BEFORE]))
            total += batch.num_rows
            if total >= TILE_ROWS:
                columns = [np.concatenate(x) for x in zip(*held, strict=True)]
                last = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1]) & (columns[2] == columns[2][-1])
                end = int(np.argmax(last))  # the last tile may go on
                if end:
                    yield from found([x[:end] for x in columns])
                held, total = [[x[end:].copy() for x in columns]], len(last) - end
                if total >= TILE_ROWS:
                    total = 0  # a tile of many rows: look again after as many more
        if held:
            yield from found([np.concatenate(x) for x in zip(*held, strict=True)])

    parts = F.ceil(F.col("entries") / LONG_LIST).cast("int")
    dealt = lists.withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int"))
    tiles = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    ordered = tiles.select("token", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "node", "group", "n", "at", "after", *BEFORE, *PARITY)
    return ordered.repartition("token", "low", "high").sortWithinPartitions("token", "low", "high", "n", "node").mapInArrow(run, PAIRS)


def _texts(rows: DataFrame, ours: DataFrame, pairs: DataFrame) -> DataFrame:
    """The saved table (node, text) of the nodes in the pairs, one text for each."""
    wanted = pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct()
    of = saved(ours.groupBy("node").agg(F.min("print").alias("print")).join(wanted, "node", "left_semi"), "wanted")
    bits = sketch_bits(of.count())
    # a bounded bit map, twice the same hash in each, keeps most other texts from being sent; the join decides
    shared = rows.sparkSession.sparkContext.broadcast(repeated_cells(of.select("print"), lambda batch: iter([np.repeat(mix(batch.column(0).to_numpy().view(np.uint64)), 2)]), bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = [np.frombuffer(x, np.uint8) for x in shared.value]
        for batch in batches:
            hit = passing(mix(batch.column(0).to_numpy().view(np.uint64)), maps, bits)
            if len(hit):
                yield batch.take(pa.array(hit))

    some = rows.select("print", "text").mapInArrow(run, "print long, text string").groupBy("print").agg(F.first("text").alias("text"))
    out = saved(some.join(of, "print").select("node", "text"), "texts")
    discard(of)
    return out


def _verified(texts: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """The saved table (x, y, both, n, m) of the sizes of the intersection and of the two sets of each pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, owner = NONE, None
        for batch in batches:
            owners, others = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for a, hashes, offsets in shingle_sets(batch.column(2), k):
                found = []
                for i, (s, e) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True), a):
                    if others[i] is None:
                        own, owner = hashes[s:e].copy(), owners[i]
                        continue
                    assert owner == owners[i]
                    at = np.minimum(np.searchsorted(own, hashes[s:e]), len(own) - 1)
                    both, sizes = int(np.count_nonzero(own[at] == hashes[s:e])), (len(own), e - s)
                    x, y = (owner, others[i]) if owner < others[i] else (others[i], owner)
                    found.append((x, y, both, *(sizes if x == owner else sizes[::-1])))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["x", "y", "both", "n", "m"])

    degrees = saved(pairs.select(F.explode(F.array("x", "y")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree")), "degrees")
    of = lambda c: degrees.select(F.col("node").alias(c), F.col("degree").alias(f"of_{c}"))
    first = (F.col("of_x") > F.col("of_y")) | ((F.col("of_x") == F.col("of_y")) & (F.col("x") < F.col("y")))
    ends = pairs.join(of("x"), "x").join(of("y"), "y").select(F.when(first, F.col("x")).otherwise(F.col("y")).alias("owner"), F.when(first, F.col("y")).otherwise(F.col("x")).alias("other"), F.greatest("of_x", "of_y").alias("degree"))
    dealt = saved(ends.select("owner", "other", F.pmod(F.xxhash64("other"), F.ceil(F.col("degree") / PER_TASK)).cast("int").alias("salt")), "dealt")
    others = dealt.join(texts, F.col("other") == F.col("node")).select("owner", "other", "text", "salt")
    heads = dealt.select("owner", "salt").distinct().join(texts, F.col("owner") == F.col("node")).select("owner", F.lit(None).cast("long").alias("other"), "text", "salt")
    ordered = others.unionByName(heads).repartition("owner", "salt").sortWithinPartitions("owner", "salt", F.col("other").asc_nulls_first())
    out = saved(ordered.mapInArrow(run, "x long, y long, both long, n long, m long"), "verified")
    discard(degrees, dealt)
    return out


def _linked(verified: DataFrame, percent: int) -> DataFrame:
    return verified.filter(F.col("both") * 100 >= percent * (F.col("n") + F.col("m") - F.col("both"))).select(F.col("x").alias("a"), F.col("y").alias("b"))


def _not_far(pairs: DataFrame, verified: DataFrame, percent: int) -> DataFrame:
    """The saved table of pairs without those that a known similarity to a highly similar set rules out."""
    far = 1 - F.col("both") / (F.col("n") + F.col("m") - F.col("both"))
    known = verified.select("x", "y", far.alias("far"))
    both = known.unionByName(known.select(F.col("y").alias("x"), F.col("x").alias("y"), "far"))
    best = saved(both.groupBy("x").agg(F.min_by("y", "far").alias("r"), F.min("far").alias("near")), "best")  # so that Spark can split the join's largest partitions
    through = pairs.join(best, "x", "left").join(both.select(F.col("x").alias("r"), "y", F.col("far").alias("over")), ["r", "y"], "left")
    out = saved(through.filter(F.col("over").isNull() | (F.abs(F.col("over") - F.col("near")) <= 1 - percent / 100 + 1e-9)).select("x", "y"), "todo")
    discard(best)
    return out


def union_of(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs whose nodes are in different groups."""
    of = lambda c: groups.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
    both = pairs.join(of("x"), "x", "left").join(of("y"), "y", "left")
    return both.filter(F.coalesce("of_x", "x") != F.coalesce("of_y", "y")).select("x", "y", "differ")


def _rows(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), row_key().alias("print"))


def _shared(rows: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Saved: the summaries of all rows; the lists of two nodes or more; and of each node its size and parities."""
    summaries = saved(_summaries(rows, k), "summaries")
    ours = summaries.filter("n >= 0")
    often = summaries.filter("n < 0").groupBy("node").agg(F.sum("doc_id").alias("count"))
    often = largest(often, "count", FREQUENT).toArrow().sort_by([("count", "ascending"), ("node", "ascending")])
    copied = ours.filter("n > 0").groupBy("node").agg(F.count(F.lit(1)).alias("rows"), F.min(F.coalesce("doc_id", F.lit(-1))).alias("first")).filter("rows > 1")
    copied = largest(copied, "rows", FREQUENT).toArrow().sort_by("node")
    ranks, counts = often["node"].to_numpy().view(np.uint64), often["count"].to_numpy()
    expected = (ours.agg(F.sum("n")).first()[0] or 0) * (100 - percent) // 100
    postings = saved(_postings(rows, ranks, counts, (copied["node"].to_numpy(), copied["first"].to_numpy()), expected, k, percent), "postings")
    lists, two = _shared_lists(postings)
    lists = saved(lists, "lists")
    discard(postings, two)
    nodes = lists.groupBy("node").agg(F.count(F.lit(1)).alias("shared")).join(ours.groupBy("node").agg(F.first("n").alias("size"), *(F.first(b).alias(b) for b in [*PARITY, "wide"])), "node")
    length = F.col("size") - F.ceil(F.col("size") * percent / 100) + 1
    return summaries, lists, saved(nodes.select("node", "size", (length - F.col("shared")).cast("long").alias("own"), *PARITY, "wide"), "nodes")


def _open_entries(lists: DataFrame, grouped: DataFrame, nodes: DataFrame) -> DataFrame:
    """The saved entries of the lists whose nodes are in two groups or more, as ``_across`` takes them.

    Nodes of different groups that share a token are in such a list, so their entries before and after hold all that they share.
    """
    entries = saved(lists.join(grouped.select("node", "group"), "node"), "entries")
    open_ = saved(entries.groupBy("token").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.count(F.lit(1)).alias("entries")).filter("low < high").select("token", "entries"), "open")
    own = Window.partitionBy("node").orderBy("at")
    before = [F.coalesce(F.lag("token", i + 1).over(own), "token").alias(c) for i, c in enumerate(BEFORE)]
    after = F.count(F.lit(1)).over(Window.partitionBy("node")) - F.row_number().over(own)
    placed = entries.select("token", "node", "group", "n", "at").join(open_, "token").select("*", *before, after.cast("int").alias("after"))
    out = saved(placed.join(nodes.select("node", *PARITY), "node"), "placed")
    discard(entries, open_)
    return out


def _open_pairs(lists: DataFrame, grouped: DataFrame, nodes: DataFrame, percent: int, best: bool = False) -> DataFrame:
    """The saved pairs of the lists whose nodes are in two groups or more; with ``best`` at most two an entry."""
    placed = _open_entries(lists, grouped, nodes)
    out = _narrowed(_across(placed, percent, best).dropDuplicates(["x", "y"]), nodes, percent)
    discard(placed)
    return out


def _with_groups(nodes: DataFrame, groups: DataFrame) -> DataFrame:
    return nodes.join(groups, "node", "left").select("node", F.coalesce("component", "node").alias("group"))


def _grouped(rows: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The saved summaries of all rows, and the saved table (node, component) of the nodes that are linked."""
    summaries, lists, nodes = _shared(rows, k, percent)
    listed = lists.join(nodes.select("node", "own", *PARITY), "node")
    nearest = _narrowed(_neighbours(listed, percent), nodes, percent)
    near = saved(_likeliest(nearest), "near")
    texts = [_texts(rows, summaries.filter("n >= 0"), near)]
    checked = [_verified(texts[0], near, k)]
    groups = components(_linked(checked[0], percent))
    while True:  # groups grow together before all their pairs are looked for
        likely = _open_pairs(lists, _with_groups(nodes, groups), nodes, percent, best=True)
        todo = saved(_likeliest(_apart(likely.join(union_of(checked).select("x", "y"), ["x", "y"], "left_anti"), groups)), "todo")
        linked = 0
        if todo.take(1):
            texts.append(_texts(rows, summaries.filter("n >= 0"), todo))
            checked.append(_verified(texts[-1], todo, k))
            linked = _linked(checked[-1], percent).count()
            groups = components(_linked(union_of(checked), percent))
        discard(likely, todo)
        if linked * 100 <= groups.count():
            break
    left = _open_pairs(lists, _with_groups(nodes, groups), nodes, percent)
    some = saved(_apart(left.join(union_of(checked).select("x", "y"), ["x", "y"], "left_anti"), groups), "apart")
    if some.take(1):
        texts.append(_texts(rows, summaries.filter("n >= 0"), some))
        for turn in range(LIKELY_TURNS + 1):  # first each node's likeliest pair, which leaves few pairs across groups; at last all
            known = union_of(checked)
            open_pairs = _apart(some.join(known.select("x", "y"), ["x", "y"], "left_anti"), groups)
            todo = saved(_likeliest(open_pairs), "todo") if turn < LIKELY_TURNS else _not_far(open_pairs.select("x", "y"), known, percent)
            more = bool(todo.take(1))
            if more:
                checked.append(_verified(texts[-1], todo, k))
                groups = components(_linked(union_of(checked), percent))
            discard(todo)
            if not more:
                break
    groups = saved(groups, "groups")
    discard(lists, nodes, nearest, near, left, some, *texts, *checked)
    return summaries, groups


def _named(summaries: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with the group of each; rows without shingles have no group of their own."""
    return summaries.filter("n >= 0").select("doc_id", "print", "node", "n").join(groups, "node", "left").withColumn("group", F.coalesce("component", "node"))


def join(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id."""
    summaries, groups = _grouped(_rows(docs), k, percent)
    named = _named(summaries, groups)
    smallest = saved(named.filter("n > 0").groupBy("group").agg(F.min("doc_id").alias("least")), "smallest")  # so that Spark can split the join's largest partitions
    out = saved(named.join(smallest, "group", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id")), "joined")
    discard(summaries, groups, smallest)
    return out


def row_key(text: str = "text"):
    """What tells rows of one id apart."""
    return F.xxhash64(F.col(text).cast("string"))


def not_first(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """The saved table (doc_id, print) of the rows that aren't the first of their group by id and print; a null id comes after all others."""
    summaries, groups = _grouped(_rows(docs), k, percent)
    named = _named(summaries, groups).filter("n > 0")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "print")
    first = saved(named.groupBy("group").agg(F.min(place).alias("first")), "first")
    out = saved(named.join(first, "group").filter(~place.eqNullSafe(F.col("first"))).select("doc_id", "print").distinct(), "later")
    discard(summaries, groups, first)
    return out


def first_rows(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """Of each group of linked rows the first by id (null last) and print, and every row without words; all columns.

    Of rows of one id and text the one with the least hash of all columns stays, unless they have neither id nor words.
    """
    own, doc_id, whole = new_names(docs.columns, "print", "id_of", "row_of")
    gone = not_first(docs, k, percent).select(F.col("doc_id").alias(doc_id), F.col("print").alias(own))
    keyed = docs.withColumn(own, row_key())
    same_id = F.col("doc_id").cast("long").eqNullSafe(gone[doc_id])
    kept = keyed.join(gone, same_id & (keyed[own] == gone[own]), "left_anti")
    if not docs.groupBy("doc_id").count().filter("count > 1").take(1):
        return kept.select(*docs.columns)
    bare = F.col("doc_id").isNull() & ~F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    one = kept.filter(~bare).groupBy("doc_id", own).agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias(whole))
    return one.select(f"{whole}.*").unionByName(kept.filter(bare).select(*docs.columns))


def members(docs: DataFrame, k: int = 4) -> DataFrame:
    """Per row: doc_id, node (0: no shingles)."""
    return _summaries(_rows(docs), k).filter("n >= 0").select("doc_id", "node")


def links(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """Every link between different sets, once: x, y (nodes of ``members``, x < y), both (shared shingles), n, m (sizes).

    All pairs that lists, positions and parities leave are verified, so the work grows with the pairs that are nearly links.
    """
    rows = _rows(docs)
    summaries, lists, nodes = _shared(rows, k, percent)
    pairs = _open_pairs(lists, nodes.select("node", F.col("node").alias("group")), nodes, percent)
    texts = _texts(rows, summaries.filter("n >= 0"), pairs)
    verified = _verified(texts, pairs.select("x", "y"), k)
    discard(summaries, lists, nodes, pairs, texts)
    return verified.join(_linked(verified, percent), (F.col("x") == F.col("a")) & (F.col("y") == F.col("b")), "left_semi")
