"""The prefix trie of conversations: which beginnings conversations share, and what it saves to keep each once.

Conversations are range-sorted by their turns' digests, and a part is a run of neighbours in that order. Within a part, neighbours' longest common
prefixes (LCPs) are edges; union-find over them in descending depth builds the part's forest: every merge of two components makes a branching node at
the edge's depth, or widens the one that is there. All prefixes between a branching node and its parent are nodes with the same members.

A prefix that a part shares with the part before or after it is open: it is contracted to its sums, and these are merged across boundaries.
Every sum over a subtree is made so that parts just add up: a node's texts are subtracted once, where its first member stands, a leaf counts
where its last member stands, a child where the child's first member stands. Merging streams an open node's parts in order, one hash running over
the ids of the conversations that end there.

Scale: equal conversations are sorted by id, so a hot conversation or first turn spans parts like any other; a part's records are as many as its boundary
conversations are long. One conversation's digests are one row (about 50 bytes a turn), as is its list of turns.

Defined results: rows without conv_id are no conversation and left out; turns of equal number are ordered by role, then by the text's digest; a conversation
that is rebuilt without turns is a member of the root, which is there if any conversation is; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import discard, saved, shuffle_partitions

WIDTH = 32  # hexadecimal digits of a turn's digest
TURNS, LATEST = 100_000, 5
NODE = "part int, node string, parent string, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, is_open boolean"
NAMES = [c.split()[0] for c in NODE.split(", ")]


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): turns in order, each with its digest and its text's code points."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, WIDTH)
    turn = F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), digest.alias("digest"), F.char_length(text).alias("size"))
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def rebuilt(conversations: DataFrame, every: int = 100, most: int = LATEST) -> DataFrame:
    """(conv_id, key, sizes): each conversation with the first h turns of conversation c - c % ``every`` before what follows its own first h; h is crc32(c) % (``most`` + 1)."""
    own = saved(turns_of(conversations), "turns")
    base = own.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base_id"), F.slice("turns", 1, most).alias("first"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    both = own.withColumn("base_id", F.col("conv_id") - F.col("conv_id") % every).join(base, "base_id", "left").withColumn("h", h)
    nothing = F.array().cast(own.schema["turns"].dataType)
    turns = F.concat(F.slice(F.coalesce("first", nothing), F.lit(1), F.col("h")), F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0))))
    out = both.select("conv_id", turns.alias("turns")).select("conv_id", F.array_join("turns.digest", "").alias("key"), F.col("turns.size").alias("sizes"))
    out._scratch = own
    return out


def common(a: str, b: str) -> int:
    """Turns that two keys share at their beginning."""
    n = min(len(a), len(b)) // WIDTH
    low = 0
    while low < n:  # a galloping search: most neighbours share few turns or all
        step = 1
        while low + step <= n and a[low * WIDTH : (low + step) * WIDTH] == b[low * WIDTH : (low + step) * WIDTH]:
            low, step = low + step, step * 2
        if step == 1:
            break
    return low


class Forest:
    """The compressed trie of sorted keys: for each node depth, first and last row, children and whether rows end there."""

    def __init__(self, keys: list[str]) -> None:
        n = len(keys)
        lengths = [len(k) // WIDTH for k in keys]
        edges = [common(keys[i], keys[i + 1]) for i in range(n - 1)]
        self.depth, self.first, self.last = lengths[:], list(range(n)), list(range(n))
        self.children: list[list[int]] = [[] for _ in range(n)]
        parent, top = list(range(n)), list(range(n))  # of components: union-find, and the node at the component's top

        def find(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for i in sorted(range(n - 1), key=lambda i: -edges[i]):  # equal depths from left to right
            a, b, d = find(i), find(i + 1), edges[i]
            left, right = top[a], top[b]
            if self.depth[left] == d:
                node = left
                if self.depth[right] == d:
                    self.children[node] += self.children[right]
                else:
                    self.children[node].append(right)
            elif self.depth[right] == d:  # only the left one may end at the edge's depth: it is a prefix of the right one
                raise ValueError("keys aren't sorted")
            else:
                node = len(self.depth)
                self.depth.append(d)
                self.first.append(self.first[left])
                self.last.append(self.last[right])
                self.children.append([left, right])
            self.last[node] = self.last[right]
            parent[b] = a
            top[a] = node
        self.root = top[find(0)]

    def bottom_up(self) -> list[int]:
        order, stack = [], [self.root]
        while stack:
            node = stack.pop()
            order.append(node)
            stack += self.children[node]
        return order[::-1]


def prefix_names(key: str, most: int) -> list[str]:
    """Names of a key's prefixes of up to ``most`` turns, the same in every part."""
    run, out = hashlib.sha256(), []
    for d in range(most + 1):
        out.append(f"{d}:{run.hexdigest()}")
        run.update(key[d * WIDTH : (d + 1) * WIDTH].encode())
    return out


def part_nodes(part: int, keys: list[str], ids: list[int], sizes: list[list[int]], before: int, after: int) -> list[tuple]:
    """A row of ``NODE`` for each prefix of the part's conversations, which are sorted by key and id.

    ``before`` and ``after`` are the turns shared with the conversation before and after the part, -1 where there is none.
    """
    forest, end, out = Forest(keys), len(keys) - 1, []
    shared = prefix_names(keys[0], before), prefix_names(keys[-1], after)  # open prefixes are these
    above = {child: node for node in forest.bottom_up() for child in forest.children[node]}
    sums: dict[int, tuple[int, int, int]] = {}  # of a node's topmost prefix: smallest id, leaves, saved
    parent_rows: dict[int, list] = {}  # rows whose parent is a prefix of another node, by that node
    for node in forest.bottom_up():
        s, e, depth = forest.first[node], forest.last[node], forest.depth[node]
        children, n = forest.children[node], e - s + 1
        least = min((sums[c][0] for c in children), default=None)
        ending = [i for i in range(s, (forest.first[children[0]] if children else e + 1)) if len(keys[i]) == depth * WIDTH]
        own_least = min((ids[i] for i in ending), default=least)
        least = own_least if least is None else min(least, own_least)
        leaves, saved_ = sum(sums[c][1] for c in children), sum(sums[c][2] for c in children)
        top = forest.depth[above[node]] + 1 if node in above else 0
        waiting = parent_rows.pop(node, [])
        for d in range(depth, top - 1, -1):
            from_left, to_right = s == 0 and d <= before, e == end and d <= after
            is_open = from_left or to_right
            name = shared[not from_left][d] if is_open else None
            size = sizes[s][d - 1] if d else 0
            saved_ += (n - (not from_left)) * size
            if d == depth:
                n_children = len(children) - bool(children and forest.first[children[0]] == 0 and d + 1 <= before)
                leaves += not children and not to_right
                ends = ",".join(str(ids[i]) for i in ending)
            else:
                n_children, ends = int(not (s == 0 and d + 1 <= before)), ""
            for row in waiting:  # the prefixes one turn longer
                row[2], row[5] = (name, None) if is_open else (None, least)
            row = [part, name, None, d, least, None, n, n_children, leaves, saved_, ends if is_open else hashlib.sha256(ends.encode()).hexdigest(), is_open]
            out.append(row)
            waiting = [row]
        sums[node] = (least, leaves, saved_)
        if node in above:
            parent_rows.setdefault(above[node], []).extend(waiting)
    return out


def parts_nodes(parts: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows of ``NODE`` of every part; a part has ``TURNS`` turns or so at most, and its shared depths come with it."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        both = table.to_pydict()
        (at,) = (i for i, k in enumerate(both["key"]) if k is None)
        before, after = both["before"][at], both["after"][at]
        rows = sorted((k, c, s) for k, c, s in zip(both["key"], both["conv_id"], both["sizes"], strict=True) if k is not None)
        nodes = part_nodes(key[0].as_py(), [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], before, after)
        columns = list(zip(*nodes, strict=True))
        types = (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=NAMES)

    return parts.unionByName(edges, allowMissingColumns=True).groupBy("part").applyInArrow(run, NODE)


def shared_depths(parts: DataFrame) -> DataFrame:
    """(part, before, after): the turns that a part's first conversation shares with the last before it, and its last with the first after it; -1 where there is none.

    Parts with rows are numbered, by one small window of a row a part, and the boundary conversations of neighbours meet by number.
    """
    ends = parts.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    order = ends.select("part", F.row_number().over(Window.orderBy("part")).alias("nth"))
    ends = saved(ends.join(order, "part"), "ends")
    share = F.udf(common, T.IntegerType())  # one call a boundary
    met = ends.select("nth", "high").join(ends.select((F.col("nth") - 1).alias("nth"), "low"), "nth").select("nth", share("high", "low").alias("depth"))
    after = ends.select("part", "nth").join(met.select("nth", F.col("depth").alias("after")), "nth", "left")
    both = after.join(met.select((F.col("nth") + 1).alias("nth"), F.col("depth").alias("before")), "nth", "left")
    return both.select("part", F.coalesce("before", F.lit(-1)).alias("before"), F.coalesce("after", F.lit(-1)).alias("after"))


def merged(records: DataFrame, tasks: int) -> DataFrame:
    """Open nodes from their records: sums, smallest id, and the hash of all ids that end there, in the order of parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state, done = None, None, []

        def closed() -> tuple:
            return (*state[:9], state[9].hexdigest())

        for batch in batches:
            for r in batch.to_pylist():
                if r["node"] != held:
                    if held is not None:
                        done.append(closed())
                    held, state = r["node"], [r["node"], r["parent"], r["depth"], r["conv_id"], 0, 0, 0, 0, False, hashlib.sha256()]
                state[3] = min(state[3], r["conv_id"])
                for i, c in enumerate(("n_convs", "n_children", "n_leaves", "saved_tokens"), 4):
                    state[i] += r[c]
                if r["ends"]:
                    state[9].update(("," * state[8] + r["ends"]).encode())
                    state[8] = True
            if len(done) >= 1000:
                yield rows(done)
                done = []
        if held is not None:
            done.append(closed())
        yield rows(done)

    def rows(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [[]] * 10
        types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["node", "parent", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "any", "ends"])

    return records.repartition(tasks, "node").sortWithinPartitions("node", "part").mapInArrow(run, "node string, parent string, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, any boolean, ends string")


def trie(conversations: DataFrame) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    built = rebuilt(conversations)
    rows = saved(built, "rebuilt")
    discard(built._scratch)
    total = rows.agg(F.coalesce(F.sum(F.size("sizes") + 1), F.lit(0))).first()[0]
    n_parts = max(-(-total // TURNS), shuffle_partitions(spark))
    parts = saved(rows.repartitionByRange(n_parts, "key", "conv_id").withColumn("part", F.spark_partition_id()), "parts")
    discard(rows)
    nodes = saved(parts_nodes(parts, shared_depths(parts)), "nodes")
    discard(parts)
    records = nodes.filter("is_open")
    whole = saved(merged(records, shuffle_partitions(spark)), "open")
    names = whole.select(F.col("node").alias("parent"), F.col("conv_id").alias("found"))
    near = records.select("part", F.col("node").alias("parent")).join(names, "parent")  # a part's own open nodes, so that no node's children meet in one task
    closed = nodes.filter("not is_open")
    values = ("n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256"))
    inner = closed.filter("parent is null").select("conv_id", "depth", "parent_conv_id", *values)
    outer = closed.filter("parent is not null").join(near, ["part", "parent"]).select("conv_id", "depth", F.col("found").alias("parent_conv_id"), *values)
    opened = whole.join(names, "parent", "left").select("conv_id", "depth", F.col("found").alias("parent_conv_id"), *values)
    return inner.unionByName(outer).unionByName(opened)
