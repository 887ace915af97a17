"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, saved


def _state(edges: DataFrame) -> tuple[int, int]:
    n, mark = edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
    return n, int(mark)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of (a, b) links; a component is named by its smallest node.

    Alternating large-star and small-star steps: each node links its larger neighbours, then its smaller ones,
    to the smallest node it knows, until every node links to its component's smallest. Minima are
    aggregated before the shuffle, so a node with very many links needs no task of its own.
    """
    both = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    edges = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "links")
    before = _state(edges)
    while before[0]:
        # large star: larger neighbours of u go to the smallest of u and its neighbours
        near = edges.select(F.explode(both).alias("e")).select("e.u", "e.v")
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = near.join(least, "u").filter("v > u and v != m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # small star: u and its smaller neighbours go to the smallest of these
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        old, edges = edges, saved(small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").filter("a > b").distinct(), "links")
        discard(old)
        now = _state(edges)
        if now == before:
            break
        before = now
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
