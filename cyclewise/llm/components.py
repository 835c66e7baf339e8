"""Connected components of a graph of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclewise.llm.common import stored


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node move to its smallest neighbour."""
    both = _both(edges)
    low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    moved = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.filter("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and the node, move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("low"))
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(low.select("a", F.col("low").alias("b"))).filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and its ``component`` (the smallest node) for all nodes of ``edges`` (a, b).

    Each round is written to the shared folder. The rounds grow with the logarithm of the
    longest path, not with its length. A hub with many links is one row of an aggregate with
    partial sums and a skewed join, which Spark splits.
    """
    edges = stored(edges.filter("a != b").select("a", "b").distinct(), "links")
    before = None
    while True:
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before or state[0] == 0:
            break
        before = state
        edges = stored(_small_star(_large_star(edges)), "links")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
