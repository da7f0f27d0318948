"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import store


def _nearest(edges: DataFrame, label: str) -> DataFrame:
    """(a, m): the smallest of a and its neighbours b.

    Aggregated on the map side first, so a hub costs a row for each task. It is stored, so that in
    the join that follows both sides are plain shuffles, of which Spark splits skewed partitions.
    """
    return store(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), label)


def _settled(edges: DataFrame) -> bool:
    """Whether every node has at most one edge down, to a node that has none: then that node is its component."""
    own = edges.where("a <> b")
    ends = own.select(F.col("a").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        own.select(F.col("b").alias("x"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    counts = ends.groupBy("x").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return counts.where("down > 1 OR down = 1 AND up = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, component: the smallest node each node of the edges (a, b) can reach.

    ``a`` and ``b`` are bigints; loops and repeated edges are harmless, edges with a null end are
    left out, and nodes without an edge are not in the result. Each round stores its edges, and
    their number never grows by more than one a node; the number of rounds grows with the logarithm of the size.
    """
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    # Kept as distinct (larger, smaller) pairs; a loop keeps a node that has no other edge.
    current = store(edges.distinct(), "cc-edges")
    while not _settled(current):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (
            both.join(_nearest(both, "cc-large"), "a").where("b >= a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        large = store(large, "cc-large-edges")
        small = large.join(_nearest(large, "cc-small"), "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            small.select("a", F.col("m").alias("b"))
        )
        current = store(small.distinct(), "cc-edges")
    return current.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component"))
    ).groupBy("node").agg(F.min("component").alias("component"))
