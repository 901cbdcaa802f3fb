"""Connected components of a table of links, in rounds that each cut their lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framesift.session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the smallest of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, points to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with a link; the component is named by its smallest node.

    Rounds of large-star and small-star steps until nothing changes, a number that grows with the
    logarithm of the longest chain. Steps are joins and aggregates on the nodes, so a node with very
    many links is an ordinary skewed join. Links to itself or with a missing end count for nothing.
    """
    ends = links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = materialise(ends, "links")
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        state = tuple(now)
        edges = materialise(_small_star(_large_star(edges)), "links")


def merged(grouped: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) of ``grouped`` after further links (a, b) between nodes, which it need not know yet."""
    between = links.select("a", "b")
    for end in ("a", "b"):
        known = grouped.select(F.col("node").alias(end), F.col("component").alias("whole"))
        between = between.join(known, end, "left").withColumn(end, F.coalesce("whole", end)).drop("whole")
    moved = components(between).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    nodes = grouped.select("node", "component").union(links.select("a", "a")).union(links.select("b", "b"))
    first = nodes.groupBy("node").agg(F.min("component").alias("component"))
    return first.join(moved, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
