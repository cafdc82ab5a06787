"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.scratch import Scratch


def is_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and one that has none that is larger."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up")))
    return ends.groupBy("node").agg(F.sum("up").alias("ups"), F.count(F.lit(1)).alias("n")).filter("ups > 1 OR ups = 1 AND n > 1").isEmpty()


def small_star(edges: DataFrame) -> DataFrame:
    """Every node of edges (u, v: u > v) and its smaller neighbours, tied to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours, tied to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for each node of edges (u, v: long); root is the smallest node that can be reached.

    A small star comes first, since it reads every edge once, a large star
    twice. Each round is a written table, so lineage stays short and a lost
    executor costs a round at most. A node with very many neighbours is split
    by the skew handling of the joins, whose other side has one row a node.
    """
    now = scratch.save(small_star(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()))
    while not is_stars(now):
        new = scratch.save(small_star(large_star(now)))
        scratch.drop(now)
        now = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
