"""Connected components of an edge list by alternating star contraction.

Large-star and small-star steps (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014) need a logarithmic number of rounds also on long
chains. Each round works on edges only and takes minima with a combiner. The
minima are joined back by plain shuffle joins, whose skewed partitions adaptive
execution splits, so a hub node is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.durable import checkpoint


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))
    joined = both.join(least, "u")
    return joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _same(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables of distinct edges hold the same ones."""
    if a.count() != b.count():
        return False
    return a.join(b, ["u", "v"], "left_anti").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected long edges (u, v); component = least node."""
    current = checkpoint(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        contracted = checkpoint(_small_star(_large_star(current)))
        if _same(contracted, current):
            break
        current = contracted
    leaves = contracted.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = contracted.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.union(roots)
