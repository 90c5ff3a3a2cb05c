"""Connected components of an edge table, by distributed label propagation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import written


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) of every node in edges (a, b).

    Alternating large-star and small-star steps: each replaces the edges of a neighbourhood by
    edges to its smallest node, so that long chains shorten fast. Only (node, node) pairs move;
    a node with very many neighbours is met by partial aggregation and a join, not in one group.
    """
    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .where("u <> v").distinct(), "edges")
    while True:
        # large star: every larger neighbour of a node is hung under its smallest neighbour
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).select(F.col("u").alias("n"), "m")
        large = (both.join(least, F.col("u") == F.col("n")).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = written(large, "large")
        # small star: every smaller neighbour, and the node itself, under the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), "m")
        small = (large.join(least, F.col("u") == F.col("n"))
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct("u", F.col("m").alias("v")))).alias("x"))
                 .select("x.*").where("u <> v").distinct())
        small = written(small, "small")
        same = (small.select("u", "v", F.lit(1).alias("w")).unionByName(e.select("u", "v", F.lit(-1).alias("w")))
                .groupBy("u", "v").agg(F.sum("w").alias("w")).where("w <> 0").isEmpty())
        e = small
        if same:
            break
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
