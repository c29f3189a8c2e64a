"""Connected components of a large graph, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """Component of every node that has an edge: (node, root), root the smallest node reachable.

    ``edges`` has columns a, b of one orderable type. Large-star and small-star steps alternate
    until the edges are stars already. Each step groups by a node with map-side minima and joins
    the minimum back; adaptive execution splits the join where a node has very many edges. Only
    two counts per round reach the driver. Each round is written, so a lost executor repeats one
    round at most.
    """
    now = stored(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(now)
    while True:
        now = stored(_small_star(_large_star(now)), "edges")
        before, mark = mark, _mark(now)
        if before == mark:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            )


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_m")).select(F.col("a").alias("_a"), F.least("a", "_m").alias("_m"))
    near = both.join(least, F.col("a") == F.col("_a")).filter(F.col("b") > F.col("a"))
    return near.select(F.col("_m").alias("a"), "b").filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect every smaller neighbour of a node, and the node, to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("_m")).withColumnRenamed("b", "_b")
    near = edges.join(least, F.col("b") == F.col("_b"))
    moved = near.select(F.col("_m").alias("a"), F.col("a").alias("b")).unionByName(
        least.select(F.col("_m").alias("a"), F.col("_b").alias("b"))
    )
    return moved.filter("a <> b").distinct()
