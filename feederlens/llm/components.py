"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feederlens.llm.scratch import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them; edges go from a to the smaller b."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    tied = edges.join(least, "a").where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return tied.unionByName(least.withColumnRenamed("least", "b")).distinct()


def connected(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b) but each component's smallest, which names it.

    Self-links and repeated links change nothing; no links give an empty result.
    """
    edges = scratch.keep(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    state = None
    while True:
        # One small row tells whether the edges are the same as before.
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if seen == state or seen[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = seen
        edges = scratch.keep(_small_star(_large_star(edges)), "edges")
