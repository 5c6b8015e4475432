"""Connected components of an edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least node around it."""
    around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return around.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link the smaller neighbours of a node and the node itself to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").where("v > m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """Label the nodes of ``edges`` (a, b) with the least node of their component: node, label.

    The least nodes themselves, and nodes without an edge to another, have no row.  Each round is checkpointed; the number of
    rounds grows with the logarithm of the longest path (Kiveris et al., 2014).  A hub's edges meet
    its label in a join, whose large partitions Spark's adaptive execution splits.
    """
    now = edges.where("a <> b").distinct().checkpoint()
    mark = lambda df: df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = None
    for _ in range(most_rounds):
        now = _small_star(_large_star(now).distinct()).distinct().checkpoint()
        after = mark(now)
        if after == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label"))
        before = after
    raise RuntimeError(f"no end after {most_rounds} rounds")
