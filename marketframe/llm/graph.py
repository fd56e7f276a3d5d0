"""Connected components by alternating large-star and small-star steps, each a grouped minimum and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.llm.arrow import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours go to the smallest of its neighbourhood."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours go to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    moved = down.join(least, "a").where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionAll(least.select("a", F.col("low").alias("b"))).distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node and root (the smallest node it reaches) for every node of the edges (a, b), a != b.

    Grouped minima are combined before the shuffle and Spark splits a hub's rows in
    the joins, so no neighbourhood meets in one task.  Every step is written to the
    shared folder, and the one before deleted.  The rounds are about the logarithm of the longest path.
    """
    current = scratch.store(edges.where("a != b").select("a", "b").distinct(), "edges")
    state = None
    while True:
        before, current = current, scratch.store(_small_star(_large_star(current)), "edges")
        scratch.drop(before)
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if seen == state:
            roots = current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
            out = scratch.store(roots, "roots")
            scratch.drop(current)
            return out
        state = seen
