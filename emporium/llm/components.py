"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, materialize


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (``a``, ``b``), root being the least node reached.

    Each round hangs every larger neighbour of a node on the node's least neighbour, then every
    smaller one; the rounds needed grow with the logarithm of the longest path. A hub is one row
    per neighbour, summed up before it is moved, and each round is written to the shared folder."""
    now = materialize(edges.filter(F.col("a") != F.col("b"))
                      .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.filter(F.col("b") > F.col("a")).join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        large = materialize(large, "edges")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(down, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b"))
                                              .alias("a"), F.col("m").alias("b"))
                 .filter(F.col("a") != F.col("b")).distinct())
        after = materialize(small, "edges")
        # Stars only: no node hangs on two, and no centre hangs on another.
        hung = after.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()
        done = hung and after.join(after.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()
        for old in (now, large):
            drop_table(old)
        now = after
        if done:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root")))
