"""Connected components of an undirected graph, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfdiff.session import settle

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours its least neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low"))
    least = least.select("a", F.least("a", "low").alias("low"))
    larger = both.filter("b > a").join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours and itself the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    joined = down.join(least, "a")
    moved = joined.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(least.select("a", F.col("low").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and component (its least node) of all nodes of `edges` (a, b).

    After the last round every edge leads from a node to its component. Nodes of huge
    degree are split by Spark's skew join; each round is written to the shared folder, so
    that a lost executor costs one round at most. Loops and repeated edges don't matter;
    nodes without another one are left out.
    """
    now = settle(_small_star(edges.select("a", "b")), "stars")
    for _ in range(MAX_ROUNDS):
        after = settle(_small_star(_large_star(now)), "stars")
        # Stars are stable when no node is both a leaf and a centre.
        centres = after.select(F.col("b").alias("a")).distinct()
        if after.join(centres, "a", "left_semi").isEmpty():
            return after.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                after.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        now = after
    raise RuntimeError("components did not settle")
