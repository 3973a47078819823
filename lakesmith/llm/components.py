"""Connected components of an undirected graph by alternating stars.

Large-star links every larger neighbour of a node to the node's smallest
neighbour, small-star does the same for the smaller ones; both only move links
towards the minimum, so the graph shrinks to one star per component in about
log^2(nodes) rounds.  Each round is two grouped minima (partial aggregation,
so hubs are pre-aggregated) and two joins that adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesmith.llm.common import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b: comparable, not
    null); root is the smallest node of the component.  Self-links and repeated
    or reversed links do no harm; no edges give an empty result."""
    stars = checkpointed(edges.select("a", "b").where("a <> b").distinct())
    state = None
    while True:
        stars = checkpointed(_small_star(_large_star(stars)))
        found = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        stars.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
