"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.store import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: the neighbours of each node (larger or not larger ones) move to its
    smallest neighbour. Both sides of the join are plain exchanges, so the neighbours of a
    hub may be split over tasks."""
    both = edges if not large else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.min("b").alias("m"))
                   .select("a", F.least("a", "m").alias("m")), "least")
    moved = both.join(least, "a")
    if large:
        moved = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return stored(moved.where("a > b").distinct(), "edges")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a root, and roots have none."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("up")).unionByName(
        edges.select(F.col("b").alias("id"), F.lit(0).alias("up")))
    return ends.groupBy("id").agg(F.sum("up").alias("up"), F.min("up").alias("low")).where(
        "up > 1 or (up = 1 and low = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every node of the edges (a, b) that has another neighbour than itself:
    root is the smallest id it is connected with. Steps alternate until all is stars, about
    as often as the logarithm of the longest path."""
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .where("a > b").distinct(), "edges")
    while not _are_stars(edges):
        edges = _star(_star(edges, True), False)
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
