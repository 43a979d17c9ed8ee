"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirelens.llm.common import durable


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge down at most, and nodes that have one are nobody's lower end."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    seen = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return not seen.where("down > 1 OR (down = 1 AND up = 1)").limit(1).count()


def components(edges: DataFrame) -> DataFrame:
    """(a, b): each node of ``edges`` (a, b: long) that isn't the least of its component, with that least node.

    Each round is a few aggregations and joins over the edges, whose number never grows beyond nodes plus edges; the
    number of rounds grows with the logarithm of the longest path. Edges that are the stars of an earlier call beside a few
    new ones take hardly any. A star's hub is aggregated in parts; in the joins with what was aggregated its edges are
    one partition, which streams through one task unless Spark splits it.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = durable(ordered.distinct(), "edges")
    while not _stars(now):
        now = durable(_small_star(_large_star(now)), "edges")
    return now
