"""Connected components by rounds of joins, without gathering links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import stored


def _summary(edges: DataFrame) -> tuple:
    """Tells whether a round changed anything: the count and a sum over the edges."""
    mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low"))
    least = least.select("a", F.least("a", "low").alias("low"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    moved = down.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(least.select("a", F.col("low").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, low): for each node with an edge, the least node it is linked to.

    ``edges`` has columns a and b of one orderable type, in any direction, with
    repeats. Rounds of large and small stars, each written down, go on until
    the edges are stars around the least nodes. A round makes at most as many
    edges as it has, and a node of very many edges meets them in joins that can
    be split and in aggregates that are combined before the shuffle. Edges of
    null, or from a node to itself, change nothing; no edges: no rows.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = _summary(now)
    while seen[0]:
        now = stored(_small_star(_large_star(now)), "edges")
        then = _summary(now)
        if then == seen:
            break
        seen = then
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("low"))
    return stars.union(now.select(F.col("b").alias("node"), F.col("b").alias("low")).distinct())
