"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shedlake.llm.common import checkpointed

ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) to (node, component): the smallest node reachable, for nodes that have a link.

    Each round hooks the larger neighbours of every node to its smallest neighbour, then the smaller
    ones, until all that is left are stars. Rounds grow with the logarithm of the longest path. Only
    grouped minima and joins are used. The minima are checkpointed before the join, so that it has plain
    exchanges on both sides and AQE splits it at a node with very many links. Every round is
    checkpointed too, so lost executors don't undo it. Null ends and loops are ignored.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
    edges, before = checkpointed(edges.distinct()), None
    for _ in range(ROUNDS):
        edges = checkpointed(_small_star(_large_star(edges)))
        now = edges.agg(
            F.count(F.lit(1)),
            F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")),
        ).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    else:
        raise RuntimeError(f"no fixed point after {ROUNDS} rounds")
    roots = edges.select(F.col("low").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to the smallest member of its neighbourhood."""
    least = _least(edges)
    joined = edges.join(least, F.col("low") == F.col("node"), "left")
    return joined.select("high", F.coalesce("least", "low").alias("low")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node itself, move to the smallest of them."""
    least = _least(edges)
    joined = edges.join(least, F.col("high") == F.col("node"))
    moved = joined.where("low <> least").select(F.col("low").alias("high"), F.col("least").alias("low"))
    hooked = least.select(F.col("node").alias("high"), F.col("least").alias("low"))
    return moved.unionByName(hooked).distinct()


def _least(edges: DataFrame) -> DataFrame:
    return checkpointed(edges.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least")))
