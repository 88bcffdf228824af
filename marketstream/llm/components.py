"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbourhood."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        around.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them; edges point downwards."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.filter("a > b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.hash("a", "b"))
    ).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every linked node, ``root`` being the least node of its component.

    ``edges`` has two columns ``a`` and ``b`` of one ordered type; loops, repeats and nulls are
    ignored. A round only replaces links by links to smaller nodes, so the table never grows; joins
    on a node with many links are left to adaptive skew splitting. Every round is written to the
    shared folder, so a lost executor repeats one round at most.
    """
    down = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = stored(down.distinct(), "links")
    seen = _state(current)
    while seen[0]:
        current = stored(_small_star(_large_star(current)), "links")
        now = _state(current)
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
