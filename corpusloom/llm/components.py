"""Connected components of a table of links, by alternating stars, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import drop_path, stage, stage_path


def _least(directed: DataFrame) -> DataFrame:
    """Each node with the least of its neighbours and itself. Partial minima go first, so hubs are no burden."""
    return directed.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("least"))


def large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    joined = both.join(_least(both), both["a"] == F.col("node"))
    return joined.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a != b").distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    joined = down.join(_least(down), down["a"] == F.col("node"))
    moved = joined.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("least").alias("b")), F.struct("a", F.col("least").alias("b")))).alias("x"))
    return moved.select("x.*").filter("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``a, b``: each linked node ``a`` with the least node ``b`` of its component, but for that node itself.

    ``links(a, b)`` holds ids of unequal nodes. A round is written out, which cuts the lineage, and its
    predecessor dropped; rounds end when a round changes nothing, after the logarithm of the longest
    chain or so.
    """
    spark = links.sparkSession
    path = stage_path(spark, "links")
    current, before = stage(links, "links", path=path), None
    while True:
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == before or not mark[0]:
            return current
        before, old = mark, path
        path = stage_path(spark, "links")
        current = stage(small_star(large_star(current)), "links", path=path)
        drop_path(spark, old)
