"""Reports over soft assignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import stage


def confidence_bands(assignments: DataFrame) -> DataFrame:
    """Counts and shares of documents by their largest membership.

    The bands leave ``(0.5, 0.7]`` out, which ``other_count`` holds.
    """
    top = F.array_max("cluster_probs")
    total = F.count(F.lit(1))

    def percent(condition: Column) -> Column:
        return F.format_string("%.1f%%", F.try_divide(F.count_if(condition), total) * 100)

    high, boundary, uncertain = top > 0.7, (top >= 0.3) & (top <= 0.5), top < 0.3
    return assignments.agg(
        total.alias("n_documents"),
        F.count_if(high).alias("high_confidence_count"),
        percent(high).alias("high_confidence_pct"),
        F.count_if(boundary).alias("boundary_count"),
        percent(boundary).alias("boundary_pct"),
        F.count_if(uncertain).alias("uncertain_count"),
        percent(uncertain).alias("uncertain_pct"),
        F.count_if((top > 0.5) & (top <= 0.7)).alias("other_count"),
    )


def cluster_categories(assignments: DataFrame, top: int = 5) -> DataFrame:
    """``(cluster, total_docs, rank, category, n)``: the largest categories of each cluster.

    ``assignments`` has ``category, dominant_cluster``. Rows merge into counts before any shuffle;
    the counts are staged, so memberships are computed once for ranks and totals.
    """
    counts = stage(
        assignments.groupBy(F.col("dominant_cluster").alias("cluster"), "category").agg(F.count(F.lit(1)).alias("n")),
        "counts",
    )
    totals = counts.groupBy("cluster").agg(F.sum("n").alias("total_docs"))
    order = Window.partitionBy("cluster").orderBy(F.desc("n"), "category")
    ranked = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "cluster").select("cluster", "total_docs", "rank", "category", "n")


def cluster_composition(assignments: DataFrame, n_clusters: int, top: int = 5) -> DataFrame:
    """``(cluster, total_docs, top_categories)`` for every cluster, empty ones included."""
    entry = F.struct("rank", "category", "n")
    filled = (
        cluster_categories(assignments, top)
        .groupBy("cluster")
        .agg(F.max("total_docs").alias("total_docs"), F.array_sort(F.collect_list(entry)).alias("ranked"))
    )
    named = F.transform("ranked", lambda e: F.struct(e["category"].alias("category"), e["n"].alias("n")))
    clusters = assignments.sparkSession.range(n_clusters).select(F.col("id").cast("int").alias("cluster"))
    return clusters.join(filled, "cluster", "left").select(
        "cluster",
        F.coalesce("total_docs", F.lit(0)).alias("total_docs"),
        F.coalesce(named, F.expr("array()").cast("array<struct<category:string,n:bigint>>")).alias("top_categories"),
    )


def top_three_report(composition: DataFrame) -> DataFrame:
    """One line per cluster: its size and its three largest categories."""
    labels = F.transform(
        F.slice("top_categories", 1, 3), lambda e: F.concat(e["category"], F.lit("("), e["n"].cast("string"), F.lit(")"))
    )
    return composition.select("cluster", "total_docs", F.array_join(labels, ", ").alias("top_categories"))


def membership_check(assignments: DataFrame, tolerance: float = 1e-5) -> DataFrame:
    """Whether every row is a distribution over more than one cluster."""
    total = F.aggregate("cluster_probs", F.lit(0.0), lambda s, p: s + p)
    worst = F.max(F.abs(total - 1))
    return assignments.agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.min(F.size("cluster_probs")).alias("n_clusters"),
        worst.alias("largest_deviation"),
        ((worst < tolerance) & (F.min(F.size("cluster_probs")) > 1)).alias("is_distribution"),
    )

