"""The cache as a table: admitting, touching, evicting, counting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.vectors import dominant

MAX_ENTRIES = 10000
ENTRY_SCHEMA = (
    "entry_id bigint, query string, embedding array<float>, "
    "result array<struct<category:string,score:double,text:string>>, "
    "cluster_probs array<double>, dominant_cluster int, last_accessed timestamp"
)


def empty_cache(spark: SparkSession) -> DataFrame:
    """A cache without entries: also what a flush leaves."""
    return spark.createDataFrame([], ENTRY_SCHEMA)


def as_entries(misses: DataFrame) -> DataFrame:
    """Cache entries from missed queries, filed under their dominant cluster (0 without memberships).

    ``misses`` has ``qid, query, embedding, result, ts`` and, with a model, ``cluster_probs``.
    """
    probs = F.col("cluster_probs") if "cluster_probs" in misses.columns else F.lit(None)
    probs = probs.cast("array<double>")
    return misses.select(
        F.col("qid").alias("entry_id"),
        "query",
        F.col("embedding").cast("array<float>").alias("embedding"),
        "result",
        probs.alias("cluster_probs"),
        F.coalesce(dominant(probs), F.lit(0)).alias("dominant_cluster"),
        F.col("ts").cast("timestamp").alias("last_accessed"),
    )


def admit(entries: DataFrame, misses: DataFrame) -> DataFrame:
    return entries.unionByName(as_entries(misses))


def touch(entries: DataFrame, hits: DataFrame) -> DataFrame:
    """Set the last access of entries that ``hits(entry_id, ts)`` matched; hits merge before the shuffle."""
    latest = hits.groupBy("entry_id").agg(F.max(F.col("ts").cast("timestamp")).alias("_ts"))
    return (
        entries.join(latest, "entry_id", "left")
        .withColumn("last_accessed", F.greatest("last_accessed", F.col("_ts")))
        .select(*entries.columns)
    )


def retain(entries: DataFrame, max_entries: int = MAX_ENTRIES) -> DataFrame:
    """The ``max_entries`` most recently used entries; older entries go first on equal times."""
    return entries.orderBy(F.desc("last_accessed"), F.desc("entry_id")).limit(max_entries)


def cache_stats(lookups: DataFrame, entries: DataFrame) -> DataFrame:
    """One row: entries, hits, misses, hit rate to 4 places (0 without lookups)."""
    counted = lookups.select(F.lit(0).alias("entry"), F.col("cache_hit").cast("int").alias("hit")).unionByName(
        entries.select(F.lit(1).alias("entry"), F.lit(None).cast("int").alias("hit"))
    )
    hits, misses = F.count_if(F.col("hit") == 1), F.count_if(F.col("hit") == 0)
    return counted.agg(
        F.count_if(F.col("entry") == 1).alias("total_entries"),
        hits.alias("hit_count"),
        misses.alias("miss_count"),
        F.round(F.coalesce(F.try_divide(hits, hits + misses), F.lit(0.0)), 4).alias("hit_rate"),
    )
