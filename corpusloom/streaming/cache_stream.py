"""The cache over an unbounded stream of queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.clusters import ClusterModel
from corpusloom.operators.lookup import SEARCH_DEPTH, THRESHOLD
from corpusloom.operators.state import ENTRY_SCHEMA, MAX_ENTRIES
from corpusloom.plans.answer import answer_log, prepare_log
from corpusloom.session import scratch, stage
from corpusloom.streaming import cache_store


def read_state(spark: SparkSession, folder: str, batch: int) -> DataFrame:
    """The cache as batch ``batch`` left it; empty before the first."""
    return cache_store.read_entries(spark, folder, batch)


def read_responses(spark: SparkSession, folder: str, after: int = -1) -> DataFrame:
    """All responses, or those of the batches after one."""
    return spark.read.parquet(f"{folder}/responses").filter(F.col("batch") > after).drop("batch")


def stream_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Entries, hits, misses and hit rate of the stream's cache since it was last flushed."""
    hits, misses, entries = cache_store.read_counts(spark, folder, cache_store.latest_batch(spark, folder))
    rate = round(hits / (hits + misses), 4) if hits + misses else 0.0
    return spark.createDataFrame([(entries, hits, misses, rate)], "total_entries bigint, hit_count bigint, miss_count bigint, hit_rate double")


def flush_stream(spark: SparkSession, folder: str) -> None:
    """Empty the cache and start counting anew. Call it while no batch is running."""
    latest = cache_store.latest_batch(spark, folder)
    if latest >= 0:
        cache_store.flush(spark, folder, latest)


def answer_stream(
    queries: DataFrame,
    index: DataFrame,
    folder: str,
    model: ClusterModel | None = None,
    threshold: float = THRESHOLD,
    depth: int = SEARCH_DEPTH,
    max_entries: int = MAX_ENTRIES,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Answer a stream of ``queries(qid, query, ts[, embedding])`` micro-batch by micro-batch.

    Within a batch the order of ``qid`` is kept exactly; between batches the cache and its counters
    live in ``folder`` (shared storage) as ``cache_store`` lays them out: a batch reads the clusters that its queries visit
    and writes what it changed. A batch that is run again after a failure reads the state before it and overwrites its own
    output, so nothing counts twice. Ids must grow from batch to batch. At a batch's end the ``max_entries`` last used
    entries stay. What a batch stages is dropped when it is done.
    """
    spark = queries.sparkSession

    def answer(batch: DataFrame, batch_id: int) -> None:
        path = f"{folder}/responses/batch={batch_id}"
        with scratch(spark):
            log = prepare_log(batch, model, depth)
            visited = None if model is None else log.select(F.explode("route").alias("cluster"))
            before = stage(cache_store.read_entries(spark, folder, batch_id - 1, visited), "visited-entries")
            answers = answer_log(log, index, before, threshold, None)
            seen = Observation()
            hit = F.count_if("cache_hit").alias("hits")
            answers.responses.observe(seen, hit, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
            old = before.select("entry_id", F.lit(True).alias("_known"), F.col("last_accessed").alias("_before"))
            after = answers.entries.join(old, "entry_id", "left")
            used = after.filter("_known and not last_accessed <=> _before")
            cache_store.write_batch(folder, batch_id, after.filter("_known is null"), used)
            hits, misses, entries = cache_store.read_counts(spark, folder, batch_id - 1)
            added = spark.read.schema(ENTRY_SCHEMA).parquet(f"{folder}/entries/batch={batch_id}").count()
            left = cache_store.evict(spark, folder, batch_id, entries + added, max_entries)
        found = seen.get
        cache_store.write_counts(spark, folder, batch_id, hits + found["hits"], misses + found["n"] - found["hits"], left)
        if (batch_id + 1) % cache_store.COMPACT_EVERY == 0:
            cache_store.compact(spark, folder, batch_id)

    return (
        queries.writeStream.foreachBatch(answer)
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
