"""The cache of a stream as files: entries by cluster, and what changes as deltas that are merged on reading.

A batch writes its new entries under their clusters, the last use of entries that it touched, and the ids that left; nothing
else is rewritten. A batch reads the entries of the clusters that its queries visit: the files are partitioned by cluster, and
the clusters of the batch prune them at run time. Every ``COMPACT_EVERY`` batches the deltas are merged into a new base.

``entries/batch=b/dominant_cluster=c``  entries that batch ``b`` admitted
``touches/batch=b``                     ``entry_id, last_accessed`` of entries that it used
``evictions/batch=b``                   ``entry_id`` of entries that left after it
``base/after=b/dominant_cluster=c``     all entries after batch ``b``, merged
``flushed/after=b``                     a mark: nothing of batch ``b`` and before counts any more
``counts/after=b``                      lookups since the last flush, and entries; written last, so a batch that has it is complete

A batch that runs again overwrites its own files and reads those of the batches before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.state import ENTRY_SCHEMA, empty_cache
from corpusloom.session import child_names, drop_path, stage

COUNTS_SCHEMA = "hit_count bigint, miss_count bigint, entry_count bigint"
TOUCH_SCHEMA = "entry_id bigint, last_accessed timestamp"
#: Batches whose deltas are read before they are merged.
COMPACT_EVERY = 16
FILED = [c.strip().split()[0] for c in ENTRY_SCHEMA.replace("<category:string,score:double,text:string>", "").split(",")]


def numbers(spark: SparkSession, folder: str, kind: str, label: str) -> list[int]:
    return sorted(int(name.removeprefix(f"{label}=")) for name in child_names(spark, f"{folder}/{kind}") if name.startswith(f"{label}="))


def latest_batch(spark: SparkSession, folder: str) -> int:
    """The last complete batch; -1 before the first."""
    return max(numbers(spark, folder, "counts", "after"), default=-1)


def _deltas(spark: SparkSession, folder: str, kind: str, schema: str, after: int, upto: int) -> DataFrame:
    paths = [f"{folder}/{kind}/batch={b}" for b in numbers(spark, folder, kind, "batch") if after < b <= upto]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_entries(spark: SparkSession, folder: str, upto: int, clusters: DataFrame | None = None) -> DataFrame:
    """The entries after batch ``upto``, of the ``clusters(cluster)`` only if these are given."""
    flushed = max((b for b in numbers(spark, folder, "flushed", "after") if b <= upto), default=-1)
    base = max((b for b in numbers(spark, folder, "base", "after") if flushed < b <= upto), default=flushed)
    # Each batch's folder is a table of its own, partitioned by cluster.
    tables = [f"{folder}/entries/batch={b}" for b in numbers(spark, folder, "entries", "batch") if base < b <= upto]
    tables += [f"{folder}/base/after={base}"] if base > flushed else []
    entries = None
    for path in tables:
        table = spark.read.schema(ENTRY_SCHEMA).parquet(path)
        if clusters is not None:
            wanted = clusters.filter("cluster >= 0").select(F.col("cluster").alias("dominant_cluster")).distinct()
            table = table.join(wanted, "dominant_cluster", "left_semi")
        table = table.select(*FILED)
        entries = table if entries is None else entries.unionByName(table)
    if entries is None:
        return empty_cache(spark)
    touches = _deltas(spark, folder, "touches", TOUCH_SCHEMA, base, upto)
    evictions = _deltas(spark, folder, "evictions", "entry_id bigint", base, upto)
    latest = touches.groupBy("entry_id").agg(F.max("last_accessed").alias("_used"))
    merged = entries.join(evictions, "entry_id", "left_anti").join(latest, "entry_id", "left")
    return merged.withColumn("last_accessed", F.greatest("last_accessed", F.col("_used"))).select(*FILED)


def write_batch(folder: str, batch: int, new: DataFrame, touches: DataFrame) -> None:
    """What a batch admitted and used; only folders of clusters with a new entry are written."""
    new.select(*FILED).write.mode("overwrite").partitionBy("dominant_cluster").parquet(f"{folder}/entries/batch={batch}")
    touches.select("entry_id", "last_accessed").write.mode("overwrite").parquet(f"{folder}/touches/batch={batch}")


def evict(spark: SparkSession, folder: str, batch: int, count: int, max_entries: int) -> int:
    """Note the entries beyond the ``max_entries`` last used ones as gone; how many stay. Only ids and times are read."""
    path = f"{folder}/evictions/batch={batch}"
    if count <= max_entries:
        drop_path(spark, path)
        return count
    drop_path(spark, path)
    used = stage(read_entries(spark, folder, batch).select("entry_id", "last_accessed"), "uses")
    kept = used.orderBy(F.desc("last_accessed"), F.desc("entry_id")).limit(max_entries)
    used.join(kept, "entry_id", "left_anti").select("entry_id").write.mode("overwrite").parquet(path)
    return max_entries


def read_counts(spark: SparkSession, folder: str, batch: int) -> tuple[int, int, int]:
    """Hits and misses since the last flush, and entries, after a batch."""
    if batch < 0:
        return 0, 0, 0
    return tuple(spark.read.schema(COUNTS_SCHEMA).parquet(f"{folder}/counts/after={batch}").first())


def write_counts(spark: SparkSession, folder: str, batch: int, hits: int, misses: int, entries: int) -> None:
    spark.createDataFrame([(hits, misses, entries)], COUNTS_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{folder}/counts/after={batch}")


def flush(spark: SparkSession, folder: str, batch: int) -> None:
    spark.range(0).write.mode("overwrite").parquet(f"{folder}/flushed/after={batch}")
    write_counts(spark, folder, batch, 0, 0, 0)


def compact(spark: SparkSession, folder: str, batch: int) -> None:
    """Merge what is there after a complete batch into a base, and drop the deltas that the base before it had merged."""
    merged = read_entries(spark, folder, batch)
    merged.write.mode("overwrite").partitionBy("dominant_cluster").parquet(f"{folder}/base/after={batch}")
    older = [b for b in numbers(spark, folder, "base", "after") if b < batch]
    # A batch may still run again from the state before it, so the last base and what follows it stay.
    for b in older[:-1]:
        drop_path(spark, f"{folder}/base/after={b}")
    for kind in ("entries", "touches", "evictions"):
        for b in numbers(spark, folder, kind, "batch"):
            if older and b <= older[-1]:
                drop_path(spark, f"{folder}/{kind}/batch={b}")
