"""Shared storage and size checks used by the jobs."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: what the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="corpusloom-"))
    return context.getCheckpointDir().rstrip("/")


_scratch = threading.local()


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table in the shared folder."""
    folder = getattr(_scratch, "folder", None) or f"{checkpoint_folder(spark)}/corpusloom"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables that this thread stages within are dropped at the end."""
    outer = getattr(_scratch, "folder", None)
    _scratch.folder = stage_path(spark, "scratch")
    try:
        yield
    finally:
        drop_path(spark, _scratch.folder)
        _scratch.folder = outer


def stage(df: DataFrame, name: str, partition_by: str | None = None, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts lineage so that a lost executor costs a re-read, not a re-computation, and the
    table read back has true sizes for the optimizer's broadcast decisions. Like the files of
    ``checkpoint()``, staged tables stay until the folder is cleared; loops drop theirs.
    """
    spark = df.sparkSession
    path = path or stage_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none when it does not exist."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [child.getPath().getName() for child in system.listStatus(target)] if system.exists(target) else []


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, which must exist."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    children = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    return [child.getPath().getName() for child in children if child.isDirectory()]


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table that a job wrote and nobody reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def wave_partitions(df: DataFrame, target_rows: int, rows: int) -> DataFrame:
    """Merge small partitions for streaming passes, without a shuffle, keeping every core busy."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(cores, -(-rows // target_rows)))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread an input that is too small to give every core a split of its own.

    Larger inputs, by the optimizer's size figure, keep their splits and are not shuffled.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores, key) if size < cores * split else df


_shipped: set[str] = set()


def ship(spark: SparkSession | None = None) -> None:
    """Prepare an application's Python workers, once: send them this package, one BLAS thread per task.

    Every operator that runs Python in tasks calls this.
    """
    context = (spark or SparkSession.active()).sparkContext
    if context.applicationId in _shipped:
        return
    for setting in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS"):
        context.environment.setdefault(setting, "1")
    package = Path(__file__).parent
    archive = os.path.join(tempfile.mkdtemp(prefix="corpusloom-"), "corpusloom.zip")
    with zipfile.ZipFile(archive, "w") as files:
        for file in sorted(package.rglob("*.py")):
            files.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
