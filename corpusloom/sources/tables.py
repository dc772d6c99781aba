"""Stored vectors, indexes and reports."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def save_embeddings(embeddings: DataFrame, path: str) -> None:
    embeddings.select("doc_id", "embedding").write.mode("overwrite").parquet(path)


def load_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_index(index: DataFrame, path: str) -> None:
    index.write.mode("overwrite").parquet(path)


def append_index(more: DataFrame, path: str) -> None:
    more.write.mode("append").parquet(path)


def load_index(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored vector table, or None when there is none."""
    return read_or_none(spark, path)


def save_selection(table: DataFrame, path: str) -> None:
    """Model selection scores as JSON Lines, one line per component count."""
    table.coalesce(1).write.mode("overwrite").json(path)


def save_composition(bands: DataFrame, composition: DataFrame, path: str) -> None:
    """The composition report as JSON Lines: confidence bands, and one line per cluster."""
    bands.coalesce(1).write.mode("overwrite").json(f"{path}/bands")
    composition.coalesce(1).write.mode("overwrite").json(f"{path}/clusters")


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
