"""Distinct counts by sketches that are kept for each part of a corpus and merged.

A sketch of a part is a few kilobytes, whatever the number of its posts; the sketch of a union is the merge of the parts'
sketches, so a new part costs a pass over that part only. With ``2**LOG_SIZE`` registers the standard error is
``1.04 / sqrt(2**LOG_SIZE)``, 0.8 % by default; ``ERROR_BOUND`` is three of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_SIZE = 14
ERROR_BOUND = 3 * 1.04 / 2 ** (LOG_SIZE / 2)


def sketch_parts(keys: DataFrame, part: str, columns: list[str]) -> DataFrame:
    """``part, rows`` and a sketch ``<column>_sketch`` of the distinct values of every column, for each part."""
    return keys.groupBy(part).agg(F.count(F.lit(1)).alias("rows"), *[F.hll_sketch_agg(c, LOG_SIZE).alias(f"{c}_sketch") for c in columns])


def merge_parts(parts: DataFrame, columns: list[str]) -> DataFrame:
    """One row: ``rows`` and the merged sketches. An empty corpus has the sketch null."""
    return parts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), *[F.hll_union_agg(f"{c}_sketch").alias(f"{c}_sketch") for c in columns])


def estimated(sketch: str) -> Column:
    """The number of distinct values that a sketch tells; 0 for none."""
    return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0))


def duplicate_estimates(merged: DataFrame) -> DataFrame:
    """``rows, exact_duplicates, body_duplicates``: rows minus the estimated distinct texts, and minus distinct bodies."""
    def beyond(column: str) -> Column:
        return F.greatest(F.col("rows") - estimated(column), F.lit(0))

    return merged.select("rows", beyond("text_key_sketch").alias("exact_duplicates"), beyond("body_key_sketch").alias("body_duplicates"))
