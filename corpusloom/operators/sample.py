"""Repeatable sampling without replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 5000


def hash_sample(df: DataFrame, rows: int = SAMPLE_ROWS, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """``min(rows, all)`` rows in the order of a seeded hash of ``key``; each task keeps its first ``rows`` only."""
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.orderBy(draw, key).limit(rows)
