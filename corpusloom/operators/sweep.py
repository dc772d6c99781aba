"""Choosing the cache threshold from labelled queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.vectors import dot
from corpusloom.operators.lookup import best_match, with_route

# The thresholds that are compared.
THRESHOLDS = [0.70, 0.75, 0.80, 0.85, 0.90, 0.95]


def pair_similarity(originals: DataFrame, paraphrases: DataFrame) -> DataFrame:
    """``(pair_id, similarity)`` of each original and its paraphrase; both have ``pair_id, embedding``."""
    other = paraphrases.select("pair_id", F.col("embedding").alias("_other"))
    return originals.join(other, "pair_id").select(
        "pair_id", dot(F.col("embedding"), F.col("_other")).alias("similarity")
    )


def threshold_sweep(probes: DataFrame, entries: DataFrame, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """``(threshold, hits, misses, hit_rate, false_positives)`` of probing a cache.

    ``probes`` has ``qid, kind, embedding``; a hit of kind ``unrelated`` is a false positive. The
    best score of a probe does not depend on the threshold, so each probe is looked up once and
    all thresholds are counted in one aggregate.
    """
    best = best_match(with_route(probes), entries)
    scored = probes.select("qid", "kind").join(best, "qid", "left")
    rows = []
    for threshold in thresholds:
        hit = F.coalesce(F.col("score") >= threshold, F.lit(False))
        rows.append(
            F.struct(
                F.lit(threshold).alias("threshold"),
                F.count_if(hit).alias("hits"),
                F.count_if(~hit).alias("misses"),
                F.coalesce(F.try_divide(F.count_if(hit), F.count(F.lit(1))), F.lit(0.0)).alias("hit_rate"),
                F.count_if(hit & (F.col("kind") == "unrelated")).alias("false_positives"),
            )
        )
    return scored.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
