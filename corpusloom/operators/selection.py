"""Choosing the number of clusters."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.blocks import row_blocks, to_keys, to_lists, to_matrix
from corpusloom.functions.vectors import dominant
from corpusloom.operators.mixture import Centers, Fit, fit_mixtures, memberships, one_pass
from corpusloom.operators.sample import SAMPLE_ROWS, hash_sample
from corpusloom.session import ship, stage

#: Points on either side of a comparison, about.
BLOCK_ROWS = 2048


def bic(log_likelihood: Column, parameters: Column, n: Column) -> Column:
    return -2 * log_likelihood + parameters * F.log(n.cast("double"))


def aic(log_likelihood: Column, parameters: Column) -> Column:
    return -2 * log_likelihood + 2 * parameters


def _silhouette_values(total: np.ndarray, own: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Silhouette per row from its summed distances to each cluster, its own cluster, and the clusters' sizes."""
    at = np.arange(len(total)), own
    inside = total[at] / np.maximum(size[own] - 1, 1)
    outside = total / size
    outside[at] = np.inf
    nearest = outside.min(axis=1)
    scale = np.maximum(inside, nearest)
    value = np.divide(nearest - inside, scale, out=np.zeros(len(total)), where=scale > 0)
    return np.where(size[own] > 1, value, 0.0)


def silhouette(sample: DataFrame, labels: Sequence[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Mean Euclidean silhouette, one row ``(labelling, silhouette, n)`` per label column.

    ``sample`` has ``doc_id, features`` and the label columns. It is compared with itself block by
    block in the tasks, which send one row of sums for each point and block, so no pair of points
    is ever a row and the sample may have any size; the work grows with its square. A point alone in
    its cluster counts 0; with fewer than two clusters the silhouette is null.
    """
    spark = sample.sparkSession
    ship(spark)
    staged = stage(sample.select("doc_id", "features", *[F.col(c).cast("bigint").alias(c) for c in labels]), "sample")
    blocks = max(1, -(-staged.count() // block_rows))
    # A row for each cluster.
    counted = staged.select(F.posexplode(F.array(*labels)).alias("labelling", "value")).groupBy("labelling", "value").count().collect()
    sizes = [{r["value"]: r["count"] for r in sorted(counted) if r["labelling"] == i} for i in range(len(labels))]
    values = [np.array(list(x), dtype=np.int64) for x in sizes]

    def run(own: pa.Table, others: pa.Table) -> pa.Table:
        x, y = to_matrix(own["features"]), to_matrix(others["features"])
        if not len(x) or not len(y):
            return pa.table({"doc_id": own["doc_id"][:0], "totals": pa.array([], pa.list_(pa.float64()))})
        ids, other_ids = to_keys(own["doc_id"].combine_chunks()), to_keys(others["doc_id"].combine_chunks())
        members = np.concatenate(
            [(others[c].to_numpy()[:, None] == v[None, :]).astype(float) for c, v in zip(labels, values)], axis=1
        )
        totals = np.zeros((len(x), members.shape[1]))
        square = (y**2).sum(axis=1)
        for part in row_blocks(len(x), len(y)):
            squared = (x[part] ** 2).sum(axis=1)[:, None] + square - 2 * x[part] @ y.T
            distance = np.sqrt(np.maximum(squared, 0.0))
            distance[ids[part, None] == other_ids[None, :]] = 0.0
            totals[part] = distance @ members
        return pa.table({"doc_id": own["doc_id"], "totals": to_lists(totals, pa.float64())})

    # Of one type on both sides: equal numbers of two types are sent to different tasks, and a cogroup would not bring them together.
    block, every = F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    rows = staged.withColumn("row_block", block).withColumn("other_block", every)
    others = staged.withColumn("other_block", block).withColumn("row_block", every)
    kind = dict(staged.dtypes)["doc_id"]
    keys = ["row_block", "other_block"]
    sums = rows.groupBy(*keys).cogroup(others.groupBy(*keys)).applyInArrow(run, f"doc_id {kind}, totals array<double>")
    sums = sums.groupBy("doc_id").agg(vector_to_array(Summarizer.sum(array_to_vector("totals"))).alias("totals"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = np.cumsum([len(v) for v in values])
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = np.split(to_matrix(batch["totals"]), ends[:-1], axis=1)
            found = [
                float(_silhouette_values(t, np.searchsorted(v, batch[c].to_numpy()), np.array(list(s.values()), float)).sum())
                if len(v) > 1
                else None
                for t, c, v, s in zip(parts, labels, values, sizes)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(labels)), pa.array(found, pa.float64()), pa.array([batch.num_rows] * len(labels), pa.int64())],
                names=["labelling", "total", "n"],
            )

    scored = staged.drop("features").join(sums, "doc_id").mapInArrow(score, "labelling string, total double, n bigint")
    return scored.groupBy("labelling").agg(F.try_divide(F.sum("total"), F.sum("n")).alias("silhouette"), F.sum("n").alias("n"))


@dataclass(frozen=True)
class Selection:
    """Scores per component count, and the fits behind them."""

    table: DataFrame
    optimal_k: int
    fits: dict[int, Fit]


def select_k(
    points: DataFrame,
    ks: Sequence[int] = range(10, 31, 2),
    n_init: int = 5,
    max_iter: int = 300,
    seed: int = 42,
    sample_rows: int = SAMPLE_ROWS,
    tol: float = 1e-3,
    starts: dict[int, Centers] | None = None,
) -> Selection:
    """Fit every ``k`` and score it: ``(k, bic, aic, silhouette, optimal, at_edge)``.

    ``points(doc_id, features)`` should be staged. The least BIC wins, the lowest ``k`` on ties;
    ``at_edge`` tells that the winner is the first or last count tried, so the best may lie beyond.
    """
    spark = points.sparkSession
    fits = fit_mixtures(points, ks, n_init=n_init, max_iter=max_iter, tol=tol, seed=seed, starts=starts)
    final = one_pass(points, {k: fit.mixture for k, fit in fits.items()})
    sample = hash_sample(points, sample_rows, seed)
    for k, fit in fits.items():
        sample = sample.withColumn(f"k{k}", dominant(memberships(F.col("features"), fit.mixture)))
    scores = spark.createDataFrame(
        [(k, s.log_likelihood, fits[k].mixture.parameter_count, s.n) for k, s in final.items()],
        "k int, log_likelihood double, parameters int, n bigint",
    ).select(
        "k",
        bic(F.col("log_likelihood"), F.col("parameters"), F.col("n")).alias("bic"),
        aic(F.col("log_likelihood"), F.col("parameters")).alias("aic"),
    )
    shapes = silhouette(sample, [f"k{k}" for k in fits]).select(
        F.substring("labelling", 2, 10).cast("int").alias("k"), "silhouette"
    )
    table = stage(scores.join(shapes, "k"), "selection")
    optimal = table.agg(F.min_by("k", F.struct("bic", "k")).alias("k")).first()["k"]
    table = table.withColumn("optimal", F.col("k") == optimal).withColumn(
        "at_edge", F.col("optimal") & F.lit(optimal in (min(ks), max(ks)))
    )
    return Selection(table, optimal, fits)
