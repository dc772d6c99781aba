"""Silhouette with squared distances, over all rows, from sums of the clusters.

The mean squared distance of a point to a cluster is ``|x|^2 + Q / n - 2 x.S / n`` with the cluster's size ``n``, sum of points
``S`` and sum of squared norms ``Q``: one pass gives these, another one every point's figure, and no pair of points is
ever looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.blocks import to_matrix
from corpusloom.session import ship


def cluster_sums(points: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """``label, n, total (array), squares`` of every cluster, merged from partial sums of the tasks."""
    vector = array_to_vector(F.col(features).cast("array<double>"))
    found = points.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"), vector_to_array(Summarizer.sum(vector)).alias("total"), vector_to_array(Summarizer.normL2(vector)).alias("norms")
    )
    squares = F.aggregate("norms", F.lit(0.0), lambda sum, x: sum + x * x)
    return found.select(F.col(label).alias("label"), "n", "total", squares.alias("squares"))


def silhouette_squared(points: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """``silhouette, n``: the mean over all points of ``points(features, label)``; points alone in their cluster count as 0.

    The sums of the clusters are as many as these, and go to the tasks. With one cluster, or none, the silhouette is null.
    """
    points = points.filter(F.col(features).isNotNull() & F.col(label).isNotNull())
    rows = cluster_sums(points, features, label).orderBy("label").collect()
    labels = np.array([r["label"] for r in rows])
    sizes = np.array([r["n"] for r in rows], float)
    totals = np.array([r["total"] for r in rows], float)
    squares = np.array([r["squares"] for r in rows], float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = 0.0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = to_matrix(batch["features"])
            own = np.searchsorted(labels, batch["label"].to_numpy(zero_copy_only=False))
            mean = (x**2).sum(1)[:, None] + (squares / sizes)[None, :] - 2 * x @ (totals / sizes[:, None]).T
            mean = np.maximum(mean, 0)
            place = np.arange(len(x))
            # The point itself is at no distance, and not one of the others.
            alone = sizes[own] < 2
            a = mean[place, own] * sizes[own] / np.where(alone, 1, sizes[own] - 1)
            mean[place, own] = np.inf
            b = mean.min(1)
            largest = np.maximum(a, b)
            score = np.divide(b - a, largest, out=np.zeros(len(x)), where=~alone & (largest > 0) & np.isfinite(largest))
            total, n = total + score.sum(), n + len(x)
        yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([n])], names=["total", "n"])

    ship(points.sparkSession)
    sums = points.select(F.col(features).alias("features"), F.col(label).alias("label")).mapInArrow(run, "total double, n bigint")
    mean = F.try_divide(F.sum("total"), F.sum("n"))
    return sums.agg((mean if len(rows) > 1 else F.lit(None).cast("double")).alias("silhouette"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
