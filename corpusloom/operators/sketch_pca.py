"""Leading principal components of wide vectors from a mergeable row sketch (frequent directions).

A task keeps ``size`` rows that stand for all of its own: whenever twice as many are there, they are turned to their principal axes
and shrunk by the square of the one at place ``size``, which empties half of them. Sketches of tasks merge by the same step, in groups. No
matrix of ``d x d`` is ever made. For every direction ``x`` the sketch ``B`` of the centered rows ``A`` holds
``0 <= |Ax|^2 - |Bx|^2 <= loss``, where ``loss`` is what the shrinking took, at most ``|A|^2 / size``; so each share of the
variance is known between two bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.blocks import to_lists, to_matrix
from corpusloom.session import ship, stage

#: Sketches that one task merges.
MERGED = 16
SKETCH = "part bigint, row array<double>, loss double, squares double, n bigint"


def shrink(rows: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """``size - 1`` rows or fewer with about the products of ``rows``, and the loss."""
    if len(rows) < size:
        return rows, 0.0
    _, s, axes = np.linalg.svd(rows, full_matrices=False)
    loss = float(s[size - 1] ** 2) if len(s) >= size else 0.0
    kept = np.sqrt(np.maximum(s**2 - loss, 0))
    some = kept > 0
    return kept[some][:, None] * axes[some], loss


def _as_batch(part: int, rows: np.ndarray, loss: float, squares: float, n: int) -> dict[str, pa.Array]:
    """A sketch as rows; one of zeros stands for none. Figures are in the first row only."""
    if not len(rows):
        rows = np.zeros((1, rows.shape[1]))
    first = np.arange(len(rows)) == 0
    return {
        "part": pa.array(np.full(len(rows), part, np.int64)), "row": to_lists(rows, pa.float64()), "loss": pa.array(np.where(first, loss, 0.0)),
        "squares": pa.array(np.where(first, squares, 0.0)), "n": pa.array(np.where(first, n, 0)),
    }


def sketch_rows(vectors: DataFrame, size: int, features: str = "embedding") -> DataFrame:
    """The merged sketch of the centered vectors as rows of ``SKETCH``; no rows for no vectors."""
    ship(vectors.sparkSession)
    rows = vectors.select(F.col(features).cast("array<double>").alias("row")).filter("row is not null")
    mean = rows.groupBy(F.lit("all").alias("of")).agg(vector_to_array(Summarizer.mean(array_to_vector("row"))).alias("mean")).first()
    if mean is None:
        return vectors.sparkSession.createDataFrame([], SKETCH)
    center = np.array(mean["mean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, loss, squares, n = np.zeros((0, len(center))), 0.0, 0.0, 0
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                x = to_matrix(batch.column("row").slice(start, size)) - center
                squares, n = squares + float((x**2).sum()), n + len(x)
                held = np.concatenate([held, x])
                if len(held) >= 2 * size:
                    held, lost = shrink(held, size)
                    loss += lost
        if n:
            held, lost = shrink(held, size)
            yield pa.RecordBatch.from_pydict(_as_batch(TaskContext.get().partitionId(), held, loss + lost, squares, n))

    def merge(rows: pa.Table) -> pa.Table:
        held, loss = np.zeros((0, len(center))), 0.0
        for start in range(0, rows.num_rows, size):
            held, lost = shrink(np.concatenate([held, to_matrix(rows["row"].combine_chunks().slice(start, size))]), size)
            loss += lost
        sums = [float(np.sum(rows[c].to_numpy())) for c in ("loss", "squares", "n")]
        return pa.table(_as_batch(rows["part"][0].as_py(), held, loss + sums[0], sums[1], int(sums[2])))

    sketch = stage(rows.mapInArrow(run, SKETCH), "row-sketch")
    while sketch.select("part").distinct().count() > 1:
        grouped = sketch.withColumn("part", F.call_function("div", F.col("part"), F.lit(MERGED)))
        sketch = stage(grouped.groupBy("part").applyInArrow(merge, SKETCH), "row-sketch")
    return sketch


def sketch_shares(vectors: DataFrame, k: int, size: int, features: str = "embedding") -> DataFrame:
    """``component, low, high, direction`` of the ``k`` leading components, and ``n``: bounds of their shares of the variance.

    ``size`` should be several times ``k``. The driver gets no row; one task turns the last sketch to its axes.
    """
    if k >= size:
        raise ValueError("the sketch must have more rows than there are components wanted")

    def run(rows: pa.Table) -> pa.Table:
        _, s, axes = np.linalg.svd(to_matrix(rows["row"]), full_matrices=False)
        loss, squares, n = (float(np.sum(rows[c].to_numpy())) for c in ("loss", "squares", "n"))
        found = min(k, len(s))
        low = s[:found] ** 2 / squares if squares else np.zeros(found)
        high = np.minimum(1, low + loss / squares) if squares else low
        return pa.table({"component": pa.array(np.arange(found, dtype=np.int32)), "low": low, "high": high, "direction": to_lists(axes[:found], pa.float64()), "n": pa.array(np.full(found, int(n)))})

    sketch = sketch_rows(vectors, size, features).withColumn("all", F.lit(0))
    return sketch.groupBy("all").applyInArrow(run, "component int, low double, high double, direction array<double>, n bigint")
