"""Cluster models: training, assignment, persistence."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.vectors import dominant
from corpusloom.operators.mixture import Mixture, fit_mixtures, memberships
from corpusloom.operators.project import COMPONENTS, fit_projection, project
from corpusloom.operators.selection import Selection, select_k
from corpusloom.session import spread, stage, wave_partitions
from corpusloom.sources.tables import read_or_none

ROWS_PER_TASK = 2_000_000


@dataclass(frozen=True)
class ClusterModel:
    """A mixture, over projected vectors unless ``projection`` is None."""

    mixture: Mixture
    projection: PipelineModel | None = None

    def predict(self, vectors: DataFrame) -> DataFrame:
        """Add ``cluster_probs`` and ``dominant_cluster`` to ``vectors(embedding)``."""
        if self.projection is None:
            features, source = vectors, F.col("embedding")
        else:
            features, source = project(vectors, self.projection), F.col("features")
        probs = features.withColumn("cluster_probs", memberships(source, self.mixture))
        return probs.drop(*set(features.columns) - set(vectors.columns)).withColumn(
            "dominant_cluster", dominant(F.col("cluster_probs"))
        )

    def parameters(self, spark: SparkSession) -> DataFrame:
        rows = zip(
            range(self.mixture.k), self.mixture.weights.tolist(), self.mixture.means.tolist(), self.mixture.variances.tolist()
        )
        return spark.createDataFrame(list(rows), "k int, weight double, mean array<double>, var array<double>")


def tag_with_model(index: DataFrame, model: ClusterModel) -> DataFrame:
    """Set ``dominant_cluster`` of a vector table from its own vectors: one pass, no join."""
    columns = index.columns
    return model.predict(index.drop("dominant_cluster")).select(*columns)


def predict(vectors: DataFrame, model: ClusterModel | None) -> DataFrame:
    """Memberships of query vectors; an error without a model."""
    if model is None:
        raise RuntimeError("no cluster model: train or load one first")
    return model.predict(vectors)


def reduced_points(vectors: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, PipelineModel]:
    """Staged ``(doc_id, features)``: computed once, read by every fitting round in few large tasks."""
    projection = fit_projection(vectors, components)
    reduced = project(spread(vectors.select("doc_id", "embedding"), "doc_id"), projection)
    staged = stage(reduced.select("doc_id", "features"), "points")
    return wave_partitions(staged, ROWS_PER_TASK, staged.count()), projection


def train(
    vectors: DataFrame,
    n_clusters: int = 20,
    reduced: tuple[DataFrame, PipelineModel] | None = None,
    components: int = COMPONENTS,
    **options,
) -> ClusterModel:
    """Fit a mixture over ``vectors(doc_id, embedding)``; a projection made before is used again."""
    points, projection = reduced or reduced_points(vectors, components)
    return ClusterModel(fit_mixtures(points, [n_clusters], **options)[n_clusters].mixture, projection)


def find_optimal_clusters(
    vectors: DataFrame, ks: Sequence[int] = range(10, 31, 2), components: int = COMPONENTS, **options
) -> tuple[Selection, ClusterModel]:
    """Score every ``k`` on the projected vectors; the model of the winner comes along."""
    points, projection = reduced_points(vectors, components)
    selection = select_k(points, ks, **options)
    return selection, ClusterModel(selection.fits[selection.optimal_k].mixture, projection)


def save_model(model: ClusterModel, spark: SparkSession, path: str, assignments: DataFrame | None = None) -> None:
    """Write the projection, the mixture and, if given, the memberships ``(doc_id, cluster_probs)``."""
    model.parameters(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/mixture")
    if model.projection is not None:
        model.projection.write().overwrite().save(f"{path}/projection")
    if assignments is not None:
        assignments.select("doc_id", "cluster_probs").write.mode("overwrite").parquet(f"{path}/memberships")


def load_model(spark: SparkSession, path: str, projected: bool = True) -> tuple[ClusterModel, DataFrame | None]:
    """The model and its memberships; a missing model is an error, missing memberships are None."""
    parameters = read_or_none(spark, f"{path}/mixture")
    if parameters is None:
        raise FileNotFoundError(f"no cluster model at {path}")
    rows = parameters.orderBy("k").collect()
    mixture = Mixture(
        np.array([row.weight for row in rows]),
        np.array([row["mean"] for row in rows]),
        np.array([row["var"] for row in rows]),
    )
    projection = PipelineModel.load(f"{path}/projection") if projected else None
    return ClusterModel(mixture, projection), read_or_none(spark, f"{path}/memberships")
