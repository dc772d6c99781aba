"""Dimension reduction before clustering."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 50


def _with_vectors(df: DataFrame) -> DataFrame:
    return df.withColumn("_vector", array_to_vector(F.col("embedding").cast("array<double>")))


def fit_projection(vectors: DataFrame, components: int = COMPONENTS) -> PipelineModel:
    """Centering and PCA over ``vectors(embedding)``; executors send a ``d x d`` matrix, never rows."""
    steps = [
        StandardScaler(inputCol="_vector", outputCol="_centered", withMean=True, withStd=False),
        PCA(k=components, inputCol="_centered", outputCol="_projected"),
    ]
    return Pipeline(stages=steps).fit(_with_vectors(vectors.select("embedding")))


def project(vectors: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``features``, the centered projection of ``embedding``."""
    return (
        model.transform(_with_vectors(vectors))
        .withColumn("features", vector_to_array("_projected"))
        .drop("_vector", "_centered", "_projected")
    )


def explained_variance(model: PipelineModel) -> list[float]:
    """Share of the variance that each component explains."""
    return [float(share) for share in model.stages[-1].explainedVariance]
