"""Cluster labels to attach: k-means and top-down hierarchical."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame

from shelfrank.operators.split import SEED

CLUSTERS = 4
# Every pass of the fit reads a task's vectors whole, so a large table is spread over tasks of about so many rows.
ROWS_PER_TASK = 500_000


def _spread(vectors: DataFrame, rows: int = ROWS_PER_TASK) -> DataFrame:
    n = vectors.count()
    return vectors if n <= rows else vectors.repartition(max(-(-n // rows), vectors.sparkSession.sparkContext.defaultParallelism))


def _labelled(df: DataFrame, features: Sequence[str], estimator, name: str, key: str) -> DataFrame:
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="error")
    vectors = assembler.transform(df.select(key, *features)).select(key, "_features")
    spread = _spread(vectors).select("_features").persist()
    try:
        model = estimator.setFeaturesCol("_features").setPredictionCol(name).fit(spread)
    finally:
        spread.unpersist()
    return model.transform(vectors).select(key, name)


def kmeans_labels(df: DataFrame, features: Sequence[str], key: str = "row_id", k: int = CLUSTERS) -> DataFrame:
    return _labelled(df, features, KMeans(k=k, seed=SEED), "kmeans_cluster", key)


def hierarchical_labels(df: DataFrame, features: Sequence[str], key: str = "row_id", k: int = CLUSTERS) -> DataFrame:
    """Top-down splits; merging bottom-up would compare all pairs of rows."""
    return _labelled(df, features, BisectingKMeans(k=k, seed=SEED), "hierarchical_cluster", key)
