"""Accuracy, cross-validation figures and feature importances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words by which a feature counts as a cluster label.
CLUSTER_WORDS = ("cluster", "dbscan", "kmeans", "hierarchical")


def _hit(label: str) -> Column:
    return (F.col("prediction") == F.col(label)).cast("double")


def accuracy(predictions: DataFrame, keys: Sequence[str] = (), label: str = "label") -> DataFrame:
    """Share of right predictions, per group of ``keys`` or overall."""
    return predictions.groupBy(*keys).agg(F.avg(_hit(label)).alias("accuracy"))


def cross_validation(predictions: DataFrame, keys: Sequence[str] = (), label: str = "label", fold: str = "fold") -> DataFrame:
    """Mean and population deviation of the folds' accuracies."""
    per_fold = accuracy(predictions, [*keys, fold], label)
    return per_fold.groupBy(*keys).agg(
        F.avg("accuracy").alias("cv_mean"), F.stddev_pop("accuracy").alias("cv_std")
    )


def is_cluster_feature(feature: Column, words: Sequence[str] = CLUSTER_WORDS) -> Column:
    return F.lower(feature).rlike("|".join(words))


def sorted_importances(importances: DataFrame, words: Sequence[str] = CLUSTER_WORDS) -> DataFrame:
    """Long table (dataset, feature, importance), most important first, cluster features marked."""
    return importances.withColumn("is_cluster", is_cluster_feature(F.col("feature"), words)).orderBy(
        "dataset", F.desc("importance"), "feature"
    )


def cluster_importances(importances: DataFrame) -> DataFrame:
    """The importance of the first feature named after a cluster, per dataset."""
    return (
        importances.where(is_cluster_feature(F.col("feature"), ["cluster"]))
        .groupBy("dataset")
        .agg(F.min_by("importance", "position").alias("cluster_importance"))
    )
