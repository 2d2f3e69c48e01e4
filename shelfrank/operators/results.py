"""Comparing the results of feature sets and models.

A result table has one row per dataset and model: at least ``dataset``,
``model`` (or ``model_name``), ``accuracy`` and ``seq``, the order of the runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.functions import round_half_even

DECIMALS = 4
# Fixed value: the order in which label sources are reported and ties broken.
SOURCE_ORDER = ("kmeans", "hierarchical", "dbscan")
BASELINE = "original"


def _models(results: DataFrame, model: str, models: Sequence[str] | None) -> list[str]:
    # Naming the models saves the job that looks them up.
    if models is not None:
        return list(models)
    return [r[0] for r in results.select(model).distinct().orderBy(model).collect()]


def accuracy_pivot(
    results: DataFrame,
    keys: Sequence[str] = ("dataset", "dataset_name", "n_features"),
    model: str = "model",
    value: str = "accuracy",
    models: Sequence[str] | None = None,
) -> DataFrame:
    """One column per model with the first value by run order, rounded; no run gives NULL."""
    names = _models(results, model, models)
    pivoted = results.groupBy(*keys).pivot(model, names).agg(F.min_by(value, F.when(F.col(value).isNotNull(), F.col("seq"))))
    return pivoted.select(*keys, *[round_half_even(F.col(f"`{n}`"), DECIMALS).alias(n) for n in names]).orderBy(*keys)


def strict_pivot(
    results: DataFrame, value: str, model: str = "model_name", key: str = "dataset", models: Sequence[str] | None = None
) -> DataFrame:
    """One column per model; two rows for one cell are an error."""
    if not results.groupBy(key, model).count().where("count > 1").isEmpty():
        raise ValueError("duplicate dataset and model")
    return results.groupBy(key).pivot(model, _models(results, model, models)).agg(F.first(value)).orderBy(key)


def mean_pivot(
    results: DataFrame, key: str = "dataset_name", model: str = "model", models: Sequence[str] | None = None
) -> DataFrame:
    """One column per model with the mean accuracy."""
    return results.groupBy(key).pivot(model, _models(results, model, models)).agg(F.avg("accuracy")).orderBy(key)


def first_per_run(results: DataFrame, keys: Sequence[str] = ("dataset", "model_name")) -> DataFrame:
    """The first known accuracy, cross-validation figures and feature count per key, rounded."""

    def first_known(name: str):
        return F.min_by(name, F.when(F.col(name).isNotNull(), F.col("seq")))

    rounded = ("accuracy", "cv_mean", "cv_std")
    return (
        results.groupBy(*keys)
        .agg(
            *[round_half_even(first_known(c), DECIMALS).alias(c) for c in rounded],
            first_known("n_features").alias("n_features"),
        )
        .orderBy(*keys)
    )


def best_per_dataset(results: DataFrame, key: str = "dataset") -> DataFrame:
    return results.groupBy(key).agg(F.max("accuracy").alias("best_accuracy"))


def mean_per_model(results: DataFrame, model: str = "model_name") -> DataFrame:
    return results.groupBy(model).agg(F.avg("accuracy").alias("mean_accuracy"))


def dataset_performance(results: DataFrame, key: str = "dataset") -> DataFrame:
    """Mean and best accuracy and cross-validation mean per dataset, rounded."""
    return results.groupBy(key).agg(
        *[
            round_half_even(f(c), DECIMALS).alias(f"{c}_{name}")
            for c in ("accuracy", "cv_mean")
            for name, f in [("mean", F.avg), ("max", F.max)]
        ]
    )


def best_run(results: DataFrame) -> DataFrame:
    """The row of highest accuracy; the first run on ties, unknown accuracies last."""
    return results.orderBy(F.desc_nulls_last("accuracy"), "seq").limit(1)


def uplift(results: DataFrame, sources: Sequence[str] = SOURCE_ORDER, prefix: str = "") -> DataFrame:
    """Per label source: best accuracy, gain over the original features, also in percent, and status."""
    names = {f"{prefix}{s}": i for i, s in enumerate(sources)}
    best = (
        results.where(F.col("dataset").isin(BASELINE, *names))
        .groupBy("dataset")
        .agg(F.max("accuracy").alias("best_accuracy"))
    )
    # One row per label source and the baseline: a window over four rows.
    baseline = F.max(F.when(F.col("dataset") == BASELINE, F.col("best_accuracy"))).over(Window.partitionBy())
    best = best.withColumn("baseline_accuracy", baseline)
    places = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    gain = F.col("best_accuracy") - F.col("baseline_accuracy")
    return (
        best.where(F.col("dataset") != BASELINE)
        .select(
            places[F.col("dataset")].alias("position"),
            "dataset",
            "best_accuracy",
            "baseline_accuracy",
            gain.alias("uplift"),
            F.try_divide(gain * 100.0, F.col("baseline_accuracy")).alias("uplift_percent"),
            F.when(gain > 0, "improved").otherwise("not improved").alias("status"),
        )
    )


def best_source(uplifts: DataFrame) -> DataFrame:
    """The label source of largest gain, if any gains; ties in report order."""
    return uplifts.where("uplift > 0").orderBy(F.desc("uplift"), "position").limit(1)
