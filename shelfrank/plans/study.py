"""The whole study: do extra features improve the classification of categories?"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.operators.evaluate import accuracy, cross_validation
from shelfrank.operators.models import Classifier, fit_forest, forest_importances
from shelfrank.operators.split import with_fold, with_label_code, with_test_flag
from shelfrank.operators.variants import Variant
from shelfrank.session import scratch_path, small_table, write_table

log = logging.getLogger(__name__)

RUN = ("dataset", "model_name")


def split_base(base: DataFrame, category: str = "category") -> DataFrame:
    """Add label codes, the test flag, and the folds of the training rows.

    All variants have the same rows and classes, so one split serves them all.
    """
    flagged = with_test_flag(with_label_code(base, category))
    # The limits of the folds come from the training rows; the fold is then a comparison, so no join by row.
    return with_fold(flagged, among=~F.col("is_test"))


def stored(df: DataFrame) -> DataFrame:
    """Write a table that models will pass over many times, spread over all tasks."""
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return write_table(df.repartition(tasks, "row_id"), "study")


@dataclass(frozen=True)
class StudyResults:
    """One row per run in ``results``; every predicted row in the other two."""

    results: DataFrame
    predictions: DataFrame
    cross_predictions: DataFrame | None


def run_study(
    variants: Sequence[Variant],
    models: Sequence[Classifier],
    cross_validate: bool = False,
    parallel: int = 4,
) -> StudyResults:
    """Fit and test every model on every variant; a run that fails is logged and left out of all results.

    Each run writes its predictions to a folder of its own; all figures are then aggregates over those
    of the runs that succeeded.
    Runs overlap, since the small jobs of one leave tasks free for another.
    """
    spark = variants[0].df.sparkSession
    root = scratch_path(spark, "predictions")
    runs = [(v, m) for v in variants for m in models]
    gappy = {v.name for v in variants if _has_gaps(v)}

    def run(place: int) -> bool:
        variant, model = runs[place]
        try:
            if variant.name in gappy:
                raise ValueError("a feature has missing values")
            train = variant.df.where("NOT is_test")
            _keep(model.predict(train, variant.df.where("is_test"), variant.features), f"{root}/test/{place}")
            if cross_validate:
                _keep(model.cross_predict(train, variant.features), f"{root}/folds/{place}")
            return True
        except Exception as error:  # noqa: BLE001 - one failing model must not end the study
            log.warning("%s with %s skipped: %s", variant.name, model.name, error)
            return False

    with ThreadPoolExecutor(parallel) as pool:
        good = list(pool.map(run, range(len(runs))))
    places = [i for i, done in enumerate(good) if done]
    succeeded = [runs[i] for i in places]
    if not succeeded:
        raise RuntimeError("no model could be fitted")

    rows = [
        (i, v.name, v.description, m.name, len(v.features), list(v.features)) for i, (v, m) in enumerate(succeeded)
    ]
    schema = "seq int, dataset string, dataset_name string, model_name string, n_features int, features array<string>"
    results = small_table(spark, rows, schema)
    predictions = _read_runs(spark, f"{root}/test", places, succeeded)
    cross_predictions = _read_runs(spark, f"{root}/folds", places, succeeded) if cross_validate else None
    figures = results.join(accuracy(predictions, RUN), list(RUN))
    if cross_predictions is not None:
        figures = figures.join(cross_validation(cross_predictions, RUN), list(RUN))
    # A row per run.
    return StudyResults(write_table(figures, "results"), predictions, cross_predictions)


def _has_gaps(variant: Variant) -> bool:
    gap = F.lit(False)
    for f in variant.features:
        gap = gap | F.col(f).isNull()
    return not variant.df.where(gap).isEmpty()


def _keep(predicted: DataFrame, path: str) -> None:
    """Write one run to its own folder: jobs that overlap must not share an output folder."""
    columns = [c for c in ("row_id", "label", "fold", "prediction") if c in predicted.columns]
    predicted.select(*columns).write.parquet(path)


def _read_runs(spark, root: str, places: Sequence[int], pairs: Sequence[tuple[Variant, Classifier]]) -> DataFrame:
    """The predictions of some runs, each row with the names of its run."""
    parts = [
        spark.read.parquet(f"{root}/{i}").withColumns({"dataset": F.lit(v.name), "model_name": F.lit(m.name)})
        for i, (v, m) in zip(places, pairs, strict=True)
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


IMPORTANCE_SCHEMA = "dataset string, position int, feature string, importance double"


def study_importances(
    variants: Sequence[Variant],
    trees: int,
    rows: Callable[[DataFrame], DataFrame] = lambda df: df,
    **options,
) -> DataFrame:
    """Forest importances per variant as a long table, fitted on all rows or on all those ``rows`` selects."""
    spark = variants[0].df.sparkSession
    found = []
    for v in variants:
        model = fit_forest(rows(v.df), v.features, trees=trees, **options)
        found += forest_importances(model, v.features, v.name)
    return small_table(spark, found, IMPORTANCE_SCHEMA)


def train_rows(df: DataFrame) -> DataFrame:
    return df.where("NOT is_test")
