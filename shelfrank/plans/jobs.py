"""The two study jobs, from the files of a base table and its cluster labels to files of results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.operators import results as reports
from shelfrank.operators.evaluate import sorted_importances
from shelfrank.operators.models import Classifier, comparison_models, extended_models
from shelfrank.operators.variants import BASE_FEATURES, Variant, comparison_variants, extended_variants
from shelfrank.plans.study import StudyResults, run_study, split_base, study_importances, train_rows
from shelfrank.sources import read_tables, scan_in_order, write_csv

BASE = "base"
CATEGORY = "category"


@dataclass(frozen=True)
class StudyJob:
    """What a finished job wrote, as tables that can be read on."""

    variants: tuple[Variant, ...]
    study: StudyResults
    importances: DataFrame


def load_study(spark: SparkSession, base: str, labels: Mapping[str, str]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The base table with split and folds, and the label tables that can be opened.

    The files share no key: rows meet by their position, ``row_id`` here.
    """
    opened = read_tables(
        {name: (lambda path=path: scan_in_order(spark, path)) for name, path in {BASE: base, **labels}.items()}
    )
    if BASE not in opened:
        raise FileNotFoundError(base)
    table = opened.pop(BASE)
    columns = [c for c in (*BASE_FEATURES, "is_new") if c in table.columns]
    return split_base(table.select("row_id", *columns, CATEGORY), CATEGORY), opened


def comparison_job(
    spark: SparkSession,
    base: str,
    labels: Mapping[str, str],
    folder: str,
    models: Sequence[Classifier] | None = None,
    trees: int = 50,
) -> StudyJob:
    """Three models on the original features and one variant per label file of the base's length.

    Writes ``clustering_comparison_results``, ``comparison_summary``, ``clustering_impact`` and
    ``feature_importance`` as CSV folders.  Label files that are missing or do not fit are logged
    and left out; with none left the job is refused.
    """
    table, tables = load_study(spark, base, labels)
    variants = comparison_variants(table, tables)
    study = run_study(variants, models or comparison_models())
    ran = _ran(variants, study)
    importances = study_importances(ran, trees, rows=train_rows)
    runs = study.results.withColumnRenamed("model_name", "model")
    columns = ("dataset", "dataset_name", "model", "accuracy", "n_features", "features")
    write_csv(runs.orderBy("seq").select(*columns[:-1], F.to_json("features").alias("features")), f"{folder}/clustering_comparison_results")
    write_csv(reports.accuracy_pivot(runs), f"{folder}/comparison_summary")
    _write_common(study, importances, "", folder)
    return StudyJob(tuple(ran), study, importances)


def extended_job(
    spark: SparkSession,
    base: str,
    labels: Mapping[str, str],
    folder: str,
    models: Sequence[Classifier] | None = None,
    trees: int = 100,
) -> StudyJob:
    """Five cross-validated models; shorter label files are attached as far as they reach, newness is a feature.

    Writes ``detailed_comparison_results``, ``summary_comparison_results``, ``dataset_performance``,
    ``clustering_impact`` and ``feature_importance`` as CSV folders, and every predicted row as
    the Parquet table ``predictions``.  A variant whose labels have gaps is logged and left out.
    """
    table, tables = load_study(spark, base, labels)
    variants = extended_variants(table, tables)
    study = run_study(variants, models or extended_models(), cross_validate=True)
    ran = _ran(variants, study)
    importances = study_importances(ran, trees)
    detailed = study.results.withColumnRenamed("dataset_name", "dataset_description").orderBy("seq")
    columns = ("model_name", "accuracy", "cv_mean", "cv_std", "dataset", "dataset_description", "n_features")
    write_csv(detailed.select(*columns), f"{folder}/detailed_comparison_results")
    write_csv(reports.first_per_run(study.results), f"{folder}/summary_comparison_results")
    write_csv(reports.dataset_performance(study.results), f"{folder}/dataset_performance")
    study.predictions.write.partitionBy("dataset", "model_name").parquet(f"{folder}/predictions")
    _write_common(study, importances, "with_", folder)
    return StudyJob(tuple(ran), study, importances)


def _ran(variants: Sequence[Variant], study: StudyResults) -> list[Variant]:
    """The variants that gave results; there is one row per run to look at."""
    names = {r["dataset"] for r in study.results.select("dataset").distinct().collect()}
    return [v for v in variants if v.name in names]


def _write_common(study: StudyResults, importances: DataFrame, prefix: str, folder: str) -> None:
    gains = reports.uplift(study.results, prefix=prefix)
    write_csv(gains.orderBy("position").drop("position"), f"{folder}/clustering_impact")
    write_csv(sorted_importances(importances), f"{folder}/feature_importance")
