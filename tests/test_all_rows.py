"""Registered models are fitted on all rows: what only a few rows say is learned too."""

import numpy as np
from pyspark.sql import functions as F

import registry.jobs
import registry.models
from registry.core import Tables
from shelfrank.operators.variants import BASE_FEATURES, LABEL_COLUMNS, Variant
from shelfrank.plans.study import study_importances, train_rows


def _rare(spark, rows, copies=3):
    """Odd values have their own class, on ``copies`` rows each; all others are even and have the other one. Test rows ask for the odd ones."""
    rare = [(float(v), 1, c) for v in range(1, 16, 2) for c in range(copies)]
    common = [(float(i % 8 * 2), 0, i // 8 % 5) for i in range(rows - len(rare))]
    made = [(i, x, label, fold, False) for i, (x, label, fold) in enumerate(common + rare)]
    made += [(rows + v, float(v), v % 2, None, True) for v in range(16)]
    table = spark.createDataFrame(made, "row_id long, x double, label int, fold int, is_test boolean").repartition(4)
    return table.selectExpr("row_id", "label", "fold", "is_test", *[f"x AS {f}" for f in BASE_FEATURES]).cache()


def _tables(spark, study):
    t = Tables(spark, "nowhere")
    t.__dict__["study"] = study
    return t


def _all_right(predicted):
    rows = predicted.collect()
    return len(rows) == 16 and all(r["prediction"] == r["label"] for r in rows)


def test_the_forest_learns_from_all_rows(spark):
    assert _all_right(registry.models.forest(_tables(spark, _rare(spark, 9000))))


def test_the_tree_whose_rows_are_compared_learns_from_all_rows(spark, monkeypatch):
    monkeypatch.setattr(registry.models, "_rows_of", lambda predicted: predicted)
    assert _all_right(registry.models.tree_rows(_tables(spark, _rare(spark, 9000))))


def test_the_kernel_machine_passes_over_all_rows(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    study = _rare(spark, 5000)
    read = study.withColumn("current_price", counted.asNondeterministic()("current_price"))
    predicted = registry.models.kernel(_tables(spark, read))
    assert seen.value >= 20 * 5000
    assert predicted.count() == 16


def _shares(importances):
    return sorted((r["dataset"], r["feature"], r["importance"]) for r in importances.collect())


def test_importances_come_from_all_rows(spark):
    rng = np.random.default_rng(12)
    made = [(i, *map(float, rng.normal(size=3).round(1)), int(rng.integers(0, 3)), i % 5 == 0) for i in range(5000)]
    rows = spark.createDataFrame(made, "row_id long, current_price double, discount double, likes_count double, label int, is_test boolean")
    t = Tables(spark, "nowhere")
    t.__dict__["variants"] = [Variant("original", "", BASE_FEATURES, rows.cache())]
    assert _shares(t.train_importances) == _shares(study_importances(t.variants, trees=50, rows=train_rows))
    assert _shares(t.overall_importances) == _shares(study_importances(t.variants, trees=100))


def test_the_study_job_fits_its_importances_on_all_rows(spark, monkeypatch):
    rng = np.random.default_rng(13)
    made = [(i, "abc"[rng.integers(0, 3)], *map(float, rng.normal(size=3).round(1)), i % 2 == 0) for i in range(3000)]
    kinds = "row_id long, category string, current_price double, discount double, likes_count double, is_new boolean"
    t = Tables(spark, "nowhere")
    t.__dict__["normalised"] = spark.createDataFrame(made, kinds).cache()
    t.__dict__["labels"] = {
        m: t.normalised.select("row_id", (F.col("row_id") % k).cast("int").alias(LABEL_COLUMNS[m])) for m, k in (("kmeans", 4), ("hierarchical", 3))
    }
    jobs, run = [], registry.jobs.extended_job
    monkeypatch.setattr(registry.jobs, "extended_job", lambda *a, **b: jobs.append(run(*a, **b)))
    registry.jobs.extended(t)
    assert _shares(jobs[0].importances) == _shares(study_importances(jobs[0].variants, trees=5))


def test_the_forest_of_the_comparison_learns_from_all_rows(spark):
    t = _tables(spark, _rare(spark, 9000))
    t.__dict__["variants"] = [Variant("original", "", BASE_FEATURES, t.study)]
    assert _all_right(registry.models.predictions(t).where("model_name = 'Random Forest'"))
    figures = {r["model_name"]: r["accuracy"] for r in registry.models.grid(t).collect()}
    assert len(figures) == 3 and figures["Random Forest"] == 1.0


def test_the_models_of_the_extended_grid_learn_from_all_rows(spark):
    t = _tables(spark, _rare(spark, 2000))
    t.__dict__["variants"] = [Variant("original", "", BASE_FEATURES, t.study)]
    figures = {r["model_name"]: (r["accuracy"], r["cv_mean"]) for r in registry.models.extended_grid(t).collect()}
    assert len(figures) == 5
    # The rows of a rare value lie in three folds, so each is known to the models of its own.
    assert figures["Decision Tree"] == figures["Random Forest"] == (1.0, 1.0)
    ranges = {r["model_name"]: r for r in registry.models.extended_ranges(t).collect()}
    assert all((r["n_test"], r["n_crossed"], r["each_row_once"], r["known_classes"]) == (16, 2000, True, True) for r in ranges.values())
