"""Study jobs from files to files, on classes that only the labels tell apart."""

import pytest

from shelfrank.operators.models import decision_tree, naive_bayes
from shelfrank.operators.variants import LABEL_COLUMNS, LabelError
from shelfrank.plans.jobs import comparison_job, extended_job
from shelfrank.sources import scan_csv, write_csv

ROWS = 240


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """Prices say nothing of the category, the k-means label all of it; the density labels are too few, the third file is missing."""
    folder = tmp_path_factory.mktemp("study")
    rows = [(f"c{i % 3}", float(i * 37 % 11), float(i * 53 % 7), i * 29 % 13, i % 2 == 0) for i in range(ROWS)]
    base = spark.createDataFrame(rows, "category string, current_price double, discount double, likes_count long, is_new boolean")
    # Files cut elsewhere than those of the labels: rows meet by position alone.
    write_csv(base.coalesce(1), f"{folder}/base")
    labels = spark.createDataFrame([(i, i % 3) for i in range(ROWS)], "i long, kmeans_cluster int")
    write_csv(labels.repartitionByRange(5, "i").sortWithinPartitions("i").select("kmeans_cluster"), f"{folder}/kmeans")
    write_csv(spark.createDataFrame([(i % 2,) for i in range(ROWS - 1)], "cluster int").coalesce(1), f"{folder}/dbscan")
    return f"{folder}/base", {m: f"{folder}/{m}" for m in LABEL_COLUMNS}


MODELS = [naive_bayes(), decision_tree()]


def test_comparison_job(spark, files, tmp_path):
    job = comparison_job(spark, *files, str(tmp_path), models=MODELS, trees=3)
    assert [v.name for v in job.variants] == ["original", "kmeans"]
    runs = {(r.dataset, r.model): r for r in scan_csv(spark, f"{tmp_path}/clustering_comparison_results").collect()}
    assert len(runs) == 4 and runs["original", "Naive Bayes"].n_features == 3
    assert runs["kmeans", "Naive Bayes"].accuracy == runs["kmeans", "Decision Tree"].accuracy == 1.0
    assert runs["original", "Naive Bayes"].accuracy < 0.7
    assert scan_csv(spark, f"{tmp_path}/comparison_summary").where("dataset = 'kmeans'").first()["Decision Tree"] == 1.0
    gains = scan_csv(spark, f"{tmp_path}/clustering_impact").collect()
    assert [(g.dataset, g.status) for g in gains] == [("kmeans", "improved")]
    shares = scan_csv(spark, f"{tmp_path}/feature_importance").where("dataset = 'kmeans'").collect()
    assert sum(s.importance for s in shares) == pytest.approx(1.0)
    assert [s.feature for s in shares if s.is_cluster] == ["kmeans_cluster"]


def test_extended_job(spark, files, tmp_path):
    job = extended_job(spark, *files, str(tmp_path), models=MODELS, trees=3)
    # The short labels leave a gap, so their variant has no results.
    assert [v.name for v in job.variants] == ["original", "with_kmeans"]
    runs = scan_csv(spark, f"{tmp_path}/detailed_comparison_results").collect()
    assert len(runs) == 4
    best = [r for r in runs if r.dataset == "with_kmeans"]
    assert all((r.accuracy, r.cv_mean, r.cv_std, r.n_features) == (1.0, 1.0, 0.0, 5) for r in best)
    assert scan_csv(spark, f"{tmp_path}/summary_comparison_results").count() == 4
    assert scan_csv(spark, f"{tmp_path}/dataset_performance").where("dataset = 'with_kmeans'").first().accuracy_max == 1.0
    predicted = spark.read.parquet(f"{tmp_path}/predictions")
    assert predicted.groupBy("dataset", "model_name").count().select("count").distinct().collect() == [(ROWS // 5,)]
    plan = predicted.where("dataset = 'original' AND model_name = 'Naive Bayes'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(dataset" in plan


def test_jobs_need_a_base_and_labels(spark, files, tmp_path):
    base, labels = files
    with pytest.raises(FileNotFoundError):
        comparison_job(spark, f"{base}-gone", labels, str(tmp_path))
    with pytest.raises(LabelError):
        comparison_job(spark, base, {"hierarchical": labels["hierarchical"]}, str(tmp_path))
    with pytest.raises(LabelError):
        extended_job(spark, base, {"hierarchical": labels["hierarchical"]}, str(tmp_path))
