"""I14, J: the study jobs from files to files, with the model that SQL can fit too."""

from __future__ import annotations

from registry.core import Tables, query, rounded
from registry.sql import bayes_ctes, bayes_cv_ctes, split_ctes, with_tables
from shelfrank.operators.models import naive_bayes
from shelfrank.operators.variants import BASE_FEATURES, DISPLAY_NAMES, FLAG_FEATURE, LABEL_COLUMNS
from shelfrank.plans.jobs import comparison_job, extended_job
from shelfrank.session import scratch_path
from shelfrank.sources import scan_csv, write_csv

#: The label tables that have a file; the third one's is missing.
_METHODS = ("kmeans", "hierarchical")
_PLACED = """
placed AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY n.row_id) - 1 AS row_id, current_price, discount, likes_count, category,
         CASE WHEN is_new THEN 1 ELSE 0 END AS is_new_numeric, kmeans_cluster, hierarchical_cluster
  FROM normalised n JOIN labels_kmeans k ON n.row_id = k.row_id JOIN labels_hierarchical h ON n.row_id = h.row_id
)"""
_FOLDED = """
p_study AS MATERIALIZED (SELECT s.*, f.fold FROM p_split s LEFT JOIN p_folds f ON s.row_id = f.row_id)"""


def _files(t: Tables) -> tuple[str, dict[str, str], str]:
    """Base and labels in files without a common key, in the order of the products."""
    folder = scratch_path(t.spark, "study-job")
    base = t.normalised.orderBy("row_id").select("category", *BASE_FEATURES, "is_new")
    write_csv(base, f"{folder}/base")
    for method in _METHODS:
        write_csv(t.labels[method].orderBy("row_id").select(LABEL_COLUMNS[method]), f"{folder}/{method}")
    return f"{folder}/base", {m: f"{folder}/{m}" for m in LABEL_COLUMNS}, f"{folder}/out"


def _sets(features: tuple[str, ...], prefix: str) -> dict[str, tuple[str, ...]]:
    return {"original": features, **{f"{prefix}{m}": (*features, LABEL_COLUMNS[m]) for m in _METHODS}}


def _comparison_sql() -> str:
    ctes, rows = [], []
    for i, (name, features) in enumerate(_sets(BASE_FEATURES, "").items()):
        ctes.append(bayes_ctes("p_split", features, f"nb_{i}"))
        rows.append(
            f"""SELECT '{name}' AS dataset, '{DISPLAY_NAMES[name]}' AS dataset_name, 'Naive Bayes' AS model,
            {len(features)}::BIGINT AS n_features, round(avg((prediction = label)::INT), 6) AS accuracy FROM nb_{i}"""
        )
    return with_tables(" UNION ALL ".join(rows), _PLACED, split_ctes("placed", "p_"), *ctes)


@query("i14_comparison_job", _comparison_sql())
def comparison(t):
    base, labels, out = _files(t)
    comparison_job(t.spark, base, labels, out, models=[naive_bayes()], trees=5)
    return rounded(scan_csv(t.spark, f"{out}/clustering_comparison_results").drop("features"), "accuracy")


def _extended_sql() -> str:
    ctes, rows = [], []
    for i, (name, features) in enumerate(_sets((*BASE_FEATURES, FLAG_FEATURE), "with_").items()):
        ctes += [bayes_ctes("p_study", features, f"nb_{i}"), bayes_cv_ctes("p_study", features, f"cv_{i}")]
        rows.append(
            f"""SELECT 'Naive Bayes' AS model_name, '{name}' AS dataset, {len(features)}::BIGINT AS n_features,
            (SELECT round(avg((prediction = label)::INT), 6) FROM nb_{i}) AS accuracy,
            round(avg(a), 6) AS cv_mean, round(stddev_pop(a), 6) AS cv_std
            FROM (SELECT avg((prediction = label)::INT) AS a FROM cv_{i} GROUP BY fold)"""
        )
    return with_tables(" UNION ALL ".join(rows), _PLACED, split_ctes("placed", "p_"), _FOLDED, *ctes)


@query("i14_extended_job", _extended_sql())
def extended(t):
    base, labels, out = _files(t)
    extended_job(t.spark, base, labels, out, models=[naive_bayes()], trees=5)
    found = scan_csv(t.spark, f"{out}/detailed_comparison_results").drop("dataset_description")
    return rounded(found, "accuracy", "cv_mean", "cv_std")
