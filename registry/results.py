"""J: comparing the results of a study.

The study's subject is the embeddings table, small enough for the comparison
engine to find nearest neighbours by trying all pairs.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.core import VECTOR_FEATURES, Tables, query, rounded
from registry.sql import bayes_ctes, bayes_cv_ctes, neighbour_ctes, neighbour_cv_ctes, split_ctes, with_tables
from shelfrank.operators import results
from shelfrank.operators.variants import DISPLAY_NAMES, LABEL_COLUMNS

MODELS = ("KNN", "Naive Bayes")

_BASE = """
vec_base AS MATERIALIZED (
  SELECT vec_id AS row_id, round(list_sum(embedding::DOUBLE[]), 6) AS vec_sum,
         round(list_max(embedding::DOUBLE[]), 6) AS vec_max, round(list_min(embedding::DOUBLE[]), 6) AS vec_min,
         'class ' || label AS category FROM embeddings
),
vec_cuts AS (
  SELECT quantile_cont(vec_max, 0.25) AS c1, quantile_cont(vec_max, 0.5) AS c2, quantile_cont(vec_max, 0.75) AS c3
  FROM vec_base
)"""
_STUDY = """
vec_study AS MATERIALIZED (
  SELECT s.*, f.fold, s.row_id % 4 AS kmeans_cluster,
         (vec_max > c1)::INT + (vec_max > c2)::INT + (vec_max > c3)::INT AS hierarchical_cluster,
         CASE WHEN vec_min < -0.35 THEN -1 ELSE s.row_id % 3 END AS cluster
  FROM v_split s LEFT JOIN v_folds f ON s.row_id = f.row_id, vec_cuts
)"""


def _results_ctes() -> tuple[str, ...]:
    sets = {"original": VECTOR_FEATURES, **{m: (*VECTOR_FEATURES, c) for m, c in LABEL_COLUMNS.items()}}
    ctes, rows = [], []
    for i, (dataset, features) in enumerate(sets.items()):
        for j, model in enumerate(MODELS):
            test, cv = f"test_{i}_{j}", f"cv_{i}_{j}"
            if model == "KNN":
                ctes += [neighbour_ctes("vec_study", features, test), neighbour_cv_ctes("vec_study", features, cv)]
            else:
                ctes += [bayes_ctes("vec_study", features, test), bayes_cv_ctes("vec_study", features, cv)]
            rows.append(
                f"""SELECT {2 * i + j} AS seq, '{dataset}' AS dataset, '{DISPLAY_NAMES[dataset]}' AS dataset_name,
                '{model}' AS model_name, {len(features)} AS n_features,
                (SELECT avg((prediction = label)::INT) FROM {test}) AS accuracy,
                (SELECT avg(a) FROM (SELECT avg((prediction = label)::INT) AS a FROM {cv} GROUP BY fold)) AS cv_mean,
                (SELECT stddev_pop(a) FROM (SELECT avg((prediction = label)::INT) AS a FROM {cv} GROUP BY fold)) AS cv_std"""
            )
    return (_BASE, split_ctes("vec_base", "v_"), _STUDY, *ctes, "\nresults AS MATERIALIZED (" + " UNION ALL ".join(rows) + ")")


_CTES = _results_ctes()


def _sql(select: str, *extra: str) -> str:
    return with_tables(select, *_CTES, *extra)


def _half_even(expression: str) -> str:
    return f"round_even(({expression}) * 10000, 0) / 10000"


def _results(t: Tables):
    return t.vector_results.results


_FIGURES = "round(accuracy, 6) AS accuracy, round(cv_mean, 6) AS cv_mean, round(cv_std, 6) AS cv_std"


@query("i14_study_results", _sql(f"SELECT seq, dataset, dataset_name, model_name, n_features, {_FIGURES} FROM results"))
def study_results(t):
    return rounded(_results(t).drop("features"), "accuracy", "cv_mean", "cv_std")


_CELL = "max(CASE WHEN model_name = '{m}' THEN {v} END)"


@query(
    "j1_accuracy_pivot",
    _sql(
        f"""SELECT dataset, dataset_name, n_features, {_half_even(_CELL.format(m="KNN", v="accuracy"))} AS "KNN",
        {_half_even(_CELL.format(m="Naive Bayes", v="accuracy"))} AS "Naive Bayes", NULL::DOUBLE AS "Random Forest"
        FROM results GROUP BY dataset, dataset_name, n_features"""
    ),
)
def accuracy_pivot(t):
    # No forest was run here: its column is there, and empty.
    return results.accuracy_pivot(_results(t), model="model_name", models=[*MODELS, "Random Forest"])


def _pivot_sql(value: str, key: str, aggregate: str) -> str:
    cells = ", ".join(f"round({aggregate}(CASE WHEN model_name = '{m}' THEN {value} END), 6) AS \"{m}\"" for m in MODELS)
    return _sql(f"SELECT {key}, {cells} FROM results GROUP BY {key}")


@query("j2_strict_pivot", _pivot_sql("accuracy", "dataset", "max"))
def strict_pivot(t):
    return rounded(results.strict_pivot(_results(t), "accuracy", models=MODELS), *MODELS)


@query("j2_strict_pivot_cv", _pivot_sql("cv_mean", "dataset", "max"))
def strict_pivot_cv(t):
    return rounded(results.strict_pivot(_results(t), "cv_mean", models=MODELS), *MODELS)


@query("j3_mean_pivot", _pivot_sql("accuracy", "dataset_name", "avg"))
def mean_pivot(t):
    return rounded(results.mean_pivot(_results(t), model="model_name", models=MODELS), *MODELS)


@query(
    "j4_first_per_run",
    _sql(
        f"""SELECT dataset, model_name, {_half_even("accuracy")} AS accuracy, {_half_even("cv_mean")} AS cv_mean,
        {_half_even("cv_std")} AS cv_std, n_features FROM results"""
    ),
)
def first_per_run(t):
    return results.first_per_run(_results(t))


@query("j5_best_per_dataset", _sql("SELECT dataset, round(max(accuracy), 6) AS best_accuracy FROM results GROUP BY dataset"))
def best_per_dataset(t):
    return rounded(results.best_per_dataset(_results(t)), "best_accuracy")


@query("j6_mean_per_model", _sql("SELECT model_name, round(avg(accuracy), 6) AS mean_accuracy FROM results GROUP BY model_name"))
def mean_per_model(t):
    return rounded(results.mean_per_model(_results(t)), "mean_accuracy")


@query(
    "j7_dataset_performance",
    _sql(
        f"""SELECT dataset, {_half_even("avg(accuracy)")} AS accuracy_mean, {_half_even("max(accuracy)")} AS accuracy_max,
        {_half_even("avg(cv_mean)")} AS cv_mean_mean, {_half_even("max(cv_mean)")} AS cv_mean_max FROM results GROUP BY dataset"""
    ),
)
def dataset_performance(t):
    return results.dataset_performance(_results(t))


@query(
    "j8_best_run",
    _sql(
        """SELECT seq, dataset, model_name, round(accuracy, 6) AS accuracy FROM results
        ORDER BY results.accuracy DESC NULLS LAST, seq LIMIT 1"""
    ),
)
def best_run(t):
    return rounded(results.best_run(_results(t)).select("seq", "dataset", "model_name", "accuracy"), "accuracy")


_UPLIFT = """
best AS (SELECT dataset, max(accuracy) AS best_accuracy FROM results GROUP BY dataset),
gains AS MATERIALIZED (
  SELECT CASE b.dataset WHEN 'kmeans' THEN 0 WHEN 'hierarchical' THEN 1 ELSE 2 END AS position, b.dataset, b.best_accuracy,
         o.best_accuracy AS baseline_accuracy, b.best_accuracy - o.best_accuracy AS uplift,
         (b.best_accuracy - o.best_accuracy) * 100 / nullif(o.best_accuracy, 0) AS uplift_percent,
         CASE WHEN b.best_accuracy > o.best_accuracy THEN 'improved' ELSE 'not improved' END AS status
  FROM best b, (SELECT best_accuracy FROM best WHERE dataset = 'original') o WHERE b.dataset <> 'original'
)"""
_GAIN = """position, dataset, round(best_accuracy, 6) AS best_accuracy, round(baseline_accuracy, 6) AS baseline_accuracy,
        round(uplift, 6) AS uplift, round(uplift_percent, 6) AS uplift_percent, status"""
_COMPUTED = ("best_accuracy", "baseline_accuracy", "uplift", "uplift_percent")


@query("j9_uplift", _sql(f"SELECT {_GAIN} FROM gains", _UPLIFT))
def uplift(t):
    return rounded(results.uplift(_results(t)), *_COMPUTED)


@query("j10_status", _sql("SELECT dataset, status FROM gains", _UPLIFT))
def status(t):
    return results.uplift(_results(t)).select("dataset", "status")


@query(
    "j11_best_source",
    _sql(f"SELECT {_GAIN} FROM gains WHERE gains.uplift > 0 ORDER BY gains.uplift DESC, gains.position LIMIT 1", _UPLIFT),
)
def best_source(t):
    return rounded(results.best_source(results.uplift(_results(t))), *_COMPUTED)


# A second result table in which label sources gain, two of them alike: the errors of the study, one source twice.
_MIRROR = """
mirror AS MATERIALIZED (
  SELECT dataset, 1 - accuracy AS accuracy FROM results WHERE dataset IN ('original', 'kmeans', 'dbscan')
  UNION ALL SELECT 'hierarchical', 1 - accuracy FROM results WHERE dataset = 'kmeans')"""
_MIRROR_GAINS = _MIRROR + "," + _UPLIFT.replace("FROM results", "FROM mirror")


def _mirrored(t: Tables):
    errors = _results(t).select("dataset", (1 - F.col("accuracy")).alias("accuracy"))
    twice = errors.where("dataset = 'kmeans'").withColumn("dataset", F.lit("hierarchical"))
    return errors.where("dataset <> 'hierarchical'").unionByName(twice)


@query("j10_status_gains", _sql("SELECT dataset, status FROM gains", _MIRROR_GAINS))
def status_gains(t):
    return results.uplift(_mirrored(t)).select("dataset", "status")


@query(
    "j11_best_source_gains",
    _sql(f"SELECT {_GAIN} FROM gains WHERE gains.uplift > 0 ORDER BY gains.uplift DESC, gains.position LIMIT 1", _MIRROR_GAINS),
)
def best_source_gains(t):
    return rounded(results.best_source(results.uplift(_mirrored(t))), *_COMPUTED)
