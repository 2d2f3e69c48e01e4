"""Classifiers behind one interface: fit on rows, predict rows.

Trees and forests are grown on the counts of all rows by cell (``trees``): thresholds are
chosen among bins and depth ends at 30.  The support-vector machine passes over all rows (``machines``).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.operators.machines import fit_kernel_machine
from shelfrank.operators.naive_bayes import cross_predict_naive_bayes, fit_naive_bayes
from shelfrank.operators.neighbours import nearest_votes
from shelfrank.operators.split import DRAWS, FOLDS, SEED, draw
from shelfrank.operators.trees import Forest, fit_trees
from shelfrank.session import write_table

# Rows of a bounded sample that one task holds.
ROWS_PER_TASK = 50_000


def bounded_rows(train: DataFrame, fit_rows: int | None, key: str = "row_id") -> DataFrame:
    """About ``fit_rows`` of the labelled rows, drawn by a hash of the key; all of them without a bound.

    For trials: no registered query and no job is fitted on a sample.
    """
    if fit_rows is None:
        return train
    n = train.count()
    return train if n <= fit_rows else train.where(draw(key, SEED + 1) < int(DRAWS * fit_rows / n))


def drawn_rows(train: DataFrame, fit_rows: int | None, *columns: str) -> DataFrame:
    """Columns of the rows of ``bounded_rows``, written once.

    All tasks draw; of a bounded sample only the rows drawn are gathered, so that those jobs have one small task each.
    """
    sample = bounded_rows(train, fit_rows).select(*columns)
    return write_table(sample if fit_rows is None else sample.repartition(-(-fit_rows // ROWS_PER_TASK)), "sample")


Predict = Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame]
CrossPredict = Callable[[DataFrame, Sequence[str]], DataFrame]


@dataclass(frozen=True)
class Classifier:
    """A named model: predictions for other rows, and for its own rows fold by fold."""

    name: str
    predict: Predict
    cross_predict: CrossPredict


def fit_forest(train: DataFrame, features: Sequence[str], trees: int = 100, **options) -> Forest:
    """Bootstrapped trees; each split looks at the whole part of the root of the feature count."""
    return fit_trees(train, features, trees=trees, subset=max(1, math.isqrt(len(features))), bootstrap=True, **options)


def forest_importances(model: Forest, features: Sequence[str], dataset: str) -> list[tuple[str, int, str, float]]:
    """Rows (dataset, position, feature, importance); the importances add up to 1."""
    return [(dataset, i, f, float(v)) for i, (f, v) in enumerate(zip(features, model.importances(), strict=True))]


def _fitted(name: str, predict: Predict) -> Classifier:
    """A classifier fitted on all rows it is given; a fold's model sees the rows of the other folds."""

    def cross_predict(train, features):
        parts = [predict(train.where(F.col("fold") != f), train.where(F.col("fold") == f), features) for f in range(FOLDS)]
        return reduce(DataFrame.unionByName, parts)

    return Classifier(name, predict, cross_predict)


def decision_tree(name: str = "Decision Tree", **options) -> Classifier:
    return _fitted(name, lambda train, rows, features: fit_trees(train, features, asked=rows, **options).transform(rows))


def random_forest(name: str = "Random Forest", trees: int = 100, **options) -> Classifier:
    return _fitted(name, lambda train, rows, features: fit_forest(train, features, trees, asked=rows, **options).transform(rows))


def nearest_neighbours(name: str = "KNN") -> Classifier:
    return Classifier(
        name,
        lambda train, rows, features: nearest_votes(train, rows, features),
        lambda train, features: nearest_votes(train, train, features, exclude="fold"),
    )


def naive_bayes(name: str = "Naive Bayes") -> Classifier:
    return Classifier(
        name,
        lambda train, rows, features: fit_naive_bayes(train, features).transform(rows),
        lambda train, features: cross_predict_naive_bayes(train, features, FOLDS),
    )


def kernel_machine(name: str = "SVM", **options) -> Classifier:
    return _fitted(name, lambda train, rows, features: fit_kernel_machine(train, features, **options).transform(rows))


def comparison_models() -> list[Classifier]:
    """The three models of the single-split comparison."""
    return [random_forest(trees=50), nearest_neighbours("K-Nearest Neighbors"), naive_bayes()]


def extended_models() -> list[Classifier]:
    """The five models of the cross-validated comparison."""
    return [decision_tree(), random_forest(trees=100), nearest_neighbours(), naive_bayes(), kernel_machine()]
