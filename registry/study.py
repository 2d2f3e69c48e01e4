"""I: codes, splits, folds, models and their evaluation."""

from __future__ import annotations

from registry.core import NARROW, ORACLES, query, rounded
from registry.sql import bayes_ctes, bayes_cv_ctes, neighbour_ctes, with_tables
from shelfrank.operators.evaluate import accuracy, cross_validation
from shelfrank.operators.naive_bayes import cross_predict_naive_bayes, fit_naive_bayes
from shelfrank.operators.neighbours import nearest_votes
from shelfrank.operators.split import FOLDS, with_label_code, with_test_flag
from shelfrank.operators.variants import BASE_FEATURES, LABEL_COLUMNS


@query("i1_label_codes", with_tables("SELECT row_id, category, label FROM study"))
def codes(t):
    return with_label_code(t.normalised.select("row_id", "category"))


@query("i2_stratified_split", with_tables("SELECT row_id, label, is_test FROM study"))
def split(t):
    return t.study.select("row_id", "label", "is_test")


@query("i2_stratified_split_narrowed", ORACLES["i2_stratified_split"])
def split_narrowed(t):
    coded = with_label_code(t.normalised.select("row_id", "category"))
    return with_test_flag(coded, small=NARROW).select("row_id", "label", "is_test")


@query("i9_stratified_folds", with_tables("SELECT row_id, label, fold FROM study WHERE NOT is_test"))
def folds(t):
    return t.train.select("row_id", "label", "fold")


_KMEANS = (*BASE_FEATURES, LABEL_COLUMNS["kmeans"])


@query("i5_nearest_neighbours", with_tables("SELECT * FROM knn", neighbour_ctes("study", BASE_FEATURES, "knn")))
def nearest(t):
    return nearest_votes(t.train, t.test, BASE_FEATURES).select("row_id", "label", "prediction")


# Trying all pairs in SQL again would take too long; the tests compare this case on small data.
@query("i5_nearest_neighbours_kmeans")
def nearest_kmeans(t):
    return nearest_votes(t.train, t.test, _KMEANS).select("row_id", "label", "prediction")


@query("i6_naive_bayes", with_tables("SELECT * FROM nb", bayes_ctes("study", BASE_FEATURES, "nb")))
def naive_bayes(t):
    model = fit_naive_bayes(t.train, BASE_FEATURES)
    return model.transform(t.test).select("row_id", "label", "prediction")


@query("i6_naive_bayes_kmeans", with_tables("SELECT * FROM nb", bayes_ctes("study", _KMEANS, "nb")))
def naive_bayes_kmeans(t):
    model = fit_naive_bayes(t.train, _KMEANS)
    return model.transform(t.test).select("row_id", "label", "prediction")


@query(
    "i8_accuracy",
    with_tables(
        "SELECT round(avg((prediction = label)::INT), 6) AS accuracy FROM nb", bayes_ctes("study", BASE_FEATURES, "nb")
    ),
)
def measured(t):
    return rounded(accuracy(fit_naive_bayes(t.train, BASE_FEATURES).transform(t.test)), "accuracy")


@query(
    "i10_cross_validation",
    with_tables(
        """SELECT round(avg(a), 6) AS cv_mean, round(stddev_pop(a), 6) AS cv_std
        FROM (SELECT avg((prediction = label)::INT) AS a FROM nb GROUP BY fold)""",
        bayes_cv_ctes("study", BASE_FEATURES, "nb"),
    ),
)
def cross_validated(t):
    predictions = cross_predict_naive_bayes(t.train, BASE_FEATURES, FOLDS)
    return rounded(cross_validation(predictions), "cv_mean", "cv_std")
