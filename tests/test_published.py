"""The published tables, typed in: our operators must arrive at the same figures."""

import pytest
from pyspark.sql import functions as F

from shelfrank.functions import round_half_even, weighted_sum
from shelfrank.operators import results
from shelfrank.operators.evaluate import sorted_importances
from shelfrank.operators.rank import CATEGORY_WEIGHTS, best_group, with_group_norms
from shelfrank.operators.score import NEWNESS_SCORE, RANKING_SCORE, Extent, with_min_max

# Category, mean score, number, mean likes, final score.
CATEGORIES = [
    ("jewelry", 0.442, 4063, 101.351, 0.8664508758568165),
    ("women", 0.409, 12246, 95.1, 0.7653297513695742),
    ("house", 0.408, 10509, 95.298, 0.7327272583574607),
    ("beauty", 0.405, 3055, 91.377, 0.5650168563000422),
    ("kids", 0.415, 3872, 76.329, 0.5245199581224288),
    ("shoes", 0.369, 8165, 96.079, 0.47737488802852845),
    ("bags", 0.381, 5105, 85.835, 0.4204604350350428),
    ("accessories", 0.391, 5862, 67.451, 0.3543825481449244),
    ("men", 0.337, 8337, 83.027, 0.2010711517519544),
]

# Price, discount, likes, price score, discount score, likes score, composite score.
PRODUCTS = [
    (8.23, 74, 369, 0.8718566999655528, 0.9583333333333334, 0.9534883720930233, 0.9386155260396223),
    (5.46, 70, 379, 0.9195659662418189, 0.875, 0.979328165374677, 0.9360772759357023),
    (7.48, 68, 385, 0.8847743713399931, 0.8333333333333334, 0.9948320413436692, 0.9243708949398332),
    (1.92, 75, 336, 0.9805373751291767, 0.9791666666666666, 0.8682170542635659, 0.9239660021576183),
    (11.79, 71, 379, 0.8105408198415432, 0.8958333333333334, 0.979328165374677, 0.9205222466556471),
    (12.99, 76, 356, 0.7898725456424389, 1.0, 0.9198966408268734, 0.9179228295419245),
    (11.99, 71, 377, 0.8070961074750258, 0.8958333333333334, 0.9741602067183462, 0.9172493248541783),
    (10.99, 76, 349, 0.8243196693076128, 1.0, 0.9018087855297158, 0.9157683266263804),
    (3.92, 72, 345, 0.9460902514640027, 0.9166666666666666, 0.8914728682170543, 0.9099544844013278),
    (17.99, 72, 382, 0.703754736479504, 0.9166666666666666, 0.9870801033591732, 0.9092909989754874),
]
EXTENTS = {"current_price": Extent(0.79, 58.85), "discount": Extent(28.0, 76.0), "likes_count": Extent(0.0, 387.0)}

# Dataset, forest, neighbours and Bayes accuracy of the single-split study.
SINGLE_SPLIT = [
    ("original", 0.49040267908192436, 0.42726455934003105, 0.3499959160336519),
    ("kmeans", 0.51915380217267, 0.4280813526096545, 0.3326798987176346),
    ("hierarchical", 0.5151515151515151, 0.4275095973209181, 0.320264641019358),
    ("dbscan", 0.5202973127501429, 0.4271828800130687, 0.3392142448746222),
]
MODELS = ["Random Forest", "K-Nearest Neighbors", "Naive Bayes"]

# Dataset, model, accuracy, mean and deviation over folds; a part of the cross-validated study.
CROSS_VALIDATED = [
    ("original", "Decision Tree", 0.49979580168259413, 0.4825711525730195, 0.004291081069910879),
    ("original", "Random Forest", 0.49783549783549785, 0.49184210145015916, 0.0038100463823259162),
    ("original", "SVM", 0.4145225843339051, 0.4112639120345686, 0.005221053946582158),
    ("with_kmeans", "Random Forest", 0.5217675406354652, 0.5136713219321598, 0.0017487352895196853),
    ("with_dbscan", "Naive Bayes", 0.3392142448746222, 0.3410999473273998, 0.003518937095432424),
]


def test_category_ranking(spark):
    columns = "category string, avg_composite_score double, product_count long, avg_likes double, expected double"
    scored = with_group_norms(spark.createDataFrame(CATEGORIES, columns)).withColumn(
        "final_category_score", weighted_sum(CATEGORY_WEIGHTS)
    )
    ranked = scored.orderBy(F.desc("final_category_score"), "category").collect()
    assert [r["category"] for r in ranked] == [c[0] for c in CATEGORIES]
    assert all(r["final_category_score"] == r["expected"] for r in ranked)
    assert best_group(scored).first()["category"] == "jewelry"


def test_top_products(spark):
    columns = "current_price double, discount int, likes_count long, p double, d double, l double, expected double"
    df = spark.createDataFrame(PRODUCTS, columns)
    scaled = with_min_max(df, EXTENTS, RANKING_SCORE.sources, RANKING_SCORE.inverse)
    rows = scaled.withColumn("composite_score", weighted_sum(RANKING_SCORE.weights)).collect()
    for r in rows:
        assert r["price_score"] == pytest.approx(r["p"], abs=1e-12)
        assert r["discount_score"] == pytest.approx(r["d"], abs=1e-12)
        assert r["likes_score"] == pytest.approx(r["l"], abs=1e-12)
        assert r["composite_score"] == pytest.approx(r["expected"], abs=1e-12)
    scores = [r["composite_score"] for r in rows]
    assert scores == sorted(scores, reverse=True)


def test_newness_score(spark):
    df = spark.createDataFrame([(1.0, 0.5, 0.25, 1)], "likes_score double, discount_score double, price_score double, new_score int")
    assert df.select(weighted_sum(NEWNESS_SCORE.weights)).first()[0] == pytest.approx(0.70)


@pytest.fixture(scope="module")
def single_split(spark):
    rows = [
        (4 * i + j, d, f"name of {d}", m, 3 if d == "original" else 4, a)
        for i, (d, *accuracies) in enumerate(SINGLE_SPLIT)
        for j, (m, a) in enumerate(zip(MODELS, accuracies, strict=True))
    ]
    columns = "seq int, dataset string, dataset_name string, model string, n_features int, accuracy double"
    return spark.createDataFrame(rows, columns).repartition(5)


def test_accuracy_pivot(single_split):
    rows = results.accuracy_pivot(single_split).select("dataset", "n_features", *sorted(MODELS)).collect()
    assert [tuple(r) for r in rows] == [
        ("dbscan", 4, 0.4272, 0.3392, 0.5203),
        ("hierarchical", 4, 0.4275, 0.3203, 0.5152),
        ("kmeans", 4, 0.4281, 0.3327, 0.5192),
        ("original", 3, 0.4273, 0.35, 0.4904),
    ]
    missing = single_split.where("seq <> 0")
    assert results.accuracy_pivot(missing).where("dataset = 'original'").first()["Random Forest"] is None


def test_uplift(single_split):
    rows = results.uplift(single_split).orderBy("position").collect()
    assert [(r["dataset"], round(r["best_accuracy"], 4), round(r["uplift"], 4), round(r["uplift_percent"], 1), r["status"]) for r in rows] == [
        ("kmeans", 0.5192, 0.0288, 5.9, "improved"),
        ("hierarchical", 0.5152, 0.0247, 5.0, "improved"),
        ("dbscan", 0.5203, 0.0299, 6.1, "improved"),
    ]
    assert results.best_source(results.uplift(single_split)).first()["dataset"] == "dbscan"
    assert results.best_run(single_split).first()[1:4] == ("dbscan", "name of dbscan", "Random Forest")
    assert results.best_per_dataset(single_split).where("dataset = 'kmeans'").first()[1] == 0.51915380217267
    forest = results.mean_per_model(single_split, "model").where("model = 'Random Forest'").first()[1]
    assert forest == pytest.approx(0.5112513, abs=1e-6)


def test_no_source_is_best_if_none_gains(single_split):
    equal = single_split.withColumn("accuracy", F.lit(0.5))
    assert [r["status"] for r in results.uplift(equal).collect()] == ["not improved"] * 3
    assert results.best_source(results.uplift(equal)).count() == 0
    tied = equal.withColumn("accuracy", F.when(F.col("dataset") == "original", 0.4).otherwise(0.5))
    assert results.best_source(results.uplift(tied)).first()["dataset"] == "kmeans"
    assert results.best_run(equal).first()["seq"] == 0


@pytest.fixture(scope="module")
def cross_validated(spark):
    rows = [(i, *r, 3 if r[0] == "original" else 4) for i, r in enumerate(CROSS_VALIDATED)]
    columns = "seq int, dataset string, model_name string, accuracy double, cv_mean double, cv_std double, n_features int"
    return spark.createDataFrame(rows, columns)


def test_first_per_run(cross_validated):
    rows = results.first_per_run(cross_validated).collect()
    assert [tuple(r) for r in rows] == [
        ("original", "Decision Tree", 0.4998, 0.4826, 0.0043, 3),
        ("original", "Random Forest", 0.4978, 0.4918, 0.0038, 3),
        ("original", "SVM", 0.4145, 0.4113, 0.0052, 3),
        ("with_dbscan", "Naive Bayes", 0.3392, 0.3411, 0.0035, 4),
        ("with_kmeans", "Random Forest", 0.5218, 0.5137, 0.0017, 4),
    ]


def test_first_skips_unknown_values(cross_validated):
    twice = cross_validated.withColumn("accuracy", F.when(F.col("seq") < 0, 0.0)).unionByName(
        cross_validated.withColumn("seq", F.col("seq") + 10)
    )
    assert results.first_per_run(twice).first()["accuracy"] == 0.4998


def test_strict_pivot_refuses_duplicates(cross_validated):
    pivot = results.strict_pivot(cross_validated, "cv_mean")
    assert pivot.columns == ["dataset", "Decision Tree", "Naive Bayes", "Random Forest", "SVM"]
    assert pivot.where("dataset = 'with_kmeans'").first()["Random Forest"] == 0.5136713219321598
    with pytest.raises(ValueError):
        results.strict_pivot(cross_validated.union(cross_validated), "cv_mean")
    assert results.mean_pivot(cross_validated, "dataset", "model_name").count() == 3
    row = results.dataset_performance(cross_validated).where("dataset = 'original'").first()
    assert row["accuracy_max"] == 0.4998 and row["accuracy_mean"] == 0.4707


def test_importances(spark):
    values = {"current_price": 0.48502007054180757, "discount": 0.22672699529401735, "likes_count": 0.28825293416417497}
    rows = [("original", i, f, v) for i, (f, v) in enumerate(values.items())]
    df = spark.createDataFrame(rows, "dataset string, position int, feature string, importance double")
    found = sorted_importances(df).select("feature", round_half_even(F.col("importance") * 100, 2)).collect()
    assert [tuple(r) for r in found] == [("current_price", 48.50), ("likes_count", 28.83), ("discount", 22.67)]
