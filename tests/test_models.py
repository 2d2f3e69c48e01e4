from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfrank.operators.clusters import _spread, hierarchical_labels, kmeans_labels
from shelfrank.operators.evaluate import accuracy, cluster_importances, cross_validation, sorted_importances
from shelfrank.operators.models import Classifier, decision_tree, drawn_rows, kernel_machine, naive_bayes, nearest_neighbours, random_forest
from shelfrank.operators.naive_bayes import cross_predict_naive_bayes, fit_naive_bayes
from shelfrank.operators.neighbours import nearest_votes
from shelfrank.operators.variants import LabelError, Variant, comparison_variants, extended_variants
from shelfrank.plans.study import run_study, split_base, study_importances

F3 = ["x", "y", "z"]


def _table(spark, points, labels, start=0, fold=None):
    rows = [
        (start + i, int(c), *map(float, p), None if fold is None else int(fold[i]))
        for i, (p, c) in enumerate(zip(points, labels, strict=True))
    ]
    return spark.createDataFrame(rows, "row_id long, label int, x double, y double, z double, fold int").repartition(5)


def _vote(points, labels, ids, query, allowed):
    gaps = np.zeros(len(points))
    for j in range(points.shape[1]):
        gaps = gaps + (query[j] - points[:, j]) ** 2
    order = [i for i in np.lexsort((ids, gaps)) if allowed[i]][:5]
    counts = Counter(labels[order].tolist())
    return min(counts, key=lambda c: (-counts[c], c))


def _points(kind, n, rng):
    if kind == "discrete":
        return rng.integers(0, 6, (n, 3)).astype(float)
    points = rng.normal(size=(n, 3)) * [1.0, 10.0, 0.1]
    if kind == "a third equal":
        points[rng.random(n) < 0.34] = [0.5, 1.0, 0.0]
    if kind == "dense and far":
        points[: n // 3] = 3 + rng.normal(size=(n // 3, 3)) * 1e-4
        points[-3:] = [[900, 900, 900], [901, 900, 900], [-5000, 0, 0]]
    return points


@pytest.mark.parametrize("kind", ["plain", "discrete", "a third equal", "dense and far"])
def test_neighbours_equal_brute_force(spark, kind):
    rng = np.random.default_rng(5)
    points, queries = _points(kind, 900, rng), _points(kind, 200, rng)
    labels, ids = rng.integers(0, 4, 900), np.arange(900)
    train = _table(spark, points, labels)
    asked = _table(spark, queries, np.zeros(200), start=5000)
    found = {r["row_id"]: r["prediction"] for r in nearest_votes(train, asked, F3, tile_size=20).collect()}
    everyone = np.ones(900, bool)
    assert found == {5000 + i: _vote(points, labels, ids, q, everyone) for i, q in enumerate(queries)}


def test_neighbours_from_other_folds_only(spark):
    rng = np.random.default_rng(6)
    points, labels, fold = _points("a third equal", 400, rng), rng.integers(0, 3, 400), rng.integers(0, 5, 400)
    # One fold fills a region alone, so that its rows have no usable point nearby.
    points[fold == 2] += 40
    train = _table(spark, points, labels, fold=fold)
    found = {r["row_id"]: r["prediction"] for r in nearest_votes(train, train, F3, exclude="fold", tile_size=20).collect()}
    ids = np.arange(400)
    assert found == {i: _vote(points, labels, ids, points[i], fold != fold[i]) for i in range(400)}


def test_fewer_points_than_neighbours(spark):
    train = _table(spark, [[0, 0, 0], [1, 1, 1], [9, 9, 9]], [1, 0, 1])
    assert nearest_votes(train, train, F3).select("prediction").distinct().collect() == [(1,)]


def test_naive_bayes_equals_the_formula(spark):
    rng = np.random.default_rng(7)
    points, labels = rng.normal(size=(300, 3)), rng.integers(0, 3, 300)
    points[labels == 1, 0] += 2
    df = _table(spark, points, labels, fold=np.arange(300) % 5)

    def expected(train, query):
        eps = 1e-9 * points[train].var(axis=0).max()
        scores = []
        for c in range(3):
            p = points[train & (labels == c)]
            mean, var = p.mean(axis=0), p.var(axis=0) + eps
            scores.append(np.log(len(p) / train.sum()) - 0.5 * np.sum(np.log(2 * np.pi * var) + (query - mean) ** 2 / var))
        return int(np.argmax(scores))

    everyone = np.ones(300, bool)
    model = fit_naive_bayes(df, F3)
    found = {r["row_id"]: r["prediction"] for r in model.transform(df).collect()}
    assert found == {i: expected(everyone, points[i]) for i in range(300)}
    crossed = {r["row_id"]: r["prediction"] for r in cross_predict_naive_bayes(df, F3, 5).collect()}
    assert crossed == {i: expected(np.arange(300) % 5 != i % 5, points[i]) for i in range(300)}


def test_cross_validated_bayes_passes_over_the_rows_once_to_fit(spark):
    rng = np.random.default_rng(11)
    points, labels = rng.normal(size=(200, 3)), rng.integers(0, 3, 200)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    df = _table(spark, points, labels, fold=np.arange(200) % 5).withColumn("x", counted.asNondeterministic()("x"))
    predicted = cross_predict_naive_bayes(df, F3, 5)
    assert seen.value == 200
    # Rows of no fold are kept, and have no prediction.
    loose = _table(spark, points, labels, fold=np.arange(200) % 5).withColumn("fold", F.when(F.col("row_id") >= 10, F.col("fold")))
    rows = cross_predict_naive_bayes(loose, F3, 5).collect()
    assert sorted(r["row_id"] for r in rows) == list(range(200))
    assert {r["row_id"] for r in rows if r["prediction"] is None} == set(range(10))
    assert predicted.columns == [*df.columns, "prediction"]


def test_equal_densities_give_the_smaller_label(spark):
    df = _table(spark, [[0, 0, 0], [1, 1, 1]] * 2, [1, 1, 0, 0])
    assert fit_naive_bayes(df, F3).transform(df).select("prediction").distinct().collect() == [(0,)]


@pytest.fixture(scope="module")
def separable(spark):
    rng = np.random.default_rng(8)
    labels = rng.integers(0, 3, 240)
    points = rng.normal(size=(240, 3)) * 0.3 + labels[:, None] * [3.0, -3.0, 0.0]
    rows = [(i, f"class {c}", *map(float, p)) for i, (c, p) in enumerate(zip(labels, points, strict=True))]
    base = spark.createDataFrame(rows, "row_id long, category string, x double, y double, z double")
    return split_base(base).cache()


MODELS = [
    decision_tree(depth=4),
    random_forest(trees=3, depth=4),
    nearest_neighbours(),
    naive_bayes(),
    kernel_machine(waves=24, iterations=10),
]


@pytest.mark.parametrize("model", MODELS, ids=lambda m: m.name)
def test_separable_classes_are_learned(separable, model):
    predicted = model.predict(separable.where("NOT is_test"), separable.where("is_test"), F3)
    assert predicted.count() == 48
    assert accuracy(predicted).first()[0] > 0.9


def test_study_skips_what_fails(separable):
    def broken(*_):
        raise RuntimeError("cannot fit")

    gappy = separable.withColumn("x", F.when(F.col("row_id") != 5, F.col("x")))
    variants = [Variant("original", "plain", tuple(F3), separable), Variant("kmeans", "gaps", tuple(F3), gappy)]
    models = [naive_bayes(), Classifier("Broken", broken, broken), decision_tree(depth=3)]
    study = run_study(variants, models, cross_validate=True)
    rows = study.results.orderBy("seq").collect()
    assert [(r["dataset"], r["model_name"], r["n_features"]) for r in rows] == [
        ("original", "Naive Bayes", 3),
        ("original", "Decision Tree", 3),
    ]
    assert all(r["accuracy"] > 0.9 and r["cv_mean"] > 0.9 and 0 <= r["cv_std"] < 0.2 for r in rows)
    assert study.predictions.count() == 2 * 48 and study.cross_predictions.count() == 2 * 192
    with pytest.raises(RuntimeError):
        run_study(variants[:1], models[1:2])


def test_importances(spark, separable):
    wide = separable.withColumn("cluster", F.col("label"))
    v = Variant("dbscan", "", ("z", "cluster"), wide)
    long = study_importances([v], trees=3, depth=3)
    rows = sorted_importances(long).collect()
    assert [(r["feature"], r["is_cluster"]) for r in rows] == [("cluster", True), ("z", False)]
    assert sum(r["importance"] for r in rows) == pytest.approx(1)
    assert cluster_importances(long).first()["cluster_importance"] == pytest.approx(rows[0]["importance"])


def test_cross_validation_uses_the_population_deviation(spark):
    rows = [(0, 1, 1), (0, 1, 0), (1, 1, 1), (1, 0, 0)]
    df = spark.createDataFrame(rows, "fold int, label int, prediction int")
    assert cross_validation(df).first() == (0.75, 0.25)


def test_variants_with_misfitting_labels(spark):
    base = spark.createDataFrame(
        [(i, 1.0, 2, 3, "a", True) for i in range(4)],
        "row_id long, current_price double, discount int, likes_count long, category string, is_new boolean",
    )
    full = spark.createDataFrame([(i, i % 2) for i in range(4)], "row_id long, kmeans_cluster int")
    short = full.where("row_id < 3").withColumnRenamed("kmeans_cluster", "cluster")
    found = comparison_variants(base, {"kmeans": full, "dbscan": short})
    assert [v.name for v in found] == ["original", "kmeans"]
    with pytest.raises(LabelError):
        comparison_variants(base, {"dbscan": short})
    extended = extended_variants(base, {"kmeans": full, "dbscan": short})
    assert [(v.name, len(v.features)) for v in extended] == [("original", 4), ("with_kmeans", 5), ("with_dbscan", 5)]
    assert extended[2].df.where("cluster IS NULL").count() == 1
    with pytest.raises(LabelError):
        extended_variants(base, {})


def test_cluster_labels(spark, separable):
    for labels in (kmeans_labels(separable, F3, k=3), hierarchical_labels(separable, F3, k=3)):
        joined = separable.join(labels, "row_id")
        assert joined.count() == 240
        purity = joined.groupBy(labels.columns[1]).agg(F.count_distinct("label").alias("n"))
        assert [r["n"] for r in purity.collect()] == [1, 1, 1]


def test_neighbours_with_flag_and_cluster_features(spark):
    rng = np.random.default_rng(9)
    names = [*F3, "flag", "cluster"]

    def draw(n):
        return np.column_stack([rng.normal(size=(n, 3)), rng.integers(0, 2, n), rng.integers(-1, 3, n)])

    points, queries = draw(700), draw(120)
    labels, ids = rng.integers(0, 4, 700), np.arange(700)

    def table(rows, classes, start):
        data = [(start + i, int(c), *map(float, p[:3]), *map(int, p[3:])) for i, (p, c) in enumerate(zip(rows, classes, strict=True))]
        return spark.createDataFrame(data, "row_id long, label int, x double, y double, z double, flag int, cluster int")

    asked = table(queries, np.zeros(120), 5000)
    found = {r["row_id"]: r["prediction"] for r in nearest_votes(table(points, labels, 0), asked, names, tile_size=16).collect()}
    everyone = np.ones(700, bool)
    assert found == {5000 + i: _vote(points, labels, ids, q, everyone) for i, q in enumerate(queries)}


def test_a_bounded_sample_is_drawn_by_all_tasks_and_gathered_once(spark):
    rows = spark.range(200_000, numPartitions=8).selectExpr("id AS row_id", "int(id % 3) AS label", "double(id % 100) AS x")
    context, seen = spark.sparkContext, spark.sparkContext.accumulator(0)

    def count(part):
        seen.add(1)
        return part

    table = spark.createDataFrame(rows.rdd.mapPartitions(count), rows.schema)
    table.count()
    per_scan = seen.value
    before = seen.value
    sample = drawn_rows(table, 1000, "label", "x")
    assert per_scan == 8 and seen.value - before == 16  # counted and drawn, eight tasks each
    assert len(sample.inputFiles()) == 1 and 800 < sample.count() < 1200
    assert context.defaultParallelism == 8


def test_the_vectors_of_a_large_table_are_spread_over_tasks_of_bounded_size(spark):
    rows = spark.range(0, 5000, 1, 1).selectExpr("id AS row_id")
    sizes = _spread(rows, rows=100).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 50 and max(r["count"] for r in sizes) <= 110
    assert _spread(rows).rdd.getNumPartitions() == 1
