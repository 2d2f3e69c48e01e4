"""The tree's nodes and leaves are bounded, and a query is compared with few points."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfrank.operators import neighbours
from shelfrank.operators.neighbours import Search, build_tree, nearest_votes, search_node, split_leaves

NODE, LEAF, K = 64, 16, 5


def cloud(kind, n, rng):
    if kind == "one feature":
        return rng.normal(size=(n, 1))
    if kind == "seven features":
        return rng.normal(size=(n, 7))
    points = rng.normal(size=(n, 3))
    if kind == "heavy values":
        points[: n // 2, 0] = points[n // 4 : 3 * n // 4, 1] = 0.0
        points[: n // 3] = 1.0
    if kind == "few values":
        points = np.round(points)
    return points


def frame(spark, points, first=0, fold=None):
    names = [f"f{c}" for c in range(points.shape[1])]
    extra = (lambda i: (int(fold[i]),)) if fold is not None else (lambda i: ())
    rows = [(first + i, i % 3, *extra(i), *map(float, p)) for i, p in enumerate(points)]
    schema = "row_id long, label int" + (", fold int" if fold is not None else "") + "".join(f", {n} double" for n in names)
    return spark.createDataFrame(rows, schema), names


def votes(points, queries, ids, usable=None):
    out = []
    for i, q in enumerate(queries):
        total = np.zeros(len(points))
        for c in range(points.shape[1]):
            total = total + (q[c] - points[:, c]) * (q[c] - points[:, c])
        rows = np.arange(len(points)) if usable is None else np.flatnonzero(usable(i))
        near = rows[np.lexsort((ids[rows], total[rows]))[:K]]
        labels = near % 3
        out.append(int(np.bincount(labels, minlength=3).argmax()))
    return out


@pytest.mark.parametrize("kind", ["plain", "one feature", "seven features", "heavy values", "few values"])
def test_votes_and_nodes(spark, kind):
    rng = np.random.default_rng(3)
    points, queries = cloud(kind, 1500, rng), cloud(kind, 150, rng)
    queries[::10] += 1000.0  # far from all points
    train, names = frame(spark, points)
    asked, _ = frame(spark, queries, 10_000)
    found = {r["row_id"]: r["prediction"] for r in nearest_votes(train, asked, names, tile_size=LEAF, node_size=NODE).collect()}
    assert [found[10_000 + i] for i in range(len(queries))] == votes(points, queries, np.arange(len(points)))

    distinct = train.dropDuplicates(names)
    sizes = [r["count"] for r in build_tree(distinct, names, None, NODE).points.groupBy("_path").count().collect()]
    assert max(sizes) <= NODE and sum(sizes) == distinct.count()


def test_visits_are_few(spark):
    rng = np.random.default_rng(4)
    points, queries = cloud("heavy values", 4000, rng), cloud("plain", 200, rng)
    queries[:50] += 1000.0
    train, names = frame(spark, points)
    asked = frame(spark, queries)[0].withColumnRenamed("row_id", "_query").drop("label")
    search = Search(build_tree(train.dropDuplicates(names), names, None, NODE), "label", "row_id", K, LEAF)
    nodes = search.tree.points.select("_path").distinct().count()
    home = search._home(asked)
    assert home.count() == 200
    inside = search._look(home.withColumn("_reach", F.lit(None).cast("double")))
    reached = home.join(inside.groupBy("_query").agg(F.max("distance").alias("_reach")), "_query")
    visits = [r["count"] for r in search.visits(reached).groupBy("_query").count().collect()]
    assert nodes > 40 and np.mean(visits) < nodes / 4


@pytest.mark.parametrize("top", [1, 2, 4])
def test_the_top_of_the_tree_is_walked_in_the_tasks(spark, monkeypatch, top):
    """However many levels the tasks hold, homes and visits are those of the boxes; a shallow tree needs no join."""
    rng = np.random.default_rng(8)
    points, queries = cloud("heavy values", 3000, rng), cloud("plain", 100, rng)
    fold = np.arange(3000) // 600
    train, names = frame(spark, points, fold=fold)
    asked = frame(spark, queries, fold=fold[::30])[0].withColumnRenamed("row_id", "_query").drop("label").withColumn("_reach", F.lit(0.3))
    monkeypatch.setattr(neighbours, "TOP_LEVELS", top)
    search = Search(build_tree(train.dropDuplicates(names), names, "fold", NODE), "label", "row_id", K, LEAF)
    home = search._home(asked)
    plan = home._jdf.queryExecution().optimizedPlan().toString()
    assert len(search.tree.levels) > 2 and ("Join" in plan) == (top < len(search.tree.levels))
    nodes = search.tree.points.groupBy("_path").agg(*[f(n) for n in names for f in (F.min, F.max)], F.min("fold"), F.max("fold")).collect()
    homes = {r["_query"]: r["_path"] for r in home.collect()}
    visits = {(r["_query"], r["_path"]) for r in search.visits(home).collect()}
    expected = set()
    for i, q in enumerate(queries):
        for path, *sides, least, most in nodes:
            gap = sum(max(sides[2 * c] - q[c], q[c] - sides[2 * c + 1], 0.0) ** 2 for c in range(3))
            if gap <= 0.3 and path != homes[i] and not least == most == fold[30 * i]:
                expected.add((i, path))
    assert len(homes) == 100 and set(homes.values()) <= {n[0] for n in nodes} and visits == expected


def test_sorted_folds(spark):
    """Each fold fills a stretch alone; nodes of one's own fold are not visited."""
    rng = np.random.default_rng(5)
    points = rng.uniform(size=(1200, 2))
    points[:, 0] = np.sort(points[:, 0])
    fold = np.arange(1200) // 240
    train, names = frame(spark, points, fold=fold)
    found = {r["row_id"]: r["prediction"] for r in nearest_votes(train, train, names, exclude="fold", tile_size=LEAF, node_size=NODE).collect()}
    assert [found[i] for i in range(1200)] == votes(points, points, np.arange(1200), lambda i: fold != fold[i])


def test_too_few_points_that_count(spark):
    points = np.arange(200.0)[:, None]
    fold = np.array([0] * 197 + [1] * 3)
    train, names = frame(spark, points, fold=fold)
    found = {r["row_id"]: r["prediction"] for r in nearest_votes(train, train, names, exclude="fold", tile_size=LEAF, node_size=NODE).collect()}
    assert [found[i] for i in range(200)] == votes(points, points, np.arange(200), lambda i: fold != fold[i])


@pytest.mark.parametrize("kind", ["plain", "one feature", "seven features", "heavy values", "few values"])
def test_leaves_and_candidates(kind):
    rng = np.random.default_rng(6)
    points = np.unique(cloud(kind, 3000, rng), axis=0)
    leaves = split_leaves(points, LEAF)
    assert sorted(np.concatenate(leaves).tolist()) == list(range(len(points))) and max(map(len, leaves)) <= LEAF
    queries = cloud("plain" if kind != "one feature" and kind != "seven features" else kind, 100, rng)
    _, compared = search_node(points, np.arange(len(points)), None, queries, None, None, K, LEAF)
    assert np.mean(compared) <= (0.7 if kind == "seven features" else 0.2) * len(points) + 4 * LEAF


def test_equal_points_end_in_one_leaf():
    assert [len(x) for x in split_leaves(np.ones((40, 2)), LEAF)] == [40]


def test_tables_with_a_row_per_query_are_not_broadcast(spark):
    rows = spark.range(3000).selectExpr("id AS row_id", "int(id % 3) AS label", "double(id % 50) AS x", "double(id % 61) AS y")
    plan = nearest_votes(rows, rows, ["x", "y"], node_size=NODE)._jdf.queryExecution().executedPlan().toString()
    joins = re.findall(r"BroadcastHashJoin \[(\w+)", plan)
    assert joins and set(joins) == {"_path"}
