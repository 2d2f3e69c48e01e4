"""Trees against plain Python: thresholds, splits, and that nothing depends on how rows lie."""

import numpy as np
import pytest

from shelfrank.operators.trees import _places, fit_trees, grow_tree, split_points


def test_thresholds_stand_nearest_to_equal_shares_of_all_rows(spark):
    rng = np.random.default_rng(3)
    few, many = rng.integers(-3, 4, 3000).astype(float), rng.normal(size=3000).round(2)
    heavy = np.where(rng.random(3000) < 0.6, 0.5, rng.random(3000))
    rows = spark.createDataFrame([tuple(map(float, r)) for r in zip(few, many, heavy)], "a double, b double, c double").repartition(7)

    def expected(values, bins):
        values, counts = np.unique(values, return_counts=True)
        if len(values) <= bins:
            return (values[1:] + values[:-1]) / 2
        stride, cuts = counts.sum() / bins, []
        target, upto = stride, np.cumsum(counts)
        for i in range(1, len(values)):
            if abs(upto[i - 1] - target) < abs(upto[i] - target):
                cuts.append((values[i - 1] + values[i]) / 2)
                target += stride
        return np.array(cuts)

    for bins in (256, 16):
        for found, values in zip(split_points(rows, ["a", "b", "c"], bins), (few, many, heavy)):
            assert found.tolist() == expected(values, bins).tolist()
    assert _places(300, 256, []) == []


def _brute(bins, labels, depth, asked):
    """One tree on single rows, split by split."""
    counts = np.bincount(labels, minlength=3)

    def gini(c):
        impurity = 1.0
        for share in c / c.sum():
            impurity -= share * share
        return impurity

    best = (0.0, None, None)
    for f in range(len(bins)):
        for cut in np.unique(bins[f])[:-1]:
            left = bins[f] <= cut
            a, b = np.bincount(labels[left], minlength=3), np.bincount(labels[~left], minlength=3)
            gain = gini(counts) - left.mean() * gini(a) - (~left).mean() * gini(b)
            if gain > best[0]:
                best = (gain, f, cut)
    if depth == 0 or best[1] is None:
        return np.full(asked.shape[1], counts.argmax())
    left, low = bins[best[1]] <= best[2], asked[best[1]] <= best[2]
    found = np.empty(asked.shape[1], int)
    found[low] = _brute(bins[:, left], labels[left], depth - 1, asked[:, low])
    found[~low] = _brute(bins[:, ~left], labels[~left], depth - 1, asked[:, ~low])
    return found


@pytest.mark.parametrize("depth", [0, 1, 3, 30])
def test_a_tree_equals_one_grown_split_by_split(depth):
    rng = np.random.default_rng(depth)
    bins, labels = rng.integers(0, 9, (3, 400)).astype(np.uint8), rng.integers(0, 3, 400)
    asked = rng.integers(0, 9, (3, 200)).astype(np.uint8)
    cells, place = np.unique(bins, axis=1, return_inverse=True)
    weights = np.zeros((3, cells.shape[1]), np.int64)
    np.add.at(weights, (labels, place.ravel()), 1)
    votes = np.zeros((200, 3), np.int64)
    grow_tree(cells, weights, asked, votes, depth, 3, np.random.default_rng(0))
    assert votes.argmax(axis=1).tolist() == _brute(bins, labels, depth, asked).tolist()


def test_trees_do_not_depend_on_how_rows_lie_and_refuse_gaps(spark):
    rng = np.random.default_rng(4)
    made = [(i, *map(float, rng.normal(size=2).round(1)), int(rng.integers(0, 3))) for i in range(900)]
    rows = spark.createDataFrame(made, "row_id long, x double, y double, label int")

    def predicted(table):
        model = fit_trees(table, ["x", "y"], trees=7, subset=1, bootstrap=True, asked=table)
        found = model.transform(table)
        assert found.columns == ["row_id", "x", "y", "label", "prediction"]
        return sorted(found.collect()), model.importances().tolist()

    assert predicted(rows.repartition(5)) == predicted(rows.orderBy("y").coalesce(1))
    with pytest.raises(ValueError):
        fit_trees(rows.selectExpr("label", "if(row_id = 5, null, x) AS x"), ["x"])
    with pytest.raises(ValueError):
        fit_trees(rows.where("row_id < 0"), ["x"])
