import numpy as np
import pytest

from shelfrank.operators import order_stats
from shelfrank.operators.order_stats import order_statistics, quantiles

VALUES = {
    "spread": lambda rng: rng.normal(size=3000),
    "a third equal": lambda rng: np.where(rng.random(3000) < 0.34, 7.0, rng.normal(size=3000)),
    "huge outlier": lambda rng: np.append(rng.random(2999), 1e200),
    "few values": lambda rng: rng.integers(0, 4, 3000).astype(float),
    "constant": lambda rng: np.full(3000, 2.5),
}


@pytest.mark.parametrize("kind", VALUES)
def test_quantiles_match_numpy_whether_narrowed_or_not(spark, kind):
    values = VALUES[kind](np.random.default_rng(1))
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").repartition(5)
    probabilities = [0.0, 0.25, 0.5, 0.75, 1.0]
    expected = np.quantile(values, probabilities)
    for small in (1_000_000, 40, 2):
        found = quantiles(df, ["x"], probabilities, small=small)["x"]
        assert found == pytest.approx(expected, rel=1e-12), small


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, 1)], "x double, y int")
    assert quantiles(df, ["x", "y"], [0.5]) == {"x": [None], "y": [1.0]}


def test_ranks_within_groups_with_ties(spark):
    rng = np.random.default_rng(2)
    rows = [("a" if i % 3 else "b", int(rng.integers(0, 5)), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, v long, id long").repartition(7)
    ordered = {g: sorted((v, i) for k, v, i in rows if k == g) for g in "ab"}
    wanted = [("a", 1), ("a", 600), ("a", len(ordered["a"])), ("b", 17), ("b", 18)]
    expected = {(g, r): ordered[g][r - 1] for g, r in wanted}
    for small in (1_000_000, 50):
        found = order_statistics(df, "v", wanted, group="g", tie="id", small=small, bins=16)
        assert found == expected


def test_rank_out_of_range(spark):
    with pytest.raises(ValueError):
        order_statistics(spark.range(3), "id", [("", 4)])


def test_a_sketch_that_misses_is_drawn_anew(spark, monkeypatch):
    monkeypatch.setattr(order_stats, "SKETCH_ACCURACY", 3)
    monkeypatch.setattr(order_stats, "MARGIN", 1e-9)
    values = np.random.default_rng(4).permutation(20_000).astype(float)
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(6)
    assert quantiles(df, ["x"], [0.25, 0.5, 0.75], small=100)["x"] == pytest.approx(np.quantile(values, [0.25, 0.5, 0.75]))


def test_a_bracket_holds_few_distinct_values(spark):
    """Narrowed, not gathered: a third equal, the rest spread over 60,000 rows."""
    rng = np.random.default_rng(5)
    values = np.where(rng.random(60_000) < 0.34, 0.5, rng.random(60_000))
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(6)
    n = len(values)
    wide = [order_stats.Bracket("x", p, n, 0.0, 1.0, n) for p in (0.1, 0.9)]
    for bracket in order_stats._narrowed(df, wide, 100):
        inside = values[(values >= bracket.low) & (values <= bracket.high)]
        assert len(np.unique(inside)) <= 100
        assert bracket.low <= np.quantile(values, bracket.probability) <= bracket.high
