import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfrank.operators.split import fold_quotas, label_codes, split_quotas, with_fold, with_label_code, with_test_flag
from shelfrank.plans.study import split_base


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(3)
    # One class holds most rows.
    names = rng.choice(["pear", "fig", "apple"], size=1501, p=[0.7, 0.2, 0.1])
    df = spark.createDataFrame([(i, str(n)) for i, n in enumerate(names)], "row_id long, category string")
    return with_label_code(df).cache()


def test_codes_are_sorted(labelled):
    assert label_codes(labelled.select("category")).orderBy("label").collect() == [("apple", 0), ("fig", 1), ("pear", 2)]


def test_quotas():
    assert split_quotas({"a": 50, "b": 50}) == {"a": 10, "b": 10}
    assert split_quotas({"a": 3, "b": 3}) == {"a": 1, "b": 1}
    assert split_quotas({"a": 2, "b": 2, "c": 2}) == {"a": 1, "b": 1, "c": 0}
    with pytest.raises(ValueError):
        split_quotas({"a": 10, "b": 1})


def test_split_is_exact_and_does_not_depend_on_partitions(labelled):
    found = {}
    for parts, small in [(1, 1_000_000), (11, 1_000_000), (4, 20)]:
        flagged = with_test_flag(labelled.repartition(parts), small=small)
        found[parts, small] = {r["row_id"]: r["is_test"] for r in flagged.collect()}
    first, *others = found.values()
    assert all(o == first for o in others)
    assert len(first) == 1501 and sum(first.values()) == math.ceil(0.2 * 1501)
    labels = {r["row_id"]: r["label"] for r in labelled.collect()}
    sizes = Counter(str(v) for v in labels.values())
    assert Counter(str(labels[i]) for i, t in first.items() if t) == split_quotas(sizes)


def test_fold_quotas_equal_dealing_out():
    rng = np.random.default_rng(4)
    for _ in range(50):
        sizes = [int(n) for n in rng.integers(1, 30, size=rng.integers(1, 6))]
        dealt = [k for k, n in enumerate(sizes) for _ in range(n)]
        strided = [[dealt[i::5].count(k) for i in range(5)] for k in range(len(sizes))]
        assert fold_quotas(sizes) == strided


@pytest.mark.parametrize("small", [1_000_000, 30])
def test_folds(labelled, small):
    rows = with_fold(labelled.repartition(6), small=small).orderBy("row_id").collect()
    totals = Counter(r["fold"] for r in rows)
    assert len(rows) == 1501 and max(totals.values()) - min(totals.values()) <= 1
    for label in range(3):
        folds = [r["fold"] for r in rows if r["label"] == label]
        assert folds == sorted(folds)


def test_a_class_smaller_than_the_folds(spark):
    df = spark.createDataFrame([(i, 0 if i < 12 else 1) for i in range(14)], "row_id long, label int")
    rows = with_fold(df).collect()
    assert Counter(r["fold"] for r in rows) == {0: 3, 1: 3, 2: 3, 3: 3, 4: 2}


def test_missing_labels_are_refused(spark):
    df = spark.createDataFrame([(0, 1), (1, 1), (2, None)], "row_id long, label int")
    for add in (with_test_flag, with_fold):
        with pytest.raises(ValueError, match="missing"):
            add(df)


def test_the_draws_of_a_split_are_made_once_for_all_narrowing_steps(spark):
    rows = spark.range(4000, numPartitions=4).selectExpr("id AS row_id", "int(id % 2) AS label")
    seen = spark.sparkContext.accumulator(0)

    def count(part):
        seen.add(1)
        return part

    with_test_flag(spark.createDataFrame(rows.rdd.mapPartitions(count), rows.schema), small=2)
    assert seen.value == 2 * 4  # counted by class, then drawn


def test_a_split_draws_each_row_once(spark):
    """The rows are written with their draws: neither the result nor the folds work them out again."""
    base = spark.range(3000).selectExpr("id AS row_id", "concat('c', id % 3) AS category", "double(id) AS x")
    plan = split_base(base)._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan and "_draw" in plan
