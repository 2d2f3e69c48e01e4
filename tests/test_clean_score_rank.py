import math

import pytest
from pyspark.sql import functions as F

from shelfrank.functions import nan_to_null, round_half_even
from shelfrank.operators.clean import fence_report, fill_gaps, fit_fences, fit_fillings, removal_summary, within_fences
from shelfrank.operators.rank import group_metrics, numbered, top_rows
from shelfrank.operators.score import fit_extents, fit_scaler, with_composite_score, with_min_max
from shelfrank.operators.select import analysis_columns, numeric_columns, with_flag_number


def test_fillings(spark):
    rows = [(1.0, None, 5, "a"), (None, 3, None, None), (4.0, 1, 2, "b")]
    df = spark.createDataFrame(rows, "current_price double, discount int, weight int, brand string")
    found = fit_fillings(df, ["current_price", "discount", "weight"])
    assert found == {"current_price": 2.5, "discount": 0, "weight": 3.5}
    filled = fill_gaps(df, found)
    assert filled.dtypes == [("current_price", "double"), ("discount", "int"), ("weight", "double"), ("brand", "string")]
    assert sorted(filled.collect()) == [(1.0, 0, 5.0, "a"), (2.5, 3, 3.5, "Unknown"), (4.0, 1, 2.0, "b")]


def test_all_null_column_stays(spark):
    df = spark.createDataFrame([(None,), (None,)], "current_price double")
    assert fit_fillings(df, ["current_price"]) == {}
    fences = fit_fences(df, ["current_price"])
    assert within_fences(df, fences).count() == 2


def test_a_column_without_outliers_keeps_its_nulls(spark):
    calm = spark.createDataFrame([(float(i),) for i in range(8)] + [(None,)], "x double")
    assert within_fences(calm, fit_fences(calm, ["x"])).count() == 9
    wild = calm.union(spark.createDataFrame([(1e6,)], "x double"))
    fences = fit_fences(wild, ["x"])
    assert within_fences(wild, fences).count() == 8
    assert fence_report(wild, fences).first()["outliers"] == 1
    assert removal_summary(wild, fences).first() == (10, 8, 2, 20.0)


def test_fences_are_fitted_one_after_the_other(spark):
    # The row outlying in x distorts y's quartiles only if it is still there.
    rows = [(float(i % 5), float(i % 7)) for i in range(60)] + [(500.0, 60.0)] * 9 + [(1.0, 14.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    fences = fit_fences(df, ["x", "y"])
    kept = within_fences(df, fences)
    report = {r["column_name"]: r for r in fence_report(df, fences).collect()}
    assert report["x"]["outliers"] == 9
    for f in fences:
        assert kept.where(~F.col(f.column).between(f.lower, f.upper)).count() == 0
    removed = df.count() - kept.count()
    assert removed == sum(r["outliers"] for r in report.values())


def test_min_max_and_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0), (None, 2.0)], "x double, c double")
    scaled = with_min_max(df, fit_extents(df, ["x", "c"]), {"x": "xs", "c": "cs"}, inverse=["x"])
    assert scaled.select("xs", "cs").collect() == [(1.0, None), (0.0, None), (None, None)]


def test_z_scores(spark):
    df = spark.createDataFrame([(float(i), 7.0) for i in range(10)], "x double, c double")
    row = fit_scaler(df, ["x", "c"]).transform(df).agg(F.avg("x"), F.stddev_pop("x"), F.max(F.abs("c"))).first()
    assert row[0] == pytest.approx(0, abs=1e-12) and row[1] == pytest.approx(1) and row[2] == 0


def test_ties_nan_and_nulls_in_the_top_list(spark):
    rows = [(3, 0.5), (1, 0.5), (2, 0.9), (4, None), (5, math.nan)]
    df = spark.createDataFrame(rows, "row_id long, composite_score double")
    df = df.withColumn("composite_score", nan_to_null(F.col("composite_score")))
    top = numbered(top_rows(df, k=4)).collect()
    assert [(r["row_id"], r["rank"]) for r in top] == [(2, 1), (1, 2), (3, 3), (4, 4)]


def test_groups_without_a_key_are_left_out(spark):
    columns = "category string, composite_score double, likes_count long, discount int, current_price double"
    rows = [("a", 0.5, 1, 1, 1.0), ("a", None, 3, 2, 2.0), (None, 0.9, 9, 9, 9.0)]
    found = group_metrics(spark.createDataFrame(rows, columns)).collect()
    assert [tuple(r) for r in found] == [("a", 0.5, 0.5, 1, 2.0, 1.5, 1.5)]


def test_half_even_rounding(spark):
    values = [0.0005, 0.0015, 1.0005, 76.3285, 2.5]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    import numpy as np

    assert [r[0] for r in df.select(round_half_even(F.col("x"), 3)).collect()] == list(np.round(values, 3))


def test_column_choice(spark):
    df = spark.createDataFrame([(1, 2.0, True, "s")], "id long, price double, is_new boolean, category string")
    assert numeric_columns(df) == ["price"]
    assert numeric_columns(df, flag="is_new") == ["price", "is_new"]
    assert analysis_columns(df, ["price"]).columns == ["price", "category"]
    with pytest.raises(KeyError):
        analysis_columns(df, ["price"], strict=True)
    assert with_flag_number(df).first()["new_score"] == 1
    assert with_flag_number(df.drop("is_new")).first()["new_score"] == 0


def test_composite_score_of_constant_column_is_unknown(spark):
    df = spark.createDataFrame([(1.0, 5, 1), (2.0, 5, 2)], "current_price double, discount int, likes_count long")
    assert [r["composite_score"] for r in with_composite_score(df).collect()] == [None, None]
