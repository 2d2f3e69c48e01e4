from shelfrank.operators import profile


def test_nulls_distincts_and_ranges(spark):
    df = spark.createDataFrame([(1, "a", True), (None, "a", False), (3, None, True)], "n int, s string, b boolean")
    assert profile.shape(df).collect() == [(3, 3)]
    assert dict(profile.null_counts(df).collect()) == {"n": 1, "s": 1}
    assert profile.total_nulls(df).first()[0] == 2
    assert dict(profile.distinct_counts(df).collect()) == {"n": 2, "s": 1, "b": 2}
    assert dict(profile.distinct_counts(df, approximate=True).collect()) == {"n": 2, "s": 1, "b": 2}
    assert {r[0]: r[1:] for r in profile.ranges(df).collect()} == {"n": (1.0, 3.0), "b": (0.0, 1.0)}


def test_distinct_counts_copy_no_rows_and_read_a_column_each(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 7 AS k", "cast(id % 3 AS string) AS s").write.parquet(str(tmp_path / "t"))
    counts = profile.distinct_counts(spark.read.parquet(str(tmp_path / "t")))
    assert dict(counts.collect()) == {"id": 100, "k": 7, "s": 3}
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    for schema in ("ReadSchema: struct<id:bigint>", "ReadSchema: struct<k:bigint>", "ReadSchema: struct<s:string>"):
        assert schema in plan


def test_value_counts_drop_null_and_break_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("c",)], "k string")
    assert profile.value_counts(df, "k").collect() == [("c", 2), ("a", 1), ("b", 1)]


def test_histogram_keeps_empty_bins_and_closes_the_last(spark):
    df = spark.createDataFrame([(0.0, 5), (1.0, 5), (30.0, 5), (None, None)], "x double, c int")
    rows = profile.histogram(df, ["x", "c"]).collect()
    x = {r["bin"]: r["row_count"] for r in rows if r["column_name"] == "x"}
    assert len(x) == 30 and x[0] == 1 and x[1] == 1 and x[29] == 1 and sum(x.values()) == 3
    c = [r for r in rows if r["column_name"] == "c"]
    assert min(r["bin_low"] for r in c) == 4.5 and sum(r["row_count"] for r in c) == 3


def test_empty_table(spark):
    df = spark.createDataFrame([], "x double, s string")
    assert profile.shape(df).collect() == [(0, 2)]
    assert profile.total_nulls(df).first()[0] == 0
    assert profile.null_counts(df).count() == 0
    assert profile.histogram(df, ["x"]).count() == 0
    assert profile.ranges(df).collect() == [("x", None, None)]


def test_times_do_not_depend_on_the_time_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'1970-01-02 00:00:01.5' AS at")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert profile.ranges(df).collect() == [("at", 86401.5, 86401.5)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
