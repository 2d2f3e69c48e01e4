import os
import re

import pytest
from pyspark.sql import functions as F

from shelfrank.operators.variants import attach_equal
from shelfrank.sources import (
    NA_TOKENS,
    PRODUCT_SCHEMA,
    infer_types,
    parse_columns,
    read_tables,
    scan_csv,
    scan_in_order,
    scan_present,
    union_all_by_name,
    with_row_id,
    write_csv,
)


def _file(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_quotes_line_breaks_and_column_order(spark, tmp_path):
    one = _file(tmp_path, "one.csv", 'name,price\n"d\'été ""fin""",1.5\n"two\nlines",\n')
    two = _file(tmp_path, "two.csv", "price,name,brand\n3,plain,NA\n")
    schema = spark.createDataFrame([], "name string, price double, brand string").schema
    rows = scan_csv(spark, [one, two], schema).orderBy("name").collect()
    assert [tuple(r) for r in rows] == [
        ('d\'été "fin"', 1.5, None),
        ("plain", 3.0, None),
        ("two\nlines", None, None),
    ]


def test_missing_files(spark, tmp_path):
    here = _file(tmp_path, "here.csv", "a\n1\n")
    gone = os.path.join(tmp_path, "gone.csv")
    assert scan_present(spark, [gone, here]).collect() == [(1,)]
    with pytest.raises(FileNotFoundError):
        scan_present(spark, [gone])
    opened = read_tables({"here": lambda: scan_csv(spark, here), "gone": lambda: scan_csv(spark, gone)})
    assert list(opened) == ["here"]


def test_na_tokens_and_casts(spark):
    text = spark.createDataFrame([(t, t) for t in (*NA_TOKENS, " 4 ", "4.0", "4.5", "x")], "n string, s string")
    schema = spark.createDataFrame([], "n int, s string, absent double").schema
    rows = parse_columns(text, schema).collect()
    assert [r.n for r in rows][-4:] == [4, 4, None, None]
    assert all(r.n is None and r.s is None for r in rows[: len(NA_TOKENS)])
    assert all(r.absent is None for r in rows)


def test_inferred_types(spark):
    text = spark.createDataFrame(
        [("1", "1", "True", "a", ""), ("NA", "2.5", "false", "1", "NaN")], "i string, d string, b string, s string, e string"
    )
    assert infer_types(text).dtypes == [
        ("i", "bigint"),
        ("d", "double"),
        ("b", "boolean"),
        ("s", "string"),
        ("e", "double"),
    ]


def test_union_keeps_copies_and_fills(spark):
    a, b = spark.createDataFrame([(1, "x")], "k int, v string"), spark.createDataFrame([(2,)], "k int")
    assert sorted(union_all_by_name([a, b, b]).collect()) == [(1, "x"), (2, None), (2, None)]
    with pytest.raises(ValueError):
        union_all_by_name([])


@pytest.mark.parametrize("parts", [1, 9])
def test_row_id_is_dense_and_ordered(spark, parts):
    # A third of the rows share the leading key.
    rows = [(0 if i % 3 == 0 else i, i) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(parts)
    numbered = with_row_id(df, ["k", "v"]).orderBy("row_id").collect()
    assert [r.row_id for r in numbered] == list(range(500))
    assert [(r.k, r.v) for r in numbered] == sorted(rows)


def test_row_id_of_empty_table(spark):
    assert with_row_id(spark.createDataFrame([], "k long"), ["k"]).collect() == []


def test_written_csv_reads_back(spark, tmp_path):
    rows = [("b", 'q"uote', 0.1), ("a", "two\nlines", None)]
    df = spark.createDataFrame(rows, "k string, t string, x double")
    path = str(tmp_path / "out")
    write_csv(df, path, leading=["x"])
    back = scan_csv(spark, path)
    assert back.columns == ["x", "k", "t"]
    assert sorted(back.select("k", "t", "x").collect()) == sorted(rows)


def test_positions_over_paths_files_and_blocks(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    # Part numbers of six digits sort after those of five; a file without rows takes no position.
    for part, rows in ((99999, range(0, 700)), (100000, range(700, 1500)), (100001, ()), (100002, range(1500, 1501))):
        _file(folder, f"part-{part}-x.csv", "v,row\n" + "".join(f"{i},r{i % 7}\n" for i in rows))
    last = _file(tmp_path, "a.csv", "row,v,extra\n" + "".join(f"s,{i},NA\n" for i in range(1501, 1600)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        found = scan_in_order(spark, [str(folder), last])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert found.columns == ["v", "row", "extra", "row_id"]
    rows = found.orderBy("row_id").collect()
    assert [(r.row_id, r.v) for r in rows] == [(i, i) for i in range(1600)]
    assert all(r.extra is None for r in rows)


def test_positions_with_line_breaks_empty_files_and_clashes(spark, tmp_path):
    broken = _file(tmp_path, "b.csv", 'v\n"one\nline"\ntwo\n')
    assert [tuple(r) for r in scan_in_order(spark, broken).orderBy("row_id").collect()] == [("one\nline", 0), ("two", 1)]
    assert scan_in_order(spark, _file(tmp_path, "e.csv", "v\n")).collect() == []
    with pytest.raises(ValueError):
        scan_in_order(spark, _file(tmp_path, "c.csv", "v,row_id\n1,2\n"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_that_meet_by_position_are_never_broadcast(spark, tmp_path):
    write_csv(spark.range(20_000).selectExpr("id % 7 AS category"), str(tmp_path / "base"))
    write_csv(spark.range(20_000).selectExpr("id % 4 AS cluster"), str(tmp_path / "labels"))
    base, labels = (scan_in_order(spark, str(tmp_path / name)) for name in ("base", "labels"))
    # The rows are the left side of the join with their blocks; their files hold a few bytes a row.
    assert "BuildLeft" not in _plan(labels.select("row_id"))
    assert "BroadcastHashJoin [row_id" not in _plan(attach_equal(base, labels, "cluster"))


def test_parsing_is_short_enough_to_be_compiled(spark, tmp_path, capsys):
    """The JVM interprets methods of over 8,000 bytes for good."""
    text = spark.range(3).select(*[F.col("id").cast("string").alias(f.name) for f in PRODUCT_SCHEMA])
    write_csv(text, f"{tmp_path}/wide")
    parse_columns(spark.read.option("header", True).csv(f"{tmp_path}/wide"), PRODUCT_SCHEMA).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_infinite_cells(spark):
    cells = ["inf", "-inf", "+Inf", "Infinity", "-infinity", "1e3", "1d"]
    typed = parse_columns(spark.createDataFrame([(c,) for c in cells], "x string"), spark.createDataFrame([], "x double").schema)
    endless = float("inf")
    assert [r.x for r in typed.collect()] == [endless, -endless, endless, endless, -endless, 1000.0, None]


def test_row_ids_write_only_what_is_kept(spark):
    rows = spark.createDataFrame([(i % 7, i * 31 % 50, f"n{i}") for i in range(50)], "a int, b int, c string")
    kept = with_row_id(rows, ["a", "b"], keep=["b", "c"])
    assert kept.columns == ["b", "c", "row_id"]
    assert {tuple(r) for r in kept.collect()} == {(r.b, r.c, r.row_id) for r in with_row_id(rows, ["a", "b"]).collect()}
    assert all("part-" not in f or ".zstd." in f for f in kept.inputFiles())
