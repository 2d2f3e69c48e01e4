"""B: profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.core import query, rounded
from registry.sql import NUMERIC, with_tables
from shelfrank.operators import profile
from shelfrank.operators.clean import removal_summary
from shelfrank.operators.score import fit_scaler

COLUMNS = (
    "row_id", "id", "category", "subcategory", "name", "current_price", "raw_price", "currency", "discount",
    "likes_count", "is_new", "brand",
)
def _per_column(columns, expression: str, table: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, {expression.format(c=c)} FROM {table}" for c in columns)


@query("b1_shape", with_tables("SELECT count(*) AS row_count, 12::BIGINT AS column_count FROM products"))
def shape(t):
    return profile.shape(t.products)


def _types_of(row: str) -> str:
    """The types of a row's columns, under Spark's names where they differ."""
    return " UNION ALL ".join(
        f"SELECT {i}::INT AS position, '{c}' AS column_name, CASE typeof({c}) WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'"
        f" ELSE lower(typeof({c})) END AS data_type FROM {row}"
        for i, c in enumerate(COLUMNS)
    )


@query("b2_column_types", with_tables(_types_of("(SELECT * FROM products LIMIT 1)")))
def column_types(t):
    return profile.column_types(t.products)


@query(
    "b3_null_counts",
    with_tables(
        f"SELECT * FROM ({_per_column(COLUMNS, 'count(*) FILTER (WHERE {c} IS NULL) AS null_count', 'products')}) WHERE null_count > 0"
    ),
)
def null_counts(t):
    return profile.null_counts(t.products)


@query(
    "b4_distinct_counts",
    with_tables(_per_column(COLUMNS, "count(DISTINCT {c}) AS distinct_count", "products")),
)
def distinct_counts(t):
    return profile.distinct_counts(t.products)


@query(
    "b5_ranges",
    with_tables(
        _per_column(
            ("row_id", "id", "current_price", "raw_price", "discount", "likes_count", "is_new"),
            "round(min({c}::DOUBLE), 6) AS min_value, round(max({c}::DOUBLE), 6) AS max_value",
            "products",
        )
    ),
)
def ranges(t):
    return rounded(profile.ranges(t.products), "min_value", "max_value")


@query(
    "b5_ranges_orders",
    _per_column(("o_orderkey", "o_custkey", "o_totalprice"), "min({c})::DOUBLE AS min_value, max({c})::DOUBLE AS max_value", "orders")
    + " UNION ALL SELECT 'o_orderdate', epoch(min(o_orderdate))::DOUBLE, epoch(max(o_orderdate))::DOUBLE FROM orders",
)
def ranges_orders(t):
    return profile.ranges(t.read("orders"))


_NULL_CELLS = " + ".join(f"count(*) - count({c})" for c in COLUMNS)


@query(
    "b6_total_nulls",
    with_tables(
        f"SELECT 'before' AS stage, CAST({_NULL_CELLS} AS BIGINT) AS null_cells FROM products "
        f"UNION ALL SELECT 'after', CAST({_NULL_CELLS} AS BIGINT) FROM filled"
    ),
)
def total_nulls(t):
    stages = {"before": t.products, "after": t.filled}
    before, after = [profile.total_nulls(df).withColumn("stage", F.lit(s)) for s, df in stages.items()]
    return before.unionByName(after)


@query("b7_category_counts", with_tables("SELECT category, count(*) AS row_count FROM cleaned GROUP BY category"))
def category_counts(t):
    return profile.value_counts(t.cleaned, "category")


@query(
    "b7_brand_counts",
    with_tables("SELECT brand, count(*) AS row_count FROM products WHERE brand IS NOT NULL GROUP BY brand"),
)
def brand_counts(t):
    return profile.value_counts(t.products, "brand")


@query("b8_flag_counts", with_tables("SELECT is_new, count(*) AS row_count FROM cleaned GROUP BY is_new"))
def flag_counts(t):
    return profile.value_counts(t.cleaned, "is_new")


def _histogram_sql(table: str, columns) -> str:
    parts = [
        f"""SELECT '{c}' AS column_name, CAST(b AS INTEGER) AS bin, round(low + b * (high - low) / 30, 6) AS bin_low,
        round(low + (b + 1) * (high - low) / 30, 6) AS bin_high,
        (SELECT count(*) FROM {table} WHERE least(floor(({c}::DOUBLE - low) * 30 / (high - low)), 29) = b) AS row_count
        FROM range(30) r(b), (SELECT CASE WHEN min({c}) = max({c}) THEN min({c}) - 0.5 ELSE min({c}) END::DOUBLE AS low,
          CASE WHEN min({c}) = max({c}) THEN max({c}) + 0.5 ELSE max({c}) END::DOUBLE AS high FROM {table}) e"""
        for c in columns
    ]
    return " UNION ALL ".join(parts)


@query("b9_histogram", with_tables(_histogram_sql("cleaned", NUMERIC)))
def histogram(t):
    return rounded(profile.histogram(t.cleaned, NUMERIC), "bin_low", "bin_high")


@query("b9_histogram_events", _histogram_sql("events", ["value"]))
def histogram_events(t):
    return rounded(profile.histogram(t.read("events"), ["value"]), "bin_low", "bin_high")


@query(
    "b10_scaled_check",
    with_tables(
        _per_column(
            NUMERIC, "abs(round(avg({c}), 6)) AS mean, round(stddev_samp({c}), 6) AS std_sample", "zscored"
        )
    ),
)
def scaled_check(t):
    checked = profile.mean_and_deviation(fit_scaler(t.cleaned, NUMERIC).transform(t.cleaned), NUMERIC)
    # A mean of about 0 may carry either sign.
    return rounded(checked, "mean", "std_sample").withColumn("mean", F.abs("mean"))


@query(
    "b11_outlier_report",
    with_tables(
        " UNION ALL ".join(
            f"SELECT {i}::INTEGER AS position, '{c}' AS column_name, round(lower_bound, 6) AS lower_bound, "
            f"round(upper_bound, 6) AS upper_bound, outliers FROM fence{i}"
            for i, c in enumerate(NUMERIC)
        )
    ),
)
def outlier_report(t):
    return rounded(t.fence_report, "lower_bound", "upper_bound")


@query(
    "b11_removal_summary",
    with_tables(
        """SELECT b AS initial_rows, a AS final_rows, b - a AS removed_rows, round((b - a) * 100.0::DOUBLE / b, 6) AS removed_percent
        FROM (SELECT count(*) AS b FROM filled), (SELECT count(*) AS a FROM cleaned)"""
    ),
)
def removed(t):
    return rounded(removal_summary(t.filled, t.fences), "removed_percent")
