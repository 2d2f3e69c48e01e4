"""C: columns and rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.core import query
from registry.sql import with_tables
from shelfrank.operators.select import (
    CONTEXT_COLUMNS,
    analysis_columns,
    feature_columns,
    numeric_columns,
    rows_equal,
    with_flag_number,
)
from shelfrank.operators.variants import BASE_FEATURES


@query("c1_numeric_columns", with_tables("SELECT row_id, id, current_price, raw_price, discount, likes_count FROM products"))
def numbers(t):
    return t.products.select(*numeric_columns(t.products, exclude=()))


@query("c2_exclude_id", with_tables("SELECT current_price, raw_price, discount, likes_count FROM products"))
def without_id(t):
    return t.products.select(*numeric_columns(t.products))


@query("c3_promote_flag", with_tables("SELECT current_price, raw_price, discount, likes_count, is_new FROM products"))
def with_flag(t):
    return t.products.select(*numeric_columns(t.products, flag="is_new"))


@query(
    "c4_analysis_columns",
    with_tables(
        "SELECT row_id, current_price, raw_price, discount, likes_count, category, subcategory, name, brand, currency FROM products"
    ),
)
def strict_columns(t):
    return analysis_columns(t.products, numeric_columns(t.products), CONTEXT_COLUMNS, strict=True)


@query(
    "c4_lenient_columns",
    with_tables("SELECT row_id, current_price, raw_price, discount, likes_count, category, subcategory, name, currency FROM products"),
)
def lenient_columns(t):
    return analysis_columns(t.products.drop("brand"), numeric_columns(t.products))


@query(
    "c5_flag_number",
    with_tables(
        """SELECT row_id, CASE WHEN likes_count IS NULL THEN 0 WHEN is_new THEN 1 ELSE 0 END AS new_score,
        0 AS missing_score FROM products"""
    ),
)
def flag_number(t):
    # The flag is made unknown where the likes are.
    flagged = t.products.withColumn("is_new", F.when(F.col("likes_count").isNotNull(), F.col("is_new")))
    scored = with_flag_number(with_flag_number(flagged), flag="no_such_flag", name="missing_score")
    return scored.select("row_id", "new_score", "missing_score")


@query("c6_rows_equal", with_tables("SELECT row_id, category, name FROM products WHERE category = 'PROMO'"))
def equal_rows(t):
    return rows_equal(t.products, "category", "PROMO").select("row_id", "category", "name")


@query("c7_feature_columns", with_tables("SELECT row_id, current_price, discount, likes_count, category FROM normalised"))
def features(t):
    return feature_columns(t.normalised, BASE_FEATURES)
