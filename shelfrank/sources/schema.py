"""The product table."""

from __future__ import annotations

from pyspark.sql import types as T

# The category files of a catalogue.
CATEGORIES = ("accessories", "bags", "beauty", "house", "jewelry", "kids", "men", "shoes", "women")

PRODUCT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("current_price", T.DoubleType()),
        T.StructField("raw_price", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("discount", T.IntegerType()),
        T.StructField("likes_count", T.LongType()),
        T.StructField("is_new", T.BooleanType()),
        T.StructField("brand", T.StringType()),
    ]
)
