"""The product table as a view of the order lines and parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.sources import with_row_id

LINE_ORDER = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)

# What a product is made of; the other columns only order the lines.
LINE_KEPT = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate",
)

NUMERIC = ("current_price", "raw_price", "discount", "likes_count")


def numbered_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with ``row_id``, joined to their part."""
    lines = with_row_id(spark.read.parquet(f"{folder}/lineitem.parquet"), LINE_ORDER, keep=LINE_KEPT)
    parts = spark.read.parquet(f"{folder}/part.parquet").select("p_partkey", "p_type", "p_brand", "p_name")
    # Parts grow with the data: no broadcast hint, Spark compares sizes itself.
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))


def products(spark: SparkSession, folder: str) -> DataFrame:
    """One product per order line, with missing values and outliers planted."""
    line, flag = F.col("l_linenumber"), F.col("l_returnflag")
    factor = F.when(F.col("l_orderkey") % 40 == 0, 8).otherwise(1)
    list_price = F.col("l_extendedprice") * factor
    fourth_power = F.expr("bigint(l_quantity) * bigint(l_quantity) * bigint(l_quantity) * bigint(l_quantity) div 1000")
    percent = F.round(F.col("l_discount") * 100).cast("int")
    is_recent = F.col("l_shipdate").cast("timestamp_ntz") >= F.expr("timestamp_ntz'2000-01-01 00:00:00'")
    return numbered_lines(spark, folder).select(
        "row_id",
        (F.col("row_id") + 1).alias("id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.col("p_name").alias("name"),
        F.when(~((line == 7) & (flag == "R")), list_price * (1 - F.col("l_discount"))).alias("current_price"),
        F.when(~((line == 6) & (flag == "A")), list_price).alias("raw_price"),
        F.lit("USD").alias("currency"),
        F.when(~((line == 5) & (flag == "N")), F.when(F.col("l_orderkey") % 60 == 0, 40).otherwise(percent)).alias(
            "discount"
        ),
        F.when(~((line == 4) & (flag == "R")), fourth_power).alias("likes_count"),
        is_recent.alias("is_new"),
        F.when(F.col("p_partkey") % 10 != 0, F.col("p_brand")).alias("brand"),
    )
