"""A: scans, stacking, row numbers, CSV in and out."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.core import Tables, query, rounded
from registry.sql import with_tables
from shelfrank.operators.rank import group_ranking
from shelfrank.operators.split import label_codes
from shelfrank.plans.products import LINE_ORDER
from shelfrank.session import scratch_path
from shelfrank.sources import (
    PRODUCT_SCHEMA,
    infer_types,
    parse_columns,
    read_tables,
    scan_csv,
    scan_present,
    union_all_by_name,
    with_row_id,
    write_csv,
)

FIELDS = [f.name for f in PRODUCT_SCHEMA]


#: The category whose file is missing, or whose table comes twice.
ODD_ONE = "PROMO"


def _category_files(t: Tables, leave_out: str | None = None) -> list[str]:
    """Write the products as one CSV folder per category, in one pass, and name the folders.

    Folders are numbered by the categories found, NULL among them.
    """
    folder = scratch_path(t.spark, "categories")
    names = label_codes(t.products, "category").withColumnRenamed("label", "file")
    rows = t.products.join(F.broadcast(names), "category", "left")  # label_codes checks the number of categories
    rows = rows.withColumn("file", F.coalesce("file", F.lit(-1)))
    numbers = [r["file"] for r in rows.select("file").distinct().orderBy("file").collect()]
    if leave_out is not None:
        rows = rows.where(~F.col("category").eqNullSafe(leave_out))
    (
        rows.select(*FIELDS, "file")
        .write.partitionBy("file")
        .option("header", True)
        .option("escape", '"')
        .csv(folder)
    )
    return [f"{folder}/file={n}" for n in numbers]


@query("a1_scan_category_csv", with_tables(f"SELECT {', '.join(FIELDS)} FROM products"))
def scan_category_csv(t):
    return scan_csv(t.spark, _category_files(t), PRODUCT_SCHEMA)


@query("a2_missing_file", with_tables(f"SELECT {', '.join(FIELDS)} FROM products WHERE category IS DISTINCT FROM 'PROMO'"))
def missing_file(t):
    return scan_present(t.spark, _category_files(t, leave_out=ODD_ONE), PRODUCT_SCHEMA)


@query(
    "a3_union_all_by_name",
    with_tables(
        """SELECT id, category, current_price, brand FROM products WHERE category IS DISTINCT FROM 'PROMO'
        UNION ALL BY NAME SELECT id, category, current_price FROM products WHERE category = 'PROMO'
        UNION ALL BY NAME SELECT id, category, current_price FROM products WHERE category = 'PROMO'"""
    ),
)
def union_by_name(t):
    chosen = t.products.select("current_price", "brand", "category", "id")
    odd = F.col("category").eqNullSafe(ODD_ONE)
    # The table without brands comes twice: copies are kept.
    without_brand = chosen.where(odd).drop("brand")
    return union_all_by_name([without_brand, chosen.where(~odd), without_brand])


@query(
    "a4_row_id",
    f"SELECT row_number() OVER (ORDER BY {', '.join(LINE_ORDER)}) - 1 AS row_id, {', '.join(LINE_ORDER[:-1])} FROM lineitem",
)
def row_id(t):
    return with_row_id(t.read("lineitem"), LINE_ORDER).select("row_id", *LINE_ORDER[:-1])


_TEXTS = """
texts AS (
  SELECT row_id,
         CASE WHEN brand IS NULL THEN 'N/A' WHEN likes_count IS NULL THEN 'None' ELSE brand END AS brand_text,
         CASE WHEN discount IS NULL THEN 'NaN' WHEN is_new THEN ' ' || discount ELSE discount || '.0' END AS discount_text,
         CASE WHEN likes_count IS NULL THEN '' ELSE CAST(likes_count AS VARCHAR) END AS likes_text,
         CASE WHEN likes_count IS NULL THEN '#N/A' ELSE likes_count || '.5' END AS score_text,
         CASE WHEN is_new THEN 'True' ELSE 'False' END AS flag_text,
         CASE WHEN is_new THEN 'y' ELSE 'n' END AS letter_text,
         discount || 'D' AS size_text,
         CASE WHEN row_id % 2 = 0 THEN 'Infinity' ELSE likes_count || 'e0' END AS wide_text
  FROM products
)"""


def _texts(t):
    likes, discount = F.col("likes_count"), F.col("discount")
    new = F.col("is_new")
    return t.products.select(
        "row_id",
        F.when(F.col("brand").isNull(), "N/A").when(likes.isNull(), "None").otherwise(F.col("brand")).alias("brand_text"),
        F.when(discount.isNull(), "NaN")
        .when(new, F.concat(F.lit(" "), discount))
        .otherwise(F.concat(discount, F.lit(".0")))
        .alias("discount_text"),
        F.coalesce(likes.cast("string"), F.lit("")).alias("likes_text"),
        F.coalesce(F.concat(likes, F.lit(".5")), F.lit("#N/A")).alias("score_text"),
        F.when(new, "True").otherwise("False").alias("flag_text"),
        F.when(new, "y").otherwise("n").alias("letter_text"),
        F.concat(discount, F.lit("D")).alias("size_text"),
        F.when(F.col("row_id") % 2 == 0, "Infinity").otherwise(F.concat(likes, F.lit("e0"))).alias("wide_text"),
    )


@query(
    "a5_na_tokens",
    with_tables(
        """SELECT row_id, CASE WHEN brand_text NOT IN ('N/A', 'None') THEN brand_text END AS brand_text,
        CAST(try_cast(CASE WHEN discount_text <> 'NaN' THEN trim(discount_text) END AS DOUBLE) AS INTEGER) AS discount_text,
        try_cast(nullif(likes_text, '') AS BIGINT) AS likes_text,
        try_cast(nullif(score_text, '#N/A') AS DOUBLE) AS score_text,
        try_cast(flag_text AS BOOLEAN) AS flag_text FROM texts""",
        _TEXTS,
    ),
)
def na_tokens(t):
    texts = _texts(t).withColumn("row_id", F.col("row_id").cast("string"))
    kinds = "row_id long, brand_text string, discount_text int, likes_text long, score_text double, flag_text boolean"
    schema = t.spark.createDataFrame([], kinds).schema
    return parse_columns(texts, schema)


@query(
    "a5_type_inference",
    with_tables(
        """SELECT name AS column_name,
        CASE WHEN count(try_cast(cell AS BIGINT)) = count(cell) AND NOT bool_or(contains(cell, '.')) THEN 'bigint'
             WHEN count(try_cast(cell AS DOUBLE)) = count(cell) THEN 'double'
             WHEN bool_and(lower(cell) IN ('true', 'false')) THEN 'boolean' ELSE 'string' END AS data_type,
        count(cell) AS present
        FROM (SELECT name, CASE WHEN cell NOT IN ('', 'N/A', 'None', 'NaN', '#N/A') THEN trim(cell) END AS cell
              FROM (SELECT * EXCLUDE row_id FROM texts) UNPIVOT INCLUDE NULLS (cell FOR name IN (*))) GROUP BY name""",
        _TEXTS,
    ),
)
def type_inference(t):
    typed = infer_types(_texts(t).drop("row_id"))
    counts = typed.agg(*[F.count(c).alias(c) for c in typed.columns])
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("data_type"), F.col(c).alias("present")) for c, k in typed.dtypes]
    return counts.select(F.inline(F.array(*rows)))


@query(
    "a6_base_and_labels",
    with_tables(
        """SELECT n.row_id, n.category, n.current_price, n.discount, n.likes_count, k.kmeans_cluster, h.hierarchical_cluster
        FROM normalised n JOIN labels_kmeans k ON n.row_id = k.row_id JOIN labels_hierarchical h ON n.row_id = h.row_id"""
    ),
)
def base_and_labels(t):
    folder = scratch_path(t.spark, "study-inputs")
    base = t.normalised.select("row_id", "category", "current_price", "discount", "likes_count")
    write_csv(base, f"{folder}/base")
    for method in ("kmeans", "hierarchical"):
        write_csv(t.labels[method], f"{folder}/{method}")
    # The third label table does not exist and is skipped.
    opened = read_tables(
        {name: (lambda path=f"{folder}/{name}": scan_csv(t.spark, path)) for name in ("base", *t.labels)}
    )
    joined = opened.pop("base")
    for table in opened.values():
        joined = joined.join(table, "row_id")
    clusters = [c for c in joined.columns if c.endswith("_cluster")]
    return joined.withColumns({c: F.col(c).cast("int") for c in clusters})


@query(
    "a7_write_csv",
    with_tables(
        """SELECT row_id, name, category, brand, is_new, likes_count, round(current_price, 6) AS current_price,
        round(composite_score, 6) AS composite_score FROM scored"""
    ),
)
def write_and_read(t):
    path = scratch_path(t.spark, "scored-csv")
    columns = ["row_id", "name", "category", "brand", "is_new", "likes_count", "current_price", "composite_score"]
    write_csv(rounded(t.scored.select(*columns), "current_price", "composite_score"), path)
    return scan_csv(t.spark, path)


@query(
    "a8_write_grouped_csv",
    with_tables(
        """SELECT category, count(*) AS product_count, round_even(avg(composite_score), 3) AS avg_composite_score
        FROM scored GROUP BY category"""
    ),
)
def write_grouped(t):
    path = scratch_path(t.spark, "ranking-csv")
    metrics = group_ranking(t.scored).select("product_count", "avg_composite_score", "category")
    write_csv(metrics, path, leading=["category"])
    return scan_csv(t.spark, path)
