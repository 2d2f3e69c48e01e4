"""H: feature-set variants."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from registry.core import Tables, query
from registry.sql import with_tables
from shelfrank.operators.variants import (
    LABEL_COLUMNS,
    LabelError,
    attach_equal,
    attach_left,
    comparison_variants,
    extended_variants,
)
from shelfrank.session import scratch_path
from shelfrank.sources import scan_in_order, write_csv

_BASE = "row_id, current_price, discount, likes_count, category"


@query(
    "h1_attach_equal",
    with_tables(f"SELECT {_BASE}, kmeans_cluster FROM normalised JOIN labels_kmeans USING (row_id)"),
)
def attach(t):
    base = t.normalised.select("row_id", "current_price", "discount", "likes_count", "category")
    return attach_equal(base, t.labels["kmeans"], "kmeans_cluster")


@query(
    "h1_by_position",
    with_tables(f"SELECT {_BASE}, kmeans_cluster FROM normalised JOIN labels_kmeans USING (row_id)"),
)
def attach_by_position(t):
    """Base and labels go to files without a common key and meet by their position in them."""
    folder = scratch_path(t.spark, "by-position")
    base = t.normalised.select(F.col("row_id").alias("product"), "current_price", "discount", "likes_count", "category")
    write_csv(base.orderBy("product"), f"{folder}/base")
    write_csv(t.labels["kmeans"].orderBy("row_id").select("kmeans_cluster"), f"{folder}/labels")
    read = scan_in_order(t.spark, f"{folder}/base", name="position")
    labels = scan_in_order(t.spark, f"{folder}/labels", name="position")
    labels = labels.withColumn("kmeans_cluster", F.col("kmeans_cluster").cast("int"))
    joined = attach_equal(read, labels, "kmeans_cluster", key="position")
    return joined.withColumnRenamed("product", "row_id").drop("position")


def _early(t: Tables):
    """Labels for the first nine tenths of the positions only."""
    last = t.products.agg(F.max("row_id")).first()[0]
    return t.labels["dbscan"].where(F.col("row_id") <= 0.9 * last)


_EARLY = "labels_early AS (SELECT * FROM labels_dbscan WHERE row_id <= 0.9::DOUBLE * (SELECT max(row_id) FROM products))"


@query(
    "h2_attach_left",
    with_tables(f"SELECT {_BASE}, cluster FROM normalised LEFT JOIN labels_early USING (row_id)", _EARLY),
)
def attach_some(t):
    base = t.normalised.select("row_id", "current_price", "discount", "likes_count", "category")
    return attach_left(base, _early(t), "cluster")


def _tagged(variants):
    """All variants in one table, each row tagged by its variant; absent labels are NULL."""
    frames = [
        v.df.select(
            F.lit(v.name).alias("variant"), "*", F.lit(len(v.features)).alias("n_features")
        )
        for v in variants
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _variant_sql(prefix: str, extra: str, n: int, tables: dict[str, str], left: bool = False) -> str:
    columns = ", ".join(LABEL_COLUMNS[m] for m in tables)
    blank = ", ".join(f"NULL::INTEGER AS {LABEL_COLUMNS[m]}" for m in tables)
    parts = [f"SELECT 'original' AS variant, {_BASE}{extra}, {n} AS n_features, {blank} FROM normalised"]
    for m, table in tables.items():
        shown = ", ".join(f"{'' if o == m else 'NULL::INTEGER AS '}{LABEL_COLUMNS[o]}" for o in tables)
        join = "LEFT JOIN" if left else "JOIN"
        parts.append(
            f"SELECT '{prefix}{m}' AS variant, {_BASE}{extra}, {n + 1} AS n_features, {shown} FROM normalised {join} {table} USING (row_id)"
        )
    return f"SELECT variant, {_BASE}{', is_new_numeric' if extra else ''}, n_features, {columns} FROM (" + " UNION ALL ".join(parts) + ")"


@query(
    "h3_comparison_variants",
    with_tables(_variant_sql("", "", 3, {m: f"labels_{m}" for m in LABEL_COLUMNS})),
)
def comparison(t):
    return _tagged(comparison_variants(t.normalised.drop("is_new"), t.labels))


@query(
    "h3_extended_variants",
    with_tables(
        _variant_sql(
            "with_",
            ", CASE WHEN is_new THEN 1 ELSE 0 END AS is_new_numeric",
            4,
            {"kmeans": "labels_kmeans", "hierarchical": "labels_hierarchical", "dbscan": "labels_early"},
            left=True,
        ),
        _EARLY,
    ),
)
def extended(t):
    return _tagged(extended_variants(t.normalised, {**t.labels, "dbscan": _early(t)}))


@query(
    "h4_fault_isolation",
    with_tables(
        """SELECT 'original' AS variant, 3 AS n_features, count(*) AS row_count FROM normalised
        UNION ALL SELECT 'hierarchical', 4, count(*) FROM normalised JOIN labels_hierarchical USING (row_id)"""
    ),
)
def isolated(t):
    # Two label tables do not fit: one is short, one has no label column.  Alone they are refused.
    short = {"dbscan": _early(t), "kmeans": t.labels["kmeans"].select("row_id")}
    try:
        comparison_variants(t.normalised, short)
        raise AssertionError("misfits accepted")
    except LabelError:
        pass
    variants = comparison_variants(t.normalised, {**short, "hierarchical": t.labels["hierarchical"]})
    frames = [
        v.df.agg(F.count("*").alias("row_count")).select(
            F.lit(v.name).alias("variant"), F.lit(len(v.features)).alias("n_features"), "row_count"
        )
        for v in variants
    ]
    return reduce(lambda a, b: a.unionByName(b), frames)
