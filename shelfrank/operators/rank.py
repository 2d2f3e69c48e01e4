"""Top products and the ranking of categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.functions import round_half_even, weighted_sum
from shelfrank.operators.score import fit_extents, with_min_max
from shelfrank.session import write_table

TOP_PRODUCTS = 10

# Weights of the category score and decimals of its metrics.
CATEGORY_WEIGHTS = {"score_norm": 0.60, "likes_norm": 0.25, "count_norm": 0.15}
METRIC_DECIMALS = 3


def top_rows(df: DataFrame, score: str = "composite_score", k: int = TOP_PRODUCTS, position: str = "row_id") -> DataFrame:
    """The ``k`` rows of highest score; ties by earliest position, NULL scores last."""
    return df.orderBy(F.desc_nulls_last(score), position).limit(k)


def numbered(top: DataFrame, score: str = "composite_score", position: str = "row_id") -> DataFrame:
    """Number the few rows of a top list or ranking from 1 on."""
    order = Window.orderBy(F.desc_nulls_last(score), position)
    return top.withColumn("rank", F.row_number().over(order))


def group_metrics(df: DataFrame, key: str = "category") -> DataFrame:
    """Per group: mean, maximum and number of scores, mean likes, discount and price, rounded.

    Groups without a key are left out.  Partial aggregates make it safe for one
    group to hold most rows.
    """
    rounded = {
        "avg_composite_score": F.avg("composite_score"),
        "max_composite_score": F.max("composite_score"),
        "avg_likes": F.avg("likes_count"),
        "avg_discount": F.avg("discount"),
        "avg_price": F.avg("current_price"),
    }
    grouped = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[e.alias(n) for n, e in rounded.items()], F.count("composite_score").alias("product_count"))
    )
    return grouped.select(
        key,
        *[round_half_even(F.col(c), METRIC_DECIMALS).alias(c) for c in ("avg_composite_score", "max_composite_score")],
        "product_count",
        *[round_half_even(F.col(c), METRIC_DECIMALS).alias(c) for c in ("avg_likes", "avg_discount", "avg_price")],
    )


def with_group_norms(metrics: DataFrame) -> DataFrame:
    """Add the metrics scaled to [0, 1] over all groups."""
    names = {"avg_composite_score": "score_norm", "avg_likes": "likes_norm", "product_count": "count_norm"}
    return with_min_max(metrics, fit_extents(metrics, list(names)), names)


def group_ranking(df: DataFrame, key: str = "category") -> DataFrame:
    """Groups by final score, best first; equal scores in key order."""
    # One small row per group, written so that the products are aggregated only once.
    metrics = write_table(group_metrics(df, key), "group-metrics")
    scored = with_group_norms(metrics).withColumn("final_category_score", weighted_sum(CATEGORY_WEIGHTS))
    return scored.orderBy(F.desc_nulls_last("final_category_score"), key)


def best_group(ranking: DataFrame, key: str = "category") -> DataFrame:
    """The first row of a ranking."""
    return ranking.orderBy(F.desc_nulls_last("final_category_score"), key).limit(1)
