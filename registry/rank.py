"""G: top products and the ranking of categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry.core import Tables, query, rounded
from registry.sql import with_tables
from shelfrank.functions import round_half_even
from shelfrank.operators.rank import best_group, group_metrics, group_ranking, numbered, top_rows, with_group_norms

_PRODUCT = """id, category, name, brand, round(current_price, 6) AS current_price, discount, likes_count,
        round(price_score, 6) AS price_score, round(discount_score, 6) AS discount_score,
        round(likes_score, 6) AS likes_score, round(composite_score, 6) AS composite_score"""


def top_products(t: Tables) -> DataFrame:
    scores = ("price_score", "discount_score", "likes_score", "composite_score")
    top = top_rows(t.scored).select(
        "id", "category", "name", "brand", "current_price", "discount", "likes_count", *scores
    )
    return rounded(top, "current_price", *scores)


query(
    "g1_top_products",
    with_tables(f"SELECT {_PRODUCT} FROM scored ORDER BY scored.composite_score DESC NULLS LAST, row_id LIMIT 10"),
)(top_products)


@query(
    "g2_rank_number",
    with_tables(
        """SELECT id, name, CAST(row_number() OVER (ORDER BY composite_score DESC NULLS LAST, row_id) AS INTEGER) AS rank
        FROM scored QUALIFY rank <= 10"""
    ),
)
def rank_number(t):
    return numbered(top_rows(t.scored)).select("id", "name", "rank")


_METRICS = """
metrics AS MATERIALIZED (
  SELECT {key}, round_even(avg(composite_score), 3) AS avg_composite_score,
         round_even(max(composite_score), 3) AS max_composite_score, count(composite_score) AS product_count,
         round_even(avg(likes_count), 3) AS avg_likes, round_even(avg(discount), 3) AS avg_discount,
         round_even(avg(current_price), 3) AS avg_price
  FROM scored WHERE {key} IS NOT NULL GROUP BY {key}
)"""
_NORMS = """
norms AS MATERIALIZED (
  SELECT *, (avg_composite_score - min(avg_composite_score) OVER ())
              / nullif(max(avg_composite_score) OVER () - min(avg_composite_score) OVER (), 0) AS score_norm,
         (avg_likes - min(avg_likes) OVER ()) / nullif(max(avg_likes) OVER () - min(avg_likes) OVER (), 0) AS likes_norm,
         (product_count - min(product_count) OVER ())::DOUBLE
              / nullif(max(product_count) OVER () - min(product_count) OVER (), 0) AS count_norm
  FROM metrics
)"""
_RANKING = """
ranking AS MATERIALIZED (
  SELECT *, 0.60::DOUBLE * score_norm + 0.25::DOUBLE * likes_norm + 0.15::DOUBLE * count_norm AS final_category_score FROM norms
)"""
_BY_CATEGORY = (_METRICS.format(key="category"), _NORMS, _RANKING)
_ALL = """category, avg_composite_score, max_composite_score, product_count, avg_likes, avg_discount, avg_price,
       round(score_norm, 6) AS score_norm, round(likes_norm, 6) AS likes_norm, round(count_norm, 6) AS count_norm,
       round(final_category_score, 6) AS final_category_score"""
_COMPUTED = ("score_norm", "likes_norm", "count_norm", "final_category_score")


@query(
    "g3_category_metrics",
    with_tables("SELECT category, avg_composite_score, max_composite_score, product_count, avg_likes FROM metrics", *_BY_CATEGORY),
)
def category_metrics(t):
    return group_metrics(t.scored).select(
        "category", "avg_composite_score", "max_composite_score", "product_count", "avg_likes"
    )


@query(
    "g3_brand_metrics",
    with_tables("SELECT subcategory, avg_composite_score, product_count, avg_price FROM metrics", _METRICS.format(key="subcategory")),
)
def subcategory_metrics(t):
    return group_metrics(t.scored, "subcategory").select("subcategory", "avg_composite_score", "product_count", "avg_price")


@query("g4_half_even_rounding", with_tables("SELECT row_id, round_even(current_price / 8 * 1000, 0) / 1000 AS price FROM cleaned"))
def half_even(t):
    return t.cleaned.select("row_id", round_half_even(F.col("current_price") / 8, 3).alias("price"))


@query("g5_named_metrics", with_tables("SELECT * FROM metrics", *_BY_CATEGORY))
def named_metrics(t):
    return group_metrics(t.scored)


@query(
    "g6_group_norms",
    with_tables(
        "SELECT category, round(score_norm, 6) AS score_norm, round(likes_norm, 6) AS likes_norm, round(count_norm, 6) AS count_norm FROM norms",
        *_BY_CATEGORY,
    ),
)
def group_norms(t):
    norms = ("score_norm", "likes_norm", "count_norm")
    return rounded(with_group_norms(group_metrics(t.scored)).select("category", *norms), *norms)


@query(
    "g7_category_score",
    with_tables("SELECT category, round(final_category_score, 6) AS final_category_score FROM ranking", *_BY_CATEGORY),
)
def category_score(t):
    return rounded(group_ranking(t.scored).select("category", "final_category_score"), "final_category_score")


def category_ranking(t: Tables) -> DataFrame:
    return rounded(group_ranking(t.scored), *_COMPUTED)


query(
    "g8_category_ranking",
    with_tables(f"SELECT {_ALL} FROM ranking ORDER BY final_category_score DESC NULLS LAST, category", *_BY_CATEGORY),
)(category_ranking)


@query(
    "g9_best_category",
    with_tables(f"SELECT {_ALL} FROM ranking ORDER BY ranking.final_category_score DESC NULLS LAST, category LIMIT 1", *_BY_CATEGORY),
)
def best_category(t):
    return rounded(best_group(group_ranking(t.scored)), *_COMPUTED)
