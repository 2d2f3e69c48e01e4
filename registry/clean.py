"""D and E: gaps, quantiles, outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.core import NARROW, ORACLES, query, rounded
from registry.sql import NUMERIC, with_tables
from shelfrank.operators.clean import fill_gaps, fit_fences, fit_fillings, within_fences
from shelfrank.operators.order_stats import quantiles
from shelfrank.operators.profile import quartile_summary
from shelfrank.session import small_table


@query(
    "d1_median_fill",
    with_tables("SELECT row_id, round(current_price, 6) AS current_price, round(raw_price, 6) AS raw_price FROM filled"),
)
def median_fill(t):
    prices = ["current_price", "raw_price"]
    return rounded(fill_gaps(t.products.select("row_id", *prices), fit_fillings(t.products, prices)), *prices)


@query("d2_zero_fill", with_tables("SELECT row_id, discount, likes_count FROM filled"))
def zero_fill(t):
    counts = ["discount", "likes_count"]
    return fill_gaps(t.products.select("row_id", *counts), fit_fillings(t.products, counts))


_GAPPED = """
gapped AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
         CASE WHEN o_orderpriority <> '2-HIGH' THEN o_custkey END AS o_custkey FROM orders
)"""


@query(
    "d3_mean_fill",
    with_tables(
        """SELECT o_orderkey, round(coalesce(o_totalprice, (SELECT avg(o_totalprice) FROM gapped)), 6) AS o_totalprice,
        round(coalesce(o_custkey::DOUBLE, (SELECT avg(o_custkey) FROM gapped)), 6) AS o_custkey FROM gapped""",
        _GAPPED,
    ),
)
def mean_fill(t):
    gapped = t.read("orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("o_totalprice"),
        F.when(F.col("o_orderpriority") != "2-HIGH", F.col("o_custkey")).alias("o_custkey"),
    )
    columns = ["o_totalprice", "o_custkey"]
    return rounded(fill_gaps(gapped, fit_fillings(gapped, columns)), *columns)


@query("d4_unknown_fill", with_tables("SELECT row_id, category, name, brand FROM filled"))
def unknown_fill(t):
    return fill_gaps(t.products.select("row_id", "category", "name", "brand"), {})


@query(
    "e1_quartiles",
    with_tables(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, round(quantile_cont({c}, 0.25), 6)::DOUBLE AS q1, "
            f"round(quantile_cont({c}, 0.75), 6)::DOUBLE AS q3 FROM products"
            for c in NUMERIC
        )
    ),
)
def quartiles(t):
    return rounded(quartile_summary(t.products, NUMERIC), "q1", "q3")


# The same by brackets narrowed to very few rows, as on a very large table.
@query("e1_quartiles_narrowed", ORACLES["e1_quartiles"])
def quartiles_narrowed(t):
    found = quantiles(t.products, NUMERIC, [0.25, 0.75], small=NARROW)
    return rounded(small_table(t.spark, [(c, *q) for c, q in found.items()], "column_name string, q1 double, q3 double"), "q1", "q3")


@query(
    "e2_iqr_filter",
    with_tables(
        "SELECT row_id, category, round(current_price, 6) AS current_price, round(raw_price, 6) AS raw_price, discount, likes_count FROM cleaned"
    ),
)
def iqr_filter(t):
    return rounded(t.cleaned.select("row_id", "category", *NUMERIC), "current_price", "raw_price")


@query("e2_iqr_filter_narrowed", ORACLES["e2_iqr_filter"])
def iqr_filter_narrowed(t):
    kept = within_fences(t.filled, fit_fences(t.filled, NUMERIC, small=NARROW))
    return rounded(kept.select("row_id", "category", *NUMERIC), "current_price", "raw_price")
