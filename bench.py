"""Time the headline queries: one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores.  The
shared product table is built first and timed as a query of its own; every
other query is the median of three warm runs.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from registry import QUERIES
from registry.core import Tables, tables
from shelfrank.operators.clean import fit_fences, fit_fillings
from shelfrank.plans.catalogue import build_catalogue
from shelfrank.plans.products import NUMERIC
from shelfrank.session import local_session

RUNS = 3
HEADLINE = (
    "a4_row_id",
    "b3_null_counts",
    "b4_distinct_counts",
    "b9_histogram",
    "b11_outlier_report",
    "d1_median_fill",
    "e2_iqr_filter",
    "f3_z_score",
    "f5_ranking_score",
    "g1_top_products",
    "g8_category_ranking",
    "h3_comparison_variants",
    "i2_stratified_split",
    "i6_naive_bayes",
    "i10_cross_validation",
)
ONCE = ("i5_nearest_neighbours",)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def catalogue_job(spark, folder) -> None:
    """From the raw tables to the top products and the category ranking, nothing prepared."""
    t = Tables(spark, folder)
    catalogue = build_catalogue(t.products)
    consume(catalogue.top())
    consume(catalogue.ranking())


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    seconds = {}
    # Warms the session up as well.
    catalogue_job(spark, folder)
    seconds["catalogue_from_raw"] = timed(lambda: catalogue_job(spark, folder))
    t = tables(spark, folder)
    seconds["products_table"] = timed(lambda: t.products)
    # The queries below reuse these fitted numbers, so the fits are timed apart.
    seconds["fillings_fit"] = statistics.median(timed(lambda: fit_fillings(t.products, NUMERIC)) for _ in range(RUNS))
    seconds["fences_fit"] = statistics.median(timed(lambda: fit_fences(t.filled, NUMERIC)) for _ in range(RUNS))
    seconds["study_table"] = timed(lambda: t.study)
    for name in HEADLINE:
        times = [timed(lambda name=name: consume(QUERIES[name](spark, folder))) for _ in range(RUNS + 1)][1:]
        seconds[name] = statistics.median(times)
    for name in ONCE:
        seconds[name] = timed(lambda name=name: consume(QUERIES[name](spark, folder)))
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in seconds.items()},
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "driver_memory": spark.conf.get("spark.driver.memory"),
            }
        )
    )


if __name__ == "__main__":
    main()
