"""Registration, and the tables the queries share."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.operators.clean import fence_report, fill_gaps, fit_fences, fit_fillings, within_fences
from shelfrank.operators.order_stats import quantiles
from shelfrank.operators.score import fit_scaler, with_composite_score
from shelfrank.operators.models import comparison_models, extended_models, naive_bayes, nearest_neighbours
from shelfrank.operators.select import analysis_columns, feature_columns
from shelfrank.operators.variants import BASE_FEATURES, CARRIED, DISPLAY_NAMES, LABEL_COLUMNS, Variant, attach_labels
from shelfrank.plans.products import NUMERIC, products
from shelfrank.plans.study import StudyResults, run_study, split_base, stored, study_importances, train_rows
from shelfrank.session import write_table

#: A limit so small that order statistics take the way of a very large table.
NARROW = 500

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Callable[["Tables"], DataFrame]], Callable]:
    """Register a function of the shared tables under ``name``."""

    def register(function):
        QUERIES[name] = lambda spark, folder: function(tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Round computed doubles: the engines add them up in different orders."""
    return df.withColumns({c: F.round(c, places) for c in columns})


class Tables:
    """Tables derived from one data folder, each built once per session; files of a folder must not change meanwhile."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def products(self) -> DataFrame:
        made = products(self.spark, self.folder)
        # Not written, as the row_id says it and numbers out of order do not pack.
        stored = write_table(made.drop("id"), "products", tight=True).withColumn("id", F.col("row_id") + 1)
        return stored.select(*made.columns)

    @cached_property
    def filled(self) -> DataFrame:
        return fill_gaps(self.products, fit_fillings(self.products, NUMERIC))

    @cached_property
    def fences(self):
        return fit_fences(self.filled, NUMERIC)

    @cached_property
    def fence_report(self) -> DataFrame:
        return fence_report(self.filled, self.fences)

    @cached_property
    def cleaned(self) -> DataFrame:
        return within_fences(self.filled, self.fences)

    @cached_property
    def scored(self) -> DataFrame:
        return with_composite_score(self.cleaned)

    @cached_property
    def normalised(self) -> DataFrame:
        """Scored products with z-scored numbers, rounded so that both engines see the same values."""
        scaled = fit_scaler(self.cleaned, NUMERIC).transform(self.scored)
        return write_table(rounded(analysis_columns(scaled, [*NUMERIC, "is_new"]), *NUMERIC), "normalised")

    @cached_property
    def price_quartiles(self) -> list[float]:
        return quantiles(self.cleaned, ["current_price"], [0.25, 0.5, 0.75])["current_price"]

    @cached_property
    def labels(self) -> dict[str, DataFrame]:
        """Stand-ins for the three cluster tables that SQL can express too."""
        price = F.col("current_price")
        above = sum((F.when(price > q, 1).otherwise(0) for q in self.price_quartiles), F.lit(0))
        keyed = self.cleaned.select("row_id", "current_price", "discount", "likes_count")
        noise = F.when(F.col("likes_count") > 4000, -1).otherwise(F.col("discount") % 3)
        return {
            "kmeans": keyed.select("row_id", (F.col("row_id") % 4).cast("int").alias("kmeans_cluster")),
            "hierarchical": keyed.select("row_id", above.cast("int").alias("hierarchical_cluster")),
            "dbscan": keyed.select("row_id", noise.cast("int").alias("cluster")),
        }

    @cached_property
    def split(self) -> DataFrame:
        return write_table(split_base(self.normalised.select("row_id", *BASE_FEATURES, "category")), "split-base")

    @cached_property
    def study(self) -> DataFrame:
        """Features, cluster labels, label code, test flag and training folds, keyed by row_id."""
        wide, _ = attach_labels(self.split, self.labels, require_equal=False)
        return stored(wide)

    @cached_property
    def variants(self) -> list[Variant]:
        return _variants(self.study, BASE_FEATURES)

    @property
    def train(self) -> DataFrame:
        return self.study.where("NOT is_test")

    @property
    def test(self) -> DataFrame:
        return self.study.where("is_test")


    @cached_property
    def comparison(self) -> StudyResults:
        """The three-model comparison on all variants."""
        return run_study(self.variants, comparison_models())

    @cached_property
    def extended(self) -> StudyResults:
        """The cross-validated five-model comparison on all variants."""
        return run_study(self.variants, extended_models(), cross_validate=True, parallel=8)

    @cached_property
    def train_importances(self) -> DataFrame:
        return study_importances(self.variants, trees=50, rows=train_rows)

    @cached_property
    def overall_importances(self) -> DataFrame:
        return study_importances(self.variants, trees=100)

    @cached_property
    def vector_study(self) -> DataFrame:
        """A second, smaller subject: three figures of each embedding, its label as the category."""
        vectors = self.read("embeddings")
        v = F.col("embedding").cast("array<double>")
        total = F.aggregate(v, F.lit(0.0), lambda a, x: a + x)
        base = vectors.select(
            F.col("vec_id").alias("row_id"),
            F.round(total, 6).alias("vec_sum"),
            F.round(F.array_max(v), 6).alias("vec_max"),
            F.round(F.array_min(v), 6).alias("vec_min"),
            F.concat(F.lit("class "), F.col("label").cast("string")).alias("category"),
        )
        base = write_table(base, "vectors")
        q = quantiles(base, ["vec_max"], [0.25, 0.5, 0.75])["vec_max"]
        quarter = sum((F.when(F.col("vec_max") > x, 1).otherwise(0) for x in q), F.lit(0))
        noise = F.when(F.col("vec_min") < -0.35, -1).otherwise(F.col("row_id") % 3)
        wide = split_base(base).withColumns(
            {
                "kmeans_cluster": (F.col("row_id") % 4).cast("int"),
                "hierarchical_cluster": quarter.cast("int"),
                "cluster": noise.cast("int"),
            }
        )
        return stored(wide)

    @cached_property
    def vector_variants(self) -> list[Variant]:
        return _variants(self.vector_study, VECTOR_FEATURES)

    @cached_property
    def vector_results(self) -> StudyResults:
        """The cross-validated study of the two models SQL can express too, on four variants."""
        return run_study(self.vector_variants, [nearest_neighbours(), naive_bayes()], cross_validate=True)


VECTOR_FEATURES = ("vec_sum", "vec_max", "vec_min")


def _variants(wide: DataFrame, features) -> list[Variant]:
    """The original features and one variant per cluster label of a wide table."""
    sets = {"original": tuple(features), **{m: (*features, c) for m, c in LABEL_COLUMNS.items()}}
    return [
        Variant(name, DISPLAY_NAMES[name], chosen, feature_columns(wide, chosen, keys=CARRIED))
        for name, chosen in sets.items()
    ]


_TABLES: dict[tuple[str, str], Tables] = {}


def tables(spark: SparkSession, folder: str) -> Tables:
    key = (spark.sparkContext.applicationId, str(folder).rstrip("/"))
    if key not in _TABLES:
        _TABLES[key] = Tables(spark, key[1])
    return _TABLES[key]
