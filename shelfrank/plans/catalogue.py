"""The whole catalogue job: from product files to scores, rankings and scaled tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shelfrank.operators.clean import Fence, fence_report, fill_gaps, fit_fences, fit_fillings, removal_summary, within_fences
from shelfrank.operators.rank import TOP_PRODUCTS, best_group, group_ranking, top_rows
from shelfrank.operators.score import NEWNESS_SCORE, RANKING_SCORE, Scaler, ScoreSpec, fit_scaler, with_composite_score
from shelfrank.operators.select import analysis_columns, numeric_columns
from shelfrank.session import write_table
from shelfrank.sources import scan_present, with_row_id, write_csv


@dataclass(frozen=True)
class CatalogueSpec:
    """``strict`` refuses tables without all context columns; ``flag`` joins the numeric columns."""

    score: ScoreSpec
    strict: bool
    flag: str | None = None


RANKING = CatalogueSpec(RANKING_SCORE, strict=True)
NEWNESS = CatalogueSpec(NEWNESS_SCORE, strict=False, flag="is_new")


@dataclass(frozen=True)
class Catalogue:
    numeric: tuple[str, ...]
    filled: DataFrame
    fences: tuple[Fence, ...]
    scored: DataFrame
    scaler: Scaler
    normalised: DataFrame

    def outliers(self) -> DataFrame:
        return fence_report(self.filled, self.fences)

    def removed(self) -> DataFrame:
        return removal_summary(self.filled, self.fences)

    def top(self, k: int = TOP_PRODUCTS) -> DataFrame:
        return top_rows(self.scored, k=k)

    def ranking(self) -> DataFrame:
        return group_ranking(self.scored)

    def best_category(self) -> DataFrame:
        return best_group(self.ranking())


def load_catalogue(spark: SparkSession, paths: Sequence[str], schema: T.StructType, order: Sequence[str]) -> DataFrame:
    """Stack the category files that exist and number the rows in the given order."""
    return with_row_id(scan_present(spark, paths, schema), order)


def build_catalogue(products: DataFrame, spec: CatalogueSpec = RANKING) -> Catalogue:
    """Choose columns, fill gaps, remove outliers, score and scale.

    ``products`` is read several times and should be a written table.  The
    scored table is written too, since every report starts from it.
    """
    numeric = numeric_columns(products, flag=spec.flag)
    chosen = analysis_columns(products, numeric, strict=spec.strict)
    filled = fill_gaps(chosen, fit_fillings(chosen, numeric))
    fences = fit_fences(filled, numeric)
    scored = write_table(with_composite_score(within_fences(filled, fences), spec.score), "scored")
    scaler = fit_scaler(scored, numeric)
    return Catalogue(tuple(numeric), filled, tuple(fences), scored, scaler, scaler.transform(scored))


def save_catalogue(catalogue: Catalogue, folder: str) -> None:
    """Write the scored, scaled, top and ranking tables as CSV folders."""
    write_csv(catalogue.scored, f"{folder}/preprocessed_data")
    write_csv(catalogue.normalised, f"{folder}/normalized_data")
    write_csv(catalogue.top(), f"{folder}/top_10_products")
    write_csv(catalogue.ranking(), f"{folder}/category_ranking", leading=["category"])
