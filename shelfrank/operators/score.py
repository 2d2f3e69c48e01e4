"""Scaling and scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.functions import min_max, weighted_sum, z_score
from shelfrank.operators.select import with_flag_number


@dataclass(frozen=True)
class Extent:
    low: float | None
    high: float | None


def fit_extents(df: DataFrame, columns: Sequence[str]) -> dict[str, Extent]:
    """Smallest and largest value per column, all in one pass."""
    row = df.agg(
        *[f(F.col(c).cast("double")).alias(f"{c}|{n}") for c in columns for n, f in [("low", F.min), ("high", F.max)]]
    ).first()
    return {c: Extent(row[f"{c}|low"], row[f"{c}|high"]) for c in columns}


def with_min_max(df: DataFrame, extents: Mapping[str, Extent], names: Mapping[str, str], inverse: Sequence[str] = ()) -> DataFrame:
    """Add ``names[column]``: the column scaled to [0, 1], or 1 minus that if inverse."""
    added = {}
    for column, name in names.items():
        e = extents[column]
        scaled = min_max(F.col(column), F.lit(e.low).cast("double"), F.lit(e.high).cast("double"))
        added[name] = 1 - scaled if column in inverse else scaled
    return df.withColumns(added)


@dataclass(frozen=True)
class Scaler:
    """Means and population deviations of the fitted columns."""

    means: Mapping[str, float | None]
    deviations: Mapping[str, float | None]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                c: z_score(F.col(c), F.lit(self.means[c]).cast("double"), F.lit(self.deviations[c]).cast("double"))
                for c in self.means
            }
        )


def fit_scaler(df: DataFrame, columns: Sequence[str], skip: Sequence[str] = ("is_new",)) -> Scaler:
    chosen = [c for c in columns if c not in skip]
    row = df.agg(
        *[f(c).alias(f"{c}|{n}") for c in chosen for n, f in [("mean", F.avg), ("deviation", F.stddev_pop)]]
    ).first()
    return Scaler({c: row[f"{c}|mean"] for c in chosen}, {c: row[f"{c}|deviation"] for c in chosen})


@dataclass(frozen=True)
class ScoreSpec:
    """Weights of the component scores, and whether a newness score is among them."""

    weights: Mapping[str, float]
    uses_flag: bool = False
    sources: Mapping[str, str] = field(
        default_factory=lambda: {
            "current_price": "price_score",
            "discount": "discount_score",
            "likes_count": "likes_score",
        }
    )
    inverse: Sequence[str] = ("current_price",)


# The two published weightings.
RANKING_SCORE = ScoreSpec({"likes_score": 0.50, "discount_score": 0.30, "price_score": 0.20})
NEWNESS_SCORE = ScoreSpec(
    {"likes_score": 0.40, "discount_score": 0.30, "price_score": 0.20, "new_score": 0.10}, uses_flag=True
)


def with_composite_score(df: DataFrame, spec: ScoreSpec = RANKING_SCORE) -> DataFrame:
    """Add the component scores and their weighted sum ``composite_score``."""
    if spec.uses_flag:
        df = with_flag_number(df)
    extents = fit_extents(df, list(spec.sources))
    scored = with_min_max(df, extents, spec.sources, spec.inverse)
    return scored.withColumn("composite_score", weighted_sum(spec.weights))
