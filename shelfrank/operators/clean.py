"""Filling gaps and removing outliers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.operators.order_stats import SMALL, quantiles, spread

# Which columns get which filling.
MEDIAN_FILLED = ("current_price", "raw_price")
ZERO_FILLED = ("discount", "likes_count")
TEXT_FILLING = "Unknown"


def fit_fillings(
    df: DataFrame,
    numeric: Sequence[str],
    median: Sequence[str] = MEDIAN_FILLED,
    zero: Sequence[str] = ZERO_FILLED,
    small: int = SMALL,
) -> dict[str, float | int]:
    """A filling per numeric column: exact median, zero, or the mean for the others."""
    numbers = [c for c in numeric if isinstance(df.schema[c].dataType, T.NumericType)]
    by_median = [c for c in numbers if c in median]
    by_mean = [c for c in numbers if c not in median and c not in zero]
    fillings: dict[str, float | int] = {c: 0 for c in numbers if c in zero}
    if by_median:
        found = quantiles(df, by_median, [0.5], small)
        fillings |= {c: v[0] for c, v in found.items() if v[0] is not None}
    if by_mean:
        means = df.agg(*[F.avg(c).alias(c) for c in by_mean]).first()
        fillings |= {c: means[c] for c in by_mean if means[c] is not None}
    return fillings


def fill_gaps(df: DataFrame, fillings: Mapping[str, float | int], text: str | None = TEXT_FILLING) -> DataFrame:
    """Fill numeric columns by ``fillings`` and text columns by ``text``.

    An integer column with a fractional filling becomes double.
    """
    columns = []
    for f in df.schema:
        column = F.col(f.name)
        if f.name in fillings:
            filling = fillings[f.name]
            if isinstance(filling, int):
                column = F.coalesce(column, F.lit(filling).cast(f.dataType))
            else:
                column = F.coalesce(column.cast("double"), F.lit(filling))
        elif text is not None and isinstance(f.dataType, T.StringType):
            column = F.coalesce(column, F.lit(text))
        columns.append(column.alias(f.name))
    return df.select(*columns)


@dataclass(frozen=True)
class Fence:
    """Inclusive limits of one column; ``active`` if any row lay outside when it was fitted."""

    column: str
    lower: float | None
    upper: float | None
    active: bool

    def keeps(self) -> Column:
        # Also drops NULL.  Over a stored column it is pushed to the scan; over a filled one it is not.
        return F.col(self.column).between(F.lit(self.lower), F.lit(self.upper))

    def outlier(self) -> Column:
        outside = (F.col(self.column) < F.lit(self.lower)) | (F.col(self.column) > F.lit(self.upper))
        return F.coalesce(outside, F.lit(False))


def fit_fences(df: DataFrame, columns: Sequence[str], skip: Sequence[str] = ("is_new",), small: int = SMALL) -> list[Fence]:
    """Quartiles plus and minus 1.5 interquartile ranges, column by column.

    Each column is fitted on the rows the earlier fences keep.  The limits are
    a few numbers on the driver, so that each step is a scan of one column
    under literal filters and no intermediate table is needed.
    """
    fences: list[Fence] = []
    for column in columns:
        if column in skip:
            continue
        found = spread(within_fences(df, fences), [column], [0.25, 0.75], small)[column]
        q1, q3 = found.quantiles
        if q1 is None:
            fences.append(Fence(column, None, None, False))
            continue
        lower, upper = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        fences.append(Fence(column, lower, upper, found.low < lower or found.high > upper))
    return fences


def within_fences(df: DataFrame, fences: Sequence[Fence]) -> DataFrame:
    """Rows inside every active fence; a column without outliers keeps its NULLs."""
    for fence in fences:
        if fence.active:
            df = df.where(fence.keeps())
    return df


def fence_report(df: DataFrame, fences: Sequence[Fence]) -> DataFrame:
    """Per column: limits, outliers among the rows the earlier fences keep; counted in one pass."""
    inside = F.lit(True)
    counts, rows = [], []
    for i, fence in enumerate(fences):
        counts.append(F.count_if(inside & fence.outlier()).alias(f"out_{i}"))
        rows.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(fence.column).alias("column_name"),
                F.lit(fence.lower).cast("double").alias("lower_bound"),
                F.lit(fence.upper).cast("double").alias("upper_bound"),
                F.col(f"out_{i}").alias("outliers"),
            )
        )
        if fence.active:
            inside = inside & F.coalesce(fence.keeps(), F.lit(False))
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def removal_summary(df: DataFrame, fences: Sequence[Fence]) -> DataFrame:
    """Rows before and after, removed rows, and their share of the rows before in percent."""
    inside = F.lit(True)
    for fence in fences:
        if fence.active:
            inside = inside & F.coalesce(fence.keeps(), F.lit(False))
    counts = df.agg(F.count("*").alias("initial_rows"), F.count_if(inside).alias("final_rows"))
    removed = F.col("initial_rows") - F.col("final_rows")
    return counts.select(
        "initial_rows",
        "final_rows",
        removed.alias("removed_rows"),
        F.try_divide(removed * F.lit(100.0), F.col("initial_rows")).alias("removed_percent"),
    )
