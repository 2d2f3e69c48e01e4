"""Column expressions shared by the operators; all run inside code generation."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(column: Column) -> Column:
    """NaN becomes NULL, so that max, sort and filters skip it."""
    return F.when(~F.isnan(column), column)


def min_max(column: Column, low: Column, high: Column) -> Column:
    """Scale to [0, 1]; a constant column gives NULL."""
    return F.try_divide(column - low, high - low)


def z_score(column: Column, mean: Column, deviation: Column) -> Column:
    """Centre and scale by the given deviation; a constant column gives 0."""
    return F.when(deviation == 0, column * 0.0).otherwise(F.try_divide(column - mean, deviation))


def weighted_sum(weights: Mapping[str, float]) -> Column:
    """Sum of weight times column, in the order of ``weights``."""
    return reduce(add, [F.lit(float(w)) * F.col(c) for c, w in weights.items()])


def round_half_even(column: Column, places: int) -> Column:
    """Round the scaled double, halves to even, and scale back, as array libraries do.

    ``bround`` would round the decimal text of the number instead.
    """
    scale = F.lit(float(10**places))
    return F.rint(column * scale) / scale


def flag_number(column: Column) -> Column:
    """Boolean to 0 or 1; NULL counts as 0."""
    return F.coalesce(column.cast("int"), F.lit(0))
