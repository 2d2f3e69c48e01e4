"""Choosing analysis columns and rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.functions import flag_number

# The text columns kept beside the numbers.
CONTEXT_COLUMNS = ("category", "subcategory", "name", "brand", "currency")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ("id", "row_id"), flag: str | None = None) -> list[str]:
    """Integer and fractional columns in schema order.

    Flags are not numeric; ``flag`` names one that is appended all the same,
    if it is there as a boolean or as text.
    """
    chosen = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]
    promotable = (T.BooleanType, T.StringType)
    if flag in df.columns and flag not in chosen and isinstance(df.schema[flag].dataType, promotable):
        chosen.append(flag)
    return chosen


def analysis_columns(
    df: DataFrame,
    numeric: Sequence[str],
    context: Sequence[str] = CONTEXT_COLUMNS,
    strict: bool = False,
    keys: Sequence[str] = ("row_id",),
) -> DataFrame:
    """Numbers, then context columns; a missing context column is left out, or an error if strict."""
    missing = [c for c in context if c not in df.columns]
    if strict and missing:
        raise KeyError(f"columns not in table: {missing}")
    kept = [c for c in keys if c in df.columns]
    return df.select(*kept, *numeric, *[c for c in context if c in df.columns])


def with_flag_number(df: DataFrame, flag: str = "is_new", name: str = "new_score") -> DataFrame:
    """Add the flag as 0 or 1; a table without the flag gets 0 throughout."""
    number = flag_number(F.col(flag)) if flag in df.columns else F.lit(0)
    return df.withColumn(name, number)


def rows_equal(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def feature_columns(df: DataFrame, features: Sequence[str], label: str = "category", keys: Sequence[str] = ("row_id",)) -> DataFrame:
    return df.select(*[c for c in keys if c in df.columns], *features, label)
