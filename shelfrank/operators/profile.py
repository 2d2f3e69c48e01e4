"""Table profiles: sizes, gaps, distinct values, ranges, value counts, histograms."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.operators.order_stats import spread
from shelfrank.session import small_table

HISTOGRAM_BINS = 30


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count("*").alias("row_count"), F.lit(len(df.columns)).cast("long").alias("column_count"))


def column_types(df: DataFrame) -> DataFrame:
    """Column names and types in order; read from the schema, not from data."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes)]
    return small_table(df.sparkSession, rows, "position int, column_name string, data_type string")


def _long_form(df: DataFrame, metrics: dict[str, dict[str, F.Column]]) -> DataFrame:
    """One aggregate over ``df``, then one row per column of it."""
    flat = df.agg(*[e.alias(f"{c}|{m}") for c, by_name in metrics.items() for m, e in by_name.items()])
    rows = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{c}|{m}`").alias(m) for m in by_name])
        for c, by_name in metrics.items()
    ]
    return flat.select(F.inline(F.array(*rows)))


def null_counts(df: DataFrame, all_columns: bool = False) -> DataFrame:
    """Number of NULLs per column, only columns that have any unless asked for."""
    counts = _long_form(df, {c: {"null_count": F.count_if(F.col(c).isNull())} for c in df.columns})
    return counts if all_columns else counts.where("null_count > 0")


def total_nulls(df: DataFrame) -> DataFrame:
    """NULL cells over the whole table."""
    cells = sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0))
    return df.agg(F.coalesce(F.sum(cells.cast("long")), F.lit(0).cast("long")).alias("null_cells"))


def distinct_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct values per column, NULL not counted.

    The exact form groups each column by itself: counting all in one aggregate would copy every row once per
    column.  Each count scans only its own column, so ``df`` should be a written table.  The
    approximate form needs a single pass and no shuffle of values.
    """
    if approximate:
        return _long_form(df, {c: {"distinct_count": F.approx_count_distinct(F.col(c))} for c in df.columns})
    counts = [
        df.select(F.col(c).alias("value")).agg(F.lit(c).alias("column_name"), F.count_distinct("value").alias("distinct_count"))
        for c in df.columns
    ]
    return reduce(DataFrame.union, counts)


def _as_number(field: T.StructField) -> F.Column:
    column = F.col(field.name)
    if isinstance(field.dataType, T.TimestampNTZType):
        # Seconds by the clock; a cast to a timestamp would depend on the session's time zone.
        elapsed = column - F.expr("timestamp_ntz'1970-01-01 00:00:00'")
        column = elapsed.cast("interval second").cast("decimal(18,6)")
    if isinstance(field.dataType, T.BooleanType):
        column = column.cast("int")
    return column.cast("double")


def _has_range(field: T.StructField) -> bool:
    kinds = (T.NumericType, T.BooleanType, T.TimestampType, T.TimestampNTZType)
    return isinstance(field.dataType, kinds)


def ranges(df: DataFrame) -> DataFrame:
    """Smallest and largest value per column that is not text.

    All as numbers: flags as 0 and 1, times as seconds since 1970.
    """
    return _long_form(
        df,
        {
            f.name: {"min_value": F.min(_as_number(f)), "max_value": F.max(_as_number(f))}
            for f in df.schema
            if _has_range(f)
        },
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first, NULL left out; equal counts in value order."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("row_count"))
        .orderBy(F.desc("row_count"), column)
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histogram per column; empty bins are kept, the last bin is closed.

    A constant column v is spread over [v - 0.5, v + 0.5].
    """
    limits = df.agg(
        *[f(F.col(c).cast("double")).alias(f"{c}|{n}") for c in columns for n, f in [("low", F.min), ("high", F.max)]]
    ).first()
    cells, frames = [], []
    for c in columns:
        low, high = limits[f"{c}|low"], limits[f"{c}|high"]
        if low is None:
            continue
        if low == high:
            low, high = low - 0.5, high + 0.5
        frames.append((c, low, high))
        place = F.floor((F.col(c).cast("double") - F.lit(low)) * bins / F.lit(high - low))
        cells.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.when(F.col(c).isNotNull(), F.least(place, F.lit(bins - 1)).cast("int")).alias("bin"),
            )
        )
    spark = df.sparkSession
    schema = "column_name string, low double, high double"
    edges = small_table(spark, frames, schema).select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    if not frames:
        return edges.select("column_name", "bin", F.col("low").alias("bin_low"), F.col("high").alias("bin_high"), F.lit(0).cast("long").alias("row_count"))
    counts = (
        df.select(F.inline(F.array(*cells)))
        .where("bin IS NOT NULL")
        .groupBy("column_name", "bin")
        .agg(F.count("*").alias("row_count"))
    )
    width = (F.col("high") - F.col("low")) / bins
    return edges.join(counts, ["column_name", "bin"], "left").select(
        "column_name",
        "bin",
        (F.col("low") + F.col("bin") * width).alias("bin_low"),
        (F.col("low") + (F.col("bin") + 1) * width).alias("bin_high"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
    )


def mean_and_deviation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and sample standard deviation per column."""
    return _long_form(df, {c: {"mean": F.avg(c), "std_sample": F.stddev_samp(c)} for c in columns})


def quartile_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """First and third quartile per column, linear interpolation."""
    found = spread(df, columns, [0.25, 0.75])
    rows = [(c, *map(_maybe_float, found[c].quantiles)) for c in columns]
    return small_table(df.sparkSession, rows, "column_name string, q1 double, q3 double")


def _maybe_float(value):
    return None if value is None else float(value)
