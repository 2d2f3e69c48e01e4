"""CSV in and out: header scans, missing files, NA tokens, type inference."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from typing import TypeVar

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.functions import nan_to_null
from shelfrank.sources.stack import union_all_by_name, with_scan_place, with_scan_position

log = logging.getLogger(__name__)

# The texts a CSV reader takes for a missing cell (pandas' documented defaults).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_T = TypeVar("_T")


def scan_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Read headed CSV files, one file or folder per path.

    With a schema, each file's own header places the columns, so that files with
    other column orders or missing columns load too; NA tokens become NULL.
    Without one, types are inferred in one pass over the text.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    text = union_all_by_name([_read_text(spark, p, _cells_span_lines(spark, p)) for p in paths])
    if schema is None:
        return infer_types(text)
    return parse_columns(text, schema)


def _cells_span_lines(spark: SparkSession, path: str) -> bool:
    """Whether a quoted cell may hold a line break: then a line has an odd number of quotes.

    Files of such a path cannot be split, so that each is read by one task.  This scan is
    split, stops at the first such line, and spares the other paths that fate.
    """
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def _read_text(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    # A doubled quote stands for a quote.
    return (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )


def scan_in_order(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None, name: str = "row_id"
) -> DataFrame:
    """``scan_csv`` with the position 0..n-1 of each row in its files.

    Paths come in the order given, the files of a folder in the order of their part numbers, others
    by name, rows as they stand in their file.  Files without rows take no position.  A column
    of the files called ``name`` is refused.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    frames = [_read_text(spark, p, _cells_span_lines(spark, p)) for p in paths]
    if any(name in f.columns for f in frames) or (schema is not None and name in schema.names):
        raise ValueError(f"the files have a column {name} of their own")
    numbered = with_scan_position(union_all_by_name([with_scan_place(f, i) for i, f in enumerate(frames)]), name)
    types = schema or inferred_schema(numbered.drop(name))
    return parse_columns(numbered, types, keep=[name])


def scan_present(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """``scan_csv`` over the paths that exist; the others are logged and left out."""
    present = [p for p in paths if _exists(spark, p)]
    for path in paths:
        if path not in present:
            log.warning("%s not found", path)
    if not present:
        raise FileNotFoundError("no objects to concatenate: none of the files exists")
    return scan_csv(spark, present, schema)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_tables(sources: Mapping[str, Callable[[], _T]]) -> dict[str, _T]:
    """Open each named source; one that cannot be opened is logged and left out."""
    opened = {}
    for name, open_source in sources.items():
        try:
            opened[name] = open_source()
        except (AnalysisException, FileNotFoundError) as error:
            log.warning("source %s skipped: %s", name, error)
    return opened


def _named(name: str) -> Column:
    """A column by its whole name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def _present_text(column: Column) -> Column:
    return F.when(~column.isin(*NA_TOKENS), column)


# What a CSV reader takes for numbers and truth values; Spark's casts accept more ("10D", "y").
WHOLE = r"^[+-]?[0-9]+$"
NUMBER = r"^[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|[iI]nf(?:inity)?)$"
TRUTH = r"^(?:true|false|True|False|TRUE|FALSE)$"


def _cast(text: Column, data_type: T.DataType) -> Column:
    """The cell as the type, NULL if it is not written as such."""
    if isinstance(data_type, T.IntegralType):
        return F.when(text.rlike(WHOLE), text.try_cast(data_type))
    if isinstance(data_type, T.FractionalType):
        return F.when(text.rlike(NUMBER), text.try_cast(data_type))
    if isinstance(data_type, T.BooleanType):
        return F.when(text.rlike(TRUTH), text.try_cast(data_type))
    return text.try_cast(data_type)


def _cell(name: str, data_type: T.DataType) -> Column:
    """The text of a cell, without the spaces round what is no text."""
    text = _present_text(_named(name))
    return text if isinstance(data_type, T.StringType) else F.trim(text)


def _parse(text: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        return text
    if isinstance(data_type, T.IntegralType):
        # A column with missing cells may have been written as 3.0.
        whole = _cast(text, T.DoubleType())
        return F.coalesce(
            _cast(text, data_type),
            F.when(whole == F.floor(whole), whole.try_cast(data_type)),
        )
    parsed = _cast(text, data_type)
    return nan_to_null(parsed) if isinstance(data_type, T.FractionalType) else parsed


def parse_columns(text: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Cast string columns to ``schema``; NA tokens and missing columns give NULL.  Columns to ``keep`` follow as they are.

    Cells are taken before they are cast: all in one expression would be too long for the JVM to compile.
    """
    kept = [_named(c) for c in keep]
    cells = text.select(*[_cell(f.name, f.dataType).alias(f.name) for f in schema if f.name in text.columns], *kept)
    parsed = [_parse(_named(f.name), f.dataType) if f.name in text.columns else F.lit(None).cast(f.dataType) for f in schema]
    return cells.select(*[c.alias(f.name) for c, f in zip(parsed, schema, strict=True)], *kept)


def infer_types(text: DataFrame) -> DataFrame:
    """Give each string column the narrowest of long, double, boolean and string that fits all cells."""
    return parse_columns(text, inferred_schema(text))


def inferred_schema(text: DataFrame) -> T.StructType:
    """The types ``infer_types`` gives, found in one pass over the cells."""
    tried = {"bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}
    # Each cell is taken once for all tries.
    cells = text.select(*[F.trim(_present_text(_named(name))).alias(str(i)) for i, name in enumerate(text.columns)])
    checks = []
    for i in range(len(text.columns)):
        checks.append(F.count(str(i)).alias(f"{i}|n"))
        checks += [F.count(_cast(F.col(str(i)), kind)).alias(f"{i}|{t}") for t, kind in tried.items()]
    counts = cells.agg(*checks).first()
    fields = []
    for i, name in enumerate(text.columns):
        fits = [t for k, t in tried.items() if counts[f"{i}|n"] and counts[f"{i}|{k}"] == counts[f"{i}|n"]]
        # Empty columns are numeric, as in a reader that stores gaps as NaN.
        default = T.StringType() if counts[f"{i}|n"] else T.DoubleType()
        fields.append(T.StructField(name, fits[0] if fits else default))
    return T.StructType(fields)


def write_csv(df: DataFrame, path: str, leading: Sequence[str] = ()) -> None:
    """Write headed CSV part files; ``leading`` columns (group keys) come first."""
    rest = [c for c in df.columns if c not in leading]
    df.select(*leading, *rest).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
