"""Stacking tables and numbering rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.session import write_table


def union_all_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack tables, match columns by name, fill absent columns with NULL, keep duplicates."""
    if not frames:
        raise ValueError("no objects to concatenate")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_row_id(df: DataFrame, order: Sequence[str], name: str = "row_id", keep: Sequence[str] | None = None) -> DataFrame:
    """Add the position 0..n-1 in the order of the given columns.

    A global window would sort all rows in one task.  Here the rows are sorted
    in ranges, which are written once, since a second evaluation could choose
    other range limits; each range then gets the number of rows before it.
    ``order`` must identify a row, or equal rows get arbitrary positions.
    Only the columns to ``keep``, all without it, are written and returned.
    """
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges = ranges if keep is None else ranges.select(*keep)
    marked = write_table(ranges.withColumn("_mark", F.monotonically_increasing_id()), "ranges", tight=True)
    # The upper bits of the mark are the range, the lower 33 the position in it.
    part = F.shiftright("_mark", 33)
    sizes = marked.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    # One row per range: at most spark.sql.shuffle.partitions of them.
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return (
        marked.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_mark").bitwiseAND((1 << 33) - 1))
        .drop("_mark", "_part", "_before")
    )


# Where a row stands in its files; names no CSV file is likely to have, and one that has them is refused.
_PLACE = ("_scan_path", "_scan_part", "_scan_file", "_scan_block")
_MARK = "_scan_mark"


def with_scan_place(scan: DataFrame, path: int = 0) -> DataFrame:
    """Add to a scan of files where each row was read: path number, part number, file, block and a mark.

    Must be applied to the scan itself, whose metadata it reads.  A block is read by one task from
    its first row to its last, so marks rise by one from row to row within a block.
    """
    taken = {*_PLACE, _MARK} & set(scan.columns)
    if taken:
        raise ValueError(f"the files have columns named {sorted(taken)}")
    file = F.col("_metadata.file_path")
    # Part numbers grow beyond five digits, so names alone do not sort.
    part = F.coalesce(F.regexp_extract(file, r"/part-([0-9]+)[^/]*$", 1).try_cast("long"), F.lit(-1).cast("long"))
    place = [F.lit(path), part, file, F.col("_metadata.file_block_start")]
    return scan.select("*", *[c.alias(n) for c, n in zip(place, _PLACE, strict=True)], F.monotonically_increasing_id().alias(_MARK))


def with_scan_position(placed: DataFrame, name: str = "row_id") -> DataFrame:
    """Replace the places of ``with_scan_place`` by the position 0..n-1 over all files.

    The rows are written once, as another scan could cut other blocks.  No row is sorted or gathered:
    only the sizes of blocks are summed up, those of a file among themselves and the
    sizes of files over all, one small row per file.
    """
    rows = write_table(placed, "placed")
    *whole, block = _PLACE
    blocks = rows.groupBy(*_PLACE).agg(F.count("*").alias("_size"), F.min(_MARK).alias("_first"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn(
        "_in_file", F.coalesce(F.sum("_size").over(before.partitionBy(*whole).orderBy(block)), F.lit(0))
    )
    files = blocks.groupBy(*whole).agg(F.sum("_size").alias("_size"))
    files = files.select(*whole, F.coalesce(F.sum("_size").over(before.orderBy(*whole)), F.lit(0)).alias("_before"))
    starts = blocks.join(files, whole).select(*_PLACE, (F.col("_before") + F.col("_in_file") - F.col("_first")).alias("_start"))
    position = (F.col("_start") + F.col(_MARK)).alias(name)
    kept = [F.col("`" + c.replace("`", "``") + "`") for c in placed.columns if c not in (*_PLACE, _MARK)]
    # One row per block.  Left to itself Spark may broadcast the rows, whose files are small for what they hold.
    return rows.join(F.broadcast(starts), list(_PLACE)).select(*kept, position)
