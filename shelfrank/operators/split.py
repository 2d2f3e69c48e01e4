"""Label codes, stratified splits and folds, without sorting a class in one task.

A class may hold a third of all rows, so no window runs over a class.  The
cut-off values of each class are found as order statistics; membership is then
a comparison with a handful of cut-offs, and no row is shuffled for it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.operators.order_stats import SMALL, Extent, order_statistics
from shelfrank.session import small_table, write_table

SEED = 42
DRAWS = 1 << 60
TEST_SHARE = 0.2
FOLDS = 5
# Class tables up to this many rows are broadcast.
CLASS_LIMIT = 100_000


def label_codes(df: DataFrame, label: str = "category") -> DataFrame:
    """Each distinct label and its place 0..k-1 in sorted order."""
    found = df.where(F.col(label).isNotNull()).select(label).distinct().limit(CLASS_LIMIT + 1).collect()
    if len(found) > CLASS_LIMIT:
        raise ValueError(f"{label} has over {CLASS_LIMIT} values; it is no class label")
    classes = sorted(r[label] for r in found)
    kind = df.schema[label].dataType.simpleString()
    return small_table(df.sparkSession, [(c, i) for i, c in enumerate(classes)], f"`{label}` {kind}, label int")


def with_label_code(df: DataFrame, label: str = "category") -> DataFrame:
    """Add the label's code as ``label``."""
    # At most CLASS_LIMIT rows.
    return df.join(F.broadcast(label_codes(df, label)), label, "left")


def class_sizes(df: DataFrame, label: str) -> dict[str, int]:
    counted = df.groupBy(F.col(label).cast("string").alias("k")).agg(F.count("*").alias("n"))
    rows = counted.limit(CLASS_LIMIT + 1).collect()
    _check_classes([r["k"] for r in rows], label)
    return {r["k"]: r["n"] for r in rows}


def _check_classes(names: Sequence[str | None], label: str) -> None:
    if len(names) > CLASS_LIMIT:
        raise ValueError(f"{label} has over {CLASS_LIMIT} values; it is no class label")
    if None in names:
        raise ValueError(f"{label} has missing values")


def split_quotas(sizes: Mapping[str, int], share: float = TEST_SHARE, order: Sequence[str] | None = None) -> dict[str, int]:
    """Test rows per class: ``share`` of all rows rounded up, by largest remainder."""
    if any(n < 2 for n in sizes.values()):
        raise ValueError("a class has fewer than two rows")
    total = sum(sizes.values())
    n_test = math.ceil(share * total)
    names = list(order) if order is not None else sorted(sizes)
    quotas = {c: n_test * sizes[c] // total for c in names}
    by_remainder = sorted(names, key=lambda c: -(n_test * sizes[c] % total))
    for c in by_remainder[: n_test - sum(quotas.values())]:
        quotas[c] += 1
    return quotas


def draw(key: str = "row_id", seed: int = SEED) -> Column:
    """A number per row that depends on the row's key and the seed only: 60 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}-"), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def with_test_flag(
    df: DataFrame,
    label: str = "label",
    key: str = "row_id",
    share: float = TEST_SHARE,
    seed: int = SEED,
    small: int = SMALL,
) -> DataFrame:
    """Add ``is_test``: an exact stratified share of the rows, the lowest draws of each class."""
    sizes = class_sizes(df, label)
    # Codes sort as numbers, names as text.
    numeric = dict(df.dtypes)[label] in ("int", "bigint")
    quotas = split_quotas(sizes, share, sorted(sizes, key=int) if numeric else sorted(sizes))
    # Written with the rows, since each narrowing step and the result read the draws again.
    drawn = write_table(df.withColumn("_draw", draw(key, seed)), "draws", tight=True)
    wanted = [(c, q) for c, q in quotas.items() if q]
    extents = {c: Extent(n, 0, DRAWS - 1) for c, n in sizes.items()}
    cuts = order_statistics(drawn, "_draw", wanted, group=label, tie=key, small=small, extents=extents)
    rows = [(c, *cuts[c, q]) for c, q in wanted]
    limits = small_table(df.sparkSession, rows, "cut_class string, cut_draw long, cut_key long")
    below = (F.col("_draw") < F.col("cut_draw")) | (
        (F.col("_draw") == F.col("cut_draw")) & (F.col(key) <= F.col("cut_key"))
    )
    return (
        drawn.join(F.broadcast(limits), F.col(label).cast("string") == F.col("cut_class"), "left")
        .withColumn("is_test", F.coalesce(below, F.lit(False)))
        .drop("_draw", "cut_class", "cut_draw", "cut_key")
    )


def fold_quotas(sizes: Sequence[int], folds: int = FOLDS) -> list[list[int]]:
    """Rows per class and fold when the class-sorted rows are dealt out in turn.

    ``sizes`` are in order of each class's first row.
    """
    quotas, start = [], 0
    for n in sizes:
        quotas.append([(start + n - 1 - i) // folds - (start - 1 - i) // folds for i in range(folds)])
        start += n
    return quotas


def with_fold(
    df: DataFrame,
    label: str = "label",
    key: str = "row_id",
    folds: int = FOLDS,
    small: int = SMALL,
    among: Column | None = None,
) -> DataFrame:
    """Add ``fold``: stratified, unshuffled, each class in blocks by row order.

    With ``among``, the folds are those of these rows; others get NULL.
    Over ``CLASS_LIMIT`` classes are refused.
    """
    dealt = df if among is None else df.where(among)
    stats = dealt.groupBy(F.col(label).cast("string").alias("k")).agg(
        F.count("*").alias("n"), F.min(key).alias("first"), F.max(key).alias("last")
    )
    classes = sorted(stats.limit(CLASS_LIMIT + 1).collect(), key=lambda r: r["first"])
    _check_classes([r["k"] for r in classes], label)
    if max(r["n"] for r in classes) < folds:
        raise ValueError(f"no class has {folds} rows")
    wanted, cut_ranks = [], {}
    for r, quota in zip(classes, fold_quotas([r["n"] for r in classes], folds), strict=True):
        ends = [sum(quota[: i + 1]) for i in range(folds - 1)]
        cut_ranks[r["k"]] = ends
        wanted += [(r["k"], e) for e in ends if e]
    extents = {r["k"]: Extent(r["n"], r["first"], r["last"]) for r in classes}
    last = order_statistics(dealt, key, wanted, group=label, small=small, extents=extents)
    # The last row of each fold but the final one; a fold without rows ends before the first row.
    rows = [(k, [last[k, e][0] if e else -1 for e in ends]) for k, ends in cut_ranks.items()]
    limits = small_table(df.sparkSession, rows, "cut_class string, cut_ends array<long>")
    passed = F.size(F.filter("cut_ends", lambda end: end < F.col(key)))
    return (
        df.join(F.broadcast(limits), F.col(label).cast("string") == F.col("cut_class"), "inner" if among is None else "left")
        .withColumn("fold", passed if among is None else F.when(among, passed))
        .drop("cut_class", "cut_ends")
    )
