"""Exact order statistics and quantiles without gathering a column in one task.

Quantiles of columns: a mergeable sketch brackets each wanted rank between two values, closer and closer until
few rows lie between them; one more pass clamps the column to the bracket, which leaves the wanted
ranks as they are, and takes the exact percentile of what few distinct values remain.

Ranks within groups, with ties told apart: the interval holding each wanted rank is narrowed by histograms,
which Spark aggregates map-side, until what is left is small enough to be sorted in one task.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.session import small_table

# Rows of one interval that may be sorted in one task.
SMALL = 50_000
BINS = 4096
# A sketch of a column finds a rank within this share of the rows, and a bracket spares four times as much on either side.
SKETCH_ACCURACY = 10_000
MARGIN = 4 / SKETCH_ACCURACY


@dataclass(frozen=True)
class Extent:
    """Number of values of a group, and limits they lie within."""

    count: int
    low: float | int
    high: float | int


@dataclass(frozen=True)
class Target:
    """The ``rank``-th smallest value (from 1) of ``group``, known to lie in [low, high]."""

    group: str
    rank: int
    below: int
    low: float | int
    high: float | int
    count: int
    tie: int | None = None


def order_statistics(
    df: DataFrame,
    value: str,
    ranks: Sequence[tuple[str, int]],
    group: str | None = None,
    tie: str | None = None,
    small: int = SMALL,
    bins: int = BINS,
    extents: Mapping[str, Extent] | None = None,
) -> dict[tuple[str, int], tuple[float | int, int | None]]:
    """Map each (group, rank) to its (value, tie) in the order by value, then tie.

    ``df`` is read once per narrowing step; a step divides the interval by
    ``bins``.  Only one row per wanted rank reaches the driver.  Known
    ``extents`` save the first pass.
    """
    key = F.col(group).cast("string") if group else F.lit("")
    columns = [key.alias("grp"), F.col(value).alias("val")]
    columns += [F.col(tie).cast("long").alias("tie")] if tie else []
    rows = df.select(*columns).where(F.col("val").isNotNull())

    if extents is None:
        extents = {
            r["grp"]: Extent(r["n"], r["low"], r["high"])
            for r in rows.where(F.col("grp").isin(sorted({g for g, _ in ranks})))
            .groupBy("grp")
            .agg(F.count("*").alias("n"), F.min("val").alias("low"), F.max("val").alias("high"))
            .collect()
        }
    open_targets = []
    for g, rank in dict.fromkeys(ranks):
        if g not in extents or not 1 <= rank <= extents[g].count:
            raise ValueError(f"group {g!r} has no rank {rank}")
        e = extents[g]
        open_targets.append(Target(g, rank, 0, e.low, e.high, e.count))

    done: list[Target] = []
    value_type = rows.schema["val"].dataType
    while open_targets:
        # One value left: it is the answer, unless equal rows must be told apart.
        settled = [t for t in open_targets if t.low == t.high]
        if tie is None:
            done += settled
        else:
            done += [_settle_tie(rows, t, small, bins) for t in settled]
        rest = [t for t in open_targets if t.low != t.high]
        few = [t for t in rest if t.count <= small]
        if few:
            done += _pick(rows, few, value_type, tie is not None)
        many = [t for t in rest if t.count > small]
        open_targets = _narrow(rows, many, value_type, bins) if many else []
    return {(t.group, t.rank): (t.low, t.tie) for t in done}


def _target_frame(rows: DataFrame, targets: Sequence[Target], value_type: T.DataType) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("t_grp", T.StringType()),
            T.StructField("t_low", value_type),
            T.StructField("t_high", value_type),
            T.StructField("t_rank", T.LongType()),
            T.StructField("t_position", T.LongType()),
        ]
    )
    data = [(t.group, t.low, t.high, t.rank, t.rank - t.below) for t in targets]
    return small_table(rows.sparkSession, data, schema)


def _inside(rows: DataFrame, targets: Sequence[Target], value_type: T.DataType) -> DataFrame:
    """Rows within any wanted interval; the intervals of a group are disjoint."""
    one_each = {(t.group, t.low): t for t in targets}
    intervals = _target_frame(rows, list(one_each.values()), value_type).select("t_grp", "t_low", "t_high")
    return rows.join(
        F.broadcast(intervals),
        (F.col("grp") == F.col("t_grp")) & F.col("val").between(F.col("t_low"), F.col("t_high")),
    )


def _narrow(rows, targets, value_type, bins) -> list[Target]:
    frame = _target_frame(rows, targets, value_type)
    span = F.col("t_high").cast("double") - F.col("t_low").cast("double")
    place = (F.col("val") - F.col("t_low")).cast("double") / span
    bucket = F.least(F.floor(place * bins), F.lit(bins - 1)).cast("int")
    histogram = (
        _inside(rows, targets, value_type)
        .groupBy("t_grp", "t_low", bucket.alias("bucket"))
        .agg(F.count("*").alias("n"), F.min("val").alias("low"), F.max("val").alias("high"))
    )
    upto = Window.partitionBy("t_grp", "t_low").orderBy("bucket")
    hit = (
        histogram.withColumn("upto", F.sum("n").over(upto))
        .join(F.broadcast(frame), ["t_grp", "t_low"])
        .where("upto - n < t_position AND t_position <= upto")
    )
    before = {(t.group, t.rank): t for t in targets}
    return [
        replace(
            before[r["t_grp"], r["t_rank"]],
            below=before[r["t_grp"], r["t_rank"]].below + r["upto"] - r["n"],
            low=r["low"],
            high=r["high"],
            count=r["n"],
        )
        for r in hit.collect()
    ]


def _pick(rows, targets, value_type, with_tie) -> list[Target]:
    frame = _target_frame(rows, targets, value_type)
    order = ["val", "tie"] if with_tie else ["val"]
    position = F.row_number().over(Window.partitionBy("t_grp", "t_low").orderBy(*order))
    hit = (
        _inside(rows, targets, value_type)
        .withColumn("position", position.cast("long"))
        .join(F.broadcast(frame.drop("t_high")), ["t_grp", "t_low"])
        .where("position = t_position")
    )
    before = {(t.group, t.rank): t for t in targets}
    return [
        replace(
            before[r["t_grp"], r["t_rank"]],
            low=r["val"],
            high=r["val"],
            tie=r["tie"] if with_tie else None,
        )
        for r in hit.collect()
    ]


def _settle_tie(rows, target, small, bins) -> Target:
    same = rows.where((F.col("grp") == target.group) & (F.col("val") == F.lit(target.low)))
    rank = target.rank - target.below
    found = order_statistics(same, "tie", [("", rank)], small=small, bins=bins)
    return replace(target, tie=found["", rank][0])


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    small: int = SMALL,
) -> dict[str, list[float | None]]:
    """Exact quantiles per column with linear interpolation, NULLs skipped."""
    return {c: s.quantiles for c, s in spread(df, columns, probabilities, small).items()}


@dataclass(frozen=True)
class Spread:
    count: int
    low: float | None
    high: float | None
    quantiles: list[float | None]


@dataclass(frozen=True)
class Bracket:
    """Values between which a quantile of a column lies, if its sketch kept its word; ``rows`` of them are expected."""

    column: str
    probability: float
    count: int
    low: float
    high: float
    rows: float
    margin: float = MARGIN

    @property
    def place(self) -> float:
        return (self.count - 1) * self.probability

    def between(self) -> Column:
        """Rows between the two values, which may be frequent and are not counted."""
        value = _number(self.column)
        return (value > F.lit(self.low)) & (value < F.lit(self.high))

    def share(self, upto_low: int, inside: int) -> tuple[float, float]:
        """Where the wanted ranks lie among the rows between, with the margin on either side."""
        first, last = math.floor(self.place) - upto_low, math.ceil(self.place) + 1 - upto_low
        return max(0.0, first / inside - self.margin), min(1.0, last / inside + self.margin)


def spread(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    small: int = SMALL,
) -> dict[str, Spread]:
    """Count, extremes and exact quantiles per column; NULLs are skipped, a column of NULLs has none.

    Each pass is one aggregate over the columns still open.  A bracket of more than ``small`` rows is narrowed first.
    """
    facts = df.agg(
        *[f(F.col(c)).alias(f"{c}|{name}") for c in columns for name, f in [("n", F.count), ("low", F.min), ("high", F.max)]],
        *[_sketch(_number(c), [(p - MARGIN, p + MARGIN) for p in probabilities]).alias(f"{c}|sketch") for c in columns],
    ).first()
    brackets = []
    for c in columns:
        n, ends = facts[f"{c}|n"], facts[f"{c}|sketch"]
        for i, p in enumerate(probabilities if n else ()):
            low, high = float(facts[f"{c}|low"]), float(facts[f"{c}|high"])
            if n > small:
                low = ends[2 * i] if p > MARGIN else low
                high = ends[2 * i + 1] if p < 1 - MARGIN else high
            brackets.append(Bracket(c, p, n, low, high, min(n, 2 * MARGIN * n + 2)))
    found = _settle(df, brackets, small)
    return {
        c: Spread(facts[f"{c}|n"], facts[f"{c}|low"], facts[f"{c}|high"], [found.get((c, p)) for p in probabilities])
        for c in columns
    }


def _number(column: str) -> Column:
    return F.col(column).cast("double")


def _sketch(values: Column, shares: Sequence[tuple[float, float]]) -> Column:
    """Approximate quantiles at both ends of each share."""
    ends = [F.lit(min(1.0, max(0.0, float(end)))) for pair in shares for end in pair]
    return F.percentile_approx(values, F.array(*ends), SKETCH_ACCURACY)


def _settle(df: DataFrame, brackets: Sequence[Bracket], small: int) -> dict[tuple[str, float], float]:
    """The exact quantile in each bracket; a bracket that missed its ranks is drawn anew, eight times as wide."""
    found: dict[tuple[str, float], float] = {}
    while brackets:
        brackets = _narrowed(df, brackets, small)
        checks = []
        for i, b in enumerate(brackets):
            value = _number(b.column)
            clamped = F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(b.low)), F.lit(b.high)))
            checks += [
                F.count_if(value < F.lit(b.low)).alias(f"{i}|below"),
                F.count_if(value <= F.lit(b.high)).alias(f"{i}|upto"),
                F.percentile(clamped, F.lit(b.probability)).alias(f"{i}|value"),
            ]
        row = df.agg(*checks).first()
        missed = []
        for i, b in enumerate(brackets):
            if row[f"{i}|below"] <= math.floor(b.place) and math.ceil(b.place) < row[f"{i}|upto"]:
                found[b.column, b.probability] = row[f"{i}|value"]
            else:
                missed.append(b)
        brackets = _redrawn(df, missed) if missed else []
    return found


def _narrowed(df: DataFrame, brackets: Sequence[Bracket], small: int) -> list[Bracket]:
    """Brackets with at most ``small`` rows between their ends, or such as a sketch of these rows no longer halves."""
    done = [b for b in brackets if b.rows <= small or b.low == b.high]
    wide = [(b, math.inf) for b in brackets if b.rows > small and b.low != b.high]
    while wide:
        counts = df.agg(
            *[F.count_if(_number(b.column) <= F.lit(b.low)).alias(f"{i}|upto_low") for i, (b, _) in enumerate(wide)],
            *[F.count_if(b.between()).alias(f"{i}|inside") for i, (b, _) in enumerate(wide)],
        ).first()
        open_ones = []
        for i, (b, before) in enumerate(wide):
            inside = counts[f"{i}|inside"]
            first, last = b.share(counts[f"{i}|upto_low"], max(1, inside))
            # Ranks beyond the bracket are left to the check that follows.
            if inside <= small or inside > before / 2 or not first < last:
                done.append(b)
            else:
                open_ones.append((b, inside, first, last))
        if not open_ones:
            break
        ends = df.agg(
            *[
                _sketch(F.when(b.between(), _number(b.column)), [(first, last)]).alias(str(i))
                for i, (b, _, first, last) in enumerate(open_ones)
            ]
        ).first()
        wide = []
        for i, (b, inside, first, last) in enumerate(open_ones):
            low = b.low if first == 0 else ends[str(i)][0]
            high = b.high if last == 1 else ends[str(i)][1]
            closer = replace(b, low=low, high=high, rows=(last - first) * inside)
            if closer.rows <= small or low == high:
                done.append(closer)
            else:
                wide.append((closer, inside))
    return done


def _redrawn(df: DataFrame, missed: Sequence[Bracket]) -> list[Bracket]:
    margins = [8 * b.margin for b in missed]
    row = df.agg(
        *[f(_number(b.column)).alias(f"{i}|{name}") for i, b in enumerate(missed) for name, f in [("low", F.min), ("high", F.max)]],
        *[
            _sketch(_number(b.column), [(b.probability - m, b.probability + m)]).alias(f"{i}|ends")
            for i, (b, m) in enumerate(zip(missed, margins, strict=True))
        ],
    ).first()
    return [
        replace(
            b,
            low=row[f"{i}|ends"][0] if b.probability > m else row[f"{i}|low"],
            high=row[f"{i}|ends"][1] if b.probability < 1 - m else row[f"{i}|high"],
            rows=min(b.count, 2 * m * b.count + 2),
            margin=m,
        )
        for i, (b, m) in enumerate(zip(missed, margins, strict=True))
    ]
