"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.session import write_table

ROWS_PER_RANGE = 10_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text) -> F.Column:
    """Words of a text; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, epochs: int = 2
) -> DataFrame:
    """(source, source_size, target): ``share`` of all words dealt by weight, at most ``epochs`` times a source.

    ``sizes`` has ``source`` and ``source_size``, one row per source.  Sources weigh
    ``weights`` in turn by code point, null last.  With r = epochs * size / weight a
    source is full exactly when the common level reaches r, so the level follows from
    running sums over the sources in order of r: no round of resharing is needed.
    Sources without words get 0.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("weight", weight.cast("double")).withColumn("limit", F.col("source_size") * F.lit(float(epochs)))
    s = s.withColumn("full_at", F.col("limit") / F.col("weight"))
    rising = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns(
        {
            "budget": F.sum("source_size").over(everything) * F.lit(float(share)),
            "spent": F.coalesce(F.sum("limit").over(before), F.lit(0.0)),
            "open": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    )
    # The level if all sources before this one are full and none from here on.
    level = (F.col("budget") - F.col("spent")) / F.col("open")
    s = s.withColumn("level", F.when(level < F.col("full_at"), level))
    # Beyond the first source that stays open, this falls: those before it are not all full.
    target = F.least(F.col("limit"), F.max("level").over(everything) * F.col("weight"))
    return s.select("source", "source_size", F.coalesce(target, F.col("limit")).alias("target"))


def _sized(docs: DataFrame, seed: str) -> DataFrame:
    draw = F.md5(F.concat_ws("-", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return docs.withColumns({"_size": word_count(F.col("text")), "_draw": draw})


def source_cuts(sized: DataFrame, weights: Sequence[int], share: float, epochs: int) -> DataFrame:
    """Per source: target, whole epochs, and the place in hash order where the last epoch ends.

    ``sized`` has source, _size and _draw.  Totals per (source, range of draws) find
    the range that holds the budget; the running sum is needed in that range alone, so no
    task sees more of a source than about ``ROWS_PER_RANGE`` rows, however large the source.
    """
    ranges = max(1, -(-sized.count() // ROWS_PER_RANGE))
    # Draws are hash-random: equal parts of their range hold equal shares of the rows.
    part = F.floor(F.conv(F.substring("_draw", 1, 8), 16, 10).cast("double") * ranges / 2.0**32).cast("long")
    rows = sized.withColumn("part", part)
    parts = write_table(rows.groupBy("source", "part").agg(F.sum("_size").alias("words")), "mix-parts")
    totals = parts.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = source_targets(totals, weights, share, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = plan.withColumn("whole", whole.cast("long"))
    plan = plan.withColumn("rest", F.floor(F.col("target")).cast("long") - F.col("whole") * F.col("source_size"))
    plan = write_table(plan.withColumnRenamed("source", "of_source"), "mix-plan")

    order = Window.partitionBy("source").orderBy("part")
    ahead = parts.withColumn("upto", F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    at = ahead.join(plan, F.col("source").eqNullSafe(F.col("of_source")))
    at = at.where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("words") <= F.col("rest")) & (F.col("rest") > 0))
    at = at.select("of_source", "rest", F.col("part").alias("of_part"), (F.col("upto") - F.col("words")).alias("base"))
    near = rows.join(at, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("part") == F.col("of_part")))
    near = near.groupBy("of_source", "base", "rest", "_draw", "_size").agg(F.count(F.lit(1)).alias("equal"))
    inside = Window.partitionBy("of_source").orderBy("_draw", "_size").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("upto", F.col("base") + F.sum(F.col("_size") * F.col("equal")).over(inside))
    start = F.col("upto") - F.col("_size") * F.col("equal")
    cut = near.where((start <= F.col("rest")) & (F.col("upto") > F.col("rest")))
    cut = cut.select(
        F.col("of_source").alias("cut_source"),
        F.col("_draw").alias("cut_draw"),
        F.col("_size").alias("cut_size"),
        F.floor((F.col("rest") - start) / F.col("equal")).cast("long").alias("cut_words"),
    )
    plan = plan.join(cut, F.col("of_source").eqNullSafe(F.col("cut_source")), "left").drop("cut_source")
    return write_table(plan, "mix-cuts")


def _with_taken(sized: DataFrame, cuts: DataFrame) -> DataFrame:
    rows = sized.join(cuts, F.col("source").eqNullSafe(F.col("of_source")))
    place = F.struct("_draw", "_size")
    end = F.struct(F.col("cut_draw").alias("_draw"), F.col("cut_size").alias("_size"))
    extra = (
        F.when(F.col("cut_draw").isNull(), F.lit(0))
        .when(place < end, F.col("_size"))
        .when(place == end, F.col("cut_words"))
        .otherwise(F.lit(0))
    )
    return rows.withColumn("taken", (F.col("whole") * F.col("_size") + extra).cast("long"))


def mix_sources(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, epochs: int = 2, seed: str = "mix"
) -> DataFrame:
    """How many words of each document the mix takes: doc_id, size, source_size, target, taken.

    Documents of a source stand in the order of a hash of seed and doc_id.  The mix takes
    whole epochs of the source and then its words in that order up to the exact budget; the
    document at the end of the budget is cut.

    Null text has size 0 and takes 0; null sources are one source; an empty table gives no
    rows.  Rows with the same doc_id (or none) stand side by side by size; if the budget ends
    among equal ones, each takes the same number of words.  Other columns are ignored.
    """
    sized = write_table(_sized(docs, seed).select("doc_id", "source", "_size", "_draw"), "mix-sizes")
    rows = _with_taken(sized, source_cuts(sized, weights, share, epochs))
    return rows.select("doc_id", F.col("_size").alias("size"), "source_size", "target", "taken")


def apply_mix(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, epochs: int = 2, seed: str = "mix"
) -> DataFrame:
    """The mix itself: each document as often as taken, its last copy ending after the last word taken.

    Documents of which nothing is taken go.  The columns stay those of ``docs``; n_chars follows the text.
    The texts are not shuffled: a row meets only the small table of cuts.
    """
    packed = docs.select(F.struct("*").alias("row"), "doc_id", "source", "text")  # no column of docs clashes with ours
    sized = write_table(_sized(packed, seed).select("source", "_size", "_draw"), "mix-sizes")
    rows = _with_taken(_sized(packed, seed), source_cuts(sized, weights, share, epochs)).where("taken > 0")
    copies = F.sequence(F.lit(0).cast("long"), F.floor((F.col("taken") - 1) / F.col("_size")))
    rows = rows.withColumn("copy", F.explode(copies))
    rows = rows.withColumn("words", F.least(F.col("_size"), F.col("taken") - F.col("copy") * F.col("_size")))
    head = F.expr(r"regexp_substr(text, concat('^(?:[\\x20\\x09-\\x0D]*+[^\\x20\\x09-\\x0D]++){', words, '}+'))")
    text = F.when(F.col("words") >= F.col("_size"), F.col("text")).otherwise(head)
    rows = rows.withColumn("text", text)
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return rows.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
