"""Decision trees and forests, grown on all rows and asked where they are grown.

A tree only asks between which thresholds of a feature a value lies.  Rows are therefore counted per cell, which is a
combination of bins, and class: one pass over the rows, and what is left to grow on is bounded by the bins, whatever the
number of rows.  A drawn tree weighs a cell of n rows by a Poisson number of mean n, as if each row were drawn by itself.

A fully grown forest is larger than its rows.  So no model is gathered: a task grows its share of the trees, level by
level in arrays, sends the cells to be predicted down each tree and returns their votes.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.operators.split import SEED
from shelfrank.session import small_table, write_table

# Tasks get the functions themselves; the module need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_DEPTH = 30
MAX_BINS = 256
# Counts and thresholds take a column per class; more values are no class label.
MAX_CLASSES = 100
# A vote of 1; whole numbers add up to the same sum in any order.
VOTE = 1 << 40
# Impurities below it are those of a single class.
EPSILON = 2.0**-52


def split_points(df: DataFrame, features: Sequence[str], bins: int = MAX_BINS) -> list[np.ndarray]:
    """The thresholds of each feature: halfway between all its values, or between those nearest to equal shares of the rows.

    Exact, from the counts of all values: they are sorted in ranges, and only the sizes of the ranges, the first value
    behind each share and the values beside a threshold come back.
    """
    spark = df.sparkSession
    counted = [
        df.groupBy(F.col(f).cast("double").alias("value")).agg(F.count("*").alias("n")).select(F.lit(i).alias("feature"), "value", "n")
        for i, f in enumerate(features)
    ]
    ranges = reduce(DataFrame.unionByName, counted).repartitionByRange("feature", "value").sortWithinPartitions("feature", "value")
    part = F.shiftright(F.monotonically_increasing_id(), 33)
    values = write_table(ranges.withColumn("part", part), "values")
    sizes = values.groupBy("feature", "part").agg(
        F.count("*").alias("values"),
        F.sum("n").alias("rows"),
        F.max(F.col("value").isNull() | F.isnan("value")).alias("gap"),
    )
    # A row per feature and range.
    sizes = sorted(sizes.collect(), key=lambda r: (r["feature"], r["part"]))
    if any(r["gap"] for r in sizes):
        raise ValueError("a feature has missing values")
    known, total, offsets = [0] * len(features), [0] * len(features), []
    for r in sizes:
        f = r["feature"]
        offsets.append((f, r["part"], known[f], total[f]))
        known[f] += r["values"]
        total[f] += r["rows"]
    if not sizes:
        return [np.empty(0) for _ in features]
    rows, shares = total[0], min(bins, total[0])
    upto = Window.partitionBy("feature", "part").orderBy("value")
    starts = small_table(spark, offsets, "feature int, part long, values_before long, rows_before long")
    placed = values.join(F.broadcast(starts), ["feature", "part"]).select(
        "feature",
        "value",
        (F.col("values_before") + F.row_number().over(upto)).alias("place"),
        # Twice the rows up to the middle of the value's own: a threshold before it is the nearest to the shares below that.
        (2 * (F.col("rows_before") + F.sum("n").over(upto)) - F.col("n")).alias("twice"),
    )
    share = F.expr(f"(twice * {shares}L - 1) div {2 * rows}L").alias("share")
    firsts = placed.select("feature", "place", share).groupBy("feature", "share").agg(F.min("place").alias("place")).collect()
    wanted = []
    for f in range(len(features)):
        own = sorted((r["share"], r["place"]) for r in firsts if r["feature"] == f)
        wanted += [(f, p) for p in _places(known[f], shares, own)]
    if not wanted:
        return [np.empty(0) for _ in features]
    asked = {(f, q) for f, p in wanted for q in (p - 1, p)}
    beside = placed.join(F.broadcast(small_table(spark, sorted(asked), "feature int, place long")), ["feature", "place"])
    found = {(r["feature"], r["place"]): r["value"] for r in beside.select("feature", "place", "value").collect()}
    return [np.array([(found[f, p - 1] + found[f, p]) / 2 for g, p in wanted if g == f]) for f in range(len(features))]


def _places(values: int, shares: int, firsts: Sequence[tuple[int, int]]) -> list[int]:
    """Before which values, counted from 1, a threshold stands; ``firsts`` has the first value behind some of the shares."""
    if values <= shares:
        return list(range(2, values + 1))
    places, at = [], 1
    for k in range(1, shares):
        first = next((p for s, p in firsts if s >= k), None)
        at = values + 1 if first is None else max(at + 1, first)
        if at > values:
            break
        places.append(at)
    return places


def _with_cells(df: DataFrame, features: Sequence[str], points: Sequence[np.ndarray]) -> DataFrame:
    """Add the cell of each row: a byte per feature, the number of thresholds below its value."""
    carried, names = df.columns, [f"_f{i}" for i in range(len(features))]
    read = df.select("*", *[F.col(f).cast("double").alias(n) for f, n in zip(features, names, strict=True)])

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.empty((batch.num_rows, len(names)), np.uint8)
            for i, (name, cuts) in enumerate(zip(names, points, strict=True)):
                column = batch.column(name)
                held = column.to_numpy(zero_copy_only=False)
                if column.null_count or np.isnan(held).any():
                    raise ValueError(f"{features[i]} has missing values")
                keys[:, i] = np.searchsorted(cuts, held)
            size = pa.binary(len(names))
            key = pa.Array.from_buffers(size, batch.num_rows, [None, pa.py_buffer(keys)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carried], key], [*carried, "_cell"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return read.mapInArrow(cells, f"{kinds}, _cell binary")


@dataclass(frozen=True)
class Cells:
    """The distinct cells of all rows, in their order: bins by feature, rows by class, and whether they are to be predicted."""

    keys: np.ndarray
    bins: np.ndarray
    counts: np.ndarray
    asked: np.ndarray


def _gini(counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    impurity = np.ones(len(rows))
    for c in counts:
        share = c / rows
        impurity -= share * share
    return impurity


def _best_splits(bins, weights, order, sizes, totals, chosen):
    """Of each node the gain, feature and bin of the best split, and the rows of each class that go left.

    ``order`` has the cells of the nodes, one node after the other, by the bins of each feature.  Of equal gains the first counts.
    """
    nodes = len(sizes)
    rows, starts = totals.sum(axis=0), np.cumsum(sizes) - sizes
    node, impurity = np.repeat(np.arange(nodes), sizes), _gini(totals, rows)
    best, feature, cut = np.zeros(nodes), np.zeros(nodes, np.intp), np.zeros(nodes, np.uint8)
    lefts = np.zeros_like(totals)
    places = np.arange(order.shape[1])
    for own in chosen:
        of_cell = own[node]
        cells = order[of_cell, places]
        bin_ = bins[of_cell, cells]
        edge = np.flatnonzero((bin_[1:] != bin_[:-1]) & (node[1:] == node[:-1]))
        if not len(edge):
            continue
        at = node[edge]
        left = np.empty((len(weights), len(edge)), np.int64)
        for c, w in enumerate(weights):
            sums = np.concatenate([[0], np.cumsum(w[cells], dtype=np.int64)])
            left[c] = sums[edge + 1] - sums[starts[at]]
        right = totals[:, at] - left
        n_left, n_right = left.sum(axis=0), right.sum(axis=0)
        gain = impurity[at] - n_left / rows[at] * _gini(left, n_left) - n_right / rows[at] * _gini(right, n_right)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        top = np.maximum.reduceat(gain, first)
        hit = np.flatnonzero(gain == np.repeat(top, np.diff(first, append=len(at))))
        pick = np.full(nodes, -1)
        pick[at[hit[::-1]]] = hit[::-1]
        better = np.flatnonzero(pick >= 0)
        better = better[gain[pick[better]] > best[better]]
        taken = pick[better]
        best[better], feature[better] = gain[taken], own[better]
        cut[better], lefts[:, better] = bin_[edge[taken]], left[:, taken]
    return best, feature, cut, lefts


def grow_tree(
    bins: np.ndarray, weights: np.ndarray, asked: np.ndarray, votes: np.ndarray, depth: int, subset: int, rng: np.random.Generator
) -> np.ndarray:
    """Grow one tree until its leaves are pure and add the leaves' class shares to the votes of the cells asked.

    ``bins`` is features x cells, ``weights`` classes x cells, ``asked`` features x cells and ``votes`` cells x classes.
    Returns what each feature gained, weighted by rows.
    """
    live = np.flatnonzero(weights.any(axis=0))
    bins, weights = bins[:, live], weights[:, live]
    features, gains = len(bins), np.zeros(len(bins))
    order = np.stack([np.argsort(b, kind="stable") for b in bins])
    sizes, totals = np.array([len(live)]), weights.sum(axis=1, dtype=np.int64)[:, None]
    waiting, at = np.arange(asked.shape[1]), np.zeros(asked.shape[1], np.intp)
    for level in range(depth + 1):
        nodes, rows = len(sizes), totals.sum(axis=0)
        if level == depth:
            chosen = []
        elif subset < features:
            chosen = np.argsort(rng.random((nodes, features)), axis=1)[:, :subset].T
        else:
            chosen = np.repeat(np.arange(features)[:, None], nodes, axis=1)
        best, feature, cut, lefts = _best_splits(bins, weights, order, sizes, totals, chosen)
        split = best > 0
        gains += np.bincount(feature[split], best[split] * rows[split], features)
        # A leaf gives each class its share of the leaf's rows.
        shares = np.rint(totals / rows * VOTE).astype(np.int64)
        done = ~split[at]
        votes[waiting[done]] += shares[:, at[done]].T
        waiting, at = waiting[~done], at[~done]
        if not split.any():
            break
        # The children of all split nodes, left before right; those of a single class are leaves.
        child = 2 * (np.cumsum(split) - 1)
        children = np.empty((len(totals), 2 * int(split.sum())), np.int64)
        children[:, 0::2] = lefts[:, split]
        children[:, 1::2] = totals[:, split] - lefts[:, split]
        n_children = children.sum(axis=0)
        open_ = np.abs(_gini(children, n_children)) >= EPSILON
        number = np.where(open_, np.cumsum(open_) - 1, -1)

        right = asked[feature[at], waiting] > cut[at]
        to = child[at] + right
        done = number[to] < 0
        shares = np.rint(children / n_children * VOTE).astype(np.int64)
        votes[waiting[done]] += shares[:, to[done]].T
        waiting, at = waiting[~done], number[to[~done]]
        if not open_.any():
            break

        node = np.repeat(np.arange(nodes), sizes)
        cells = order[0]
        went = bins[feature[node], cells] > cut[node]
        to = np.where(split[node], number[np.where(split[node], child[node] + went, 0)], -1)
        place = np.empty(len(live), np.intp)
        place[cells] = to
        is_right = np.empty(len(live), bool)
        is_right[cells] = went
        totals = children[:, open_]
        sizes = np.bincount(to[to >= 0], minlength=totals.shape[1])
        side = np.flatnonzero(open_) & 1
        # A cell moves behind those of its side that come before it; how far differs by child only.
        starts = np.cumsum(sizes) - sizes
        same = np.where(side == 1, np.cumsum(sizes * side), np.cumsum(sizes * (1 - side))) - sizes
        shift = starts - same - 1
        moved = np.empty((features, int(sizes.sum())), order.dtype)
        for f in range(features):
            cells = order[f][place[order[f]] >= 0]
            goes = is_right[cells]
            seen = np.cumsum(goes)
            moved[f][np.where(goes, seen, np.arange(1, len(cells) + 1) - seen) + shift[place[cells]]] = cells
        order = moved
    return gains


GROWN = "tree int, cell binary, votes array<bigint>, gains array<double>"


def _grow(cells: Cells, trees: Sequence[int], subset: int, bootstrap: bool, depth: int) -> Iterator[pa.RecordBatch]:
    """The votes of some trees for each cell asked, and a row per tree with its gains."""
    asked = cells.bins[:, cells.asked]
    votes, gains = np.zeros((asked.shape[1], len(cells.counts)), np.int64), []
    for tree in trees:
        rng = np.random.default_rng([SEED, tree])
        weights = rng.poisson(cells.counts) if bootstrap else cells.counts
        # A draw that leaves no row at all, which may happen to a handful of rows, is made again.
        while not weights.any():
            weights = rng.poisson(cells.counts)
        gains.append(grow_tree(cells.bins, weights, asked, votes, depth, subset, rng))
    n, keys = len(votes), cells.keys[cells.asked]
    schema = pa.schema([("tree", pa.int32()), ("cell", pa.binary()), ("votes", pa.list_(pa.int64())), ("gains", pa.list_(pa.float64()))])
    for start in range(0, n, 10_000):
        some = votes[start : start + 10_000]
        lists = pa.ListArray.from_arrays(np.arange(len(some) + 1, dtype=np.int32) * some.shape[1], pa.array(some.ravel()))
        columns = [pa.nulls(len(some), pa.int32()), pa.array(keys[start : start + len(some)].tolist(), pa.binary()), lists]
        yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(some), schema.field("gains").type)], schema=schema)
    own = [pa.array(list(trees), pa.int32()), pa.nulls(len(trees), pa.binary()), pa.nulls(len(trees), schema.field("votes").type)]
    yield pa.RecordBatch.from_arrays([*own, pa.array([g.tolist() for g in gains], schema.field("gains").type)], schema=schema)


def _unpacked(pieces: Sequence[tuple[bytes, bytes, bytes]], features: int, classes: int) -> Cells:
    keys = np.frombuffer(b"".join(p[0] for p in pieces), np.uint8).reshape(-1, features)
    counts = np.concatenate([np.frombuffer(p[1], np.int64).reshape(-1, classes) for p in pieces])
    asked = np.frombuffer(b"".join(p[2] for p in pieces), bool)
    # The draws belong to the cells in their order, not to the order of their arrival.
    order = np.lexsort(keys.T[::-1])
    keys = np.ascontiguousarray(keys[order])
    return Cells(keys.view(f"V{features}").ravel(), np.ascontiguousarray(keys.T), np.ascontiguousarray(counts[order].T), asked[order])


@dataclass(frozen=True)
class Forest:
    """Trees grown on all rows: what each feature gained per tree, and the votes for each cell that was asked."""

    features: tuple[str, ...]
    points: tuple[np.ndarray, ...]
    classes: int
    grown: DataFrame

    def importances(self) -> np.ndarray:
        """Each tree's gains as shares, averaged and scaled to add up to 1; a row per tree is read."""
        total = np.zeros(len(self.features))
        for row in sorted(self.grown.where("tree IS NOT NULL").select("tree", "gains").collect()):
            gains = np.array(row["gains"])
            total += gains / gains.sum() if gains.sum() else 0.0
        return total / total.sum() if total.sum() else total

    def transform(self, rows: DataFrame) -> DataFrame:
        """Add the prediction to the rows asked for; the first of the classes with most votes counts."""
        sums = F.array(*[F.sum(F.col("votes")[c]) for c in range(self.classes)])
        votes = self.grown.where("cell IS NOT NULL").groupBy(F.col("cell").alias("_cell")).agg(sums.alias("votes"))
        first = (F.array_position("votes", F.array_max("votes")) - 1).cast("int")
        # Cells may be millions in small files, so Spark must not take them for a table to broadcast.
        predicted = votes.select("_cell", first.alias("prediction")).hint("merge")
        return _with_cells(rows, self.features, self.points).join(predicted, "_cell").select(*rows.columns, "prediction")


def fit_trees(
    train: DataFrame,
    features: Sequence[str],
    label: str = "label",
    trees: int = 1,
    subset: int | None = None,
    bootstrap: bool = False,
    depth: int = MAX_DEPTH,
    bins: int = MAX_BINS,
    asked: DataFrame | None = None,
) -> Forest:
    """Grow trees by Gini splits until the leaves are pure, on all rows, and let them vote on the cells of the rows asked.

    A split looks at ``subset`` features drawn for its node, at all without it.
    """
    if not 2 <= bins <= MAX_BINS:
        raise ValueError(f"a feature is cut into 2 to {MAX_BINS} bins")
    spark = train.sparkSession
    known = train.agg(F.count("*").alias("rows"), F.count(label).alias("known"), F.min(label).alias("low"), F.max(label).alias("high")).first()
    if not known["rows"] or known["known"] < known["rows"] or known["low"] < 0 or known["high"] >= MAX_CLASSES:
        raise ValueError(f"{label} must be a class from 0 to {MAX_CLASSES - 1} in every row, and there must be one")
    classes, width = known["high"] + 1, len(features)
    points = split_points(train, features, bins)
    rows = _with_cells(train.select(F.col(label).cast("int").alias("class"), *features), features, points)
    rows = rows.select("_cell", "class", F.lit(False).alias("asked"))
    if asked is not None:
        others = _with_cells(asked.select(*features), features, points)
        rows = rows.unionByName(others.select("_cell", F.lit(None).cast("int").alias("class"), F.lit(True).alias("asked")))
    counts = F.array(*[F.count(F.when(F.col("class") == c, 1)) for c in range(classes)])
    cells = write_table(rows.groupBy("_cell").agg(counts.alias("counts"), F.max("asked").alias("asked")), "cells")

    def pack(batches):
        for b in batches:
            keys = b.column("_cell").cast(pa.binary(width)).buffers()[1]
            keys = np.frombuffer(keys, np.uint8)[: width * b.num_rows]
            held = b.column("counts").flatten().to_numpy(zero_copy_only=False)
            flags = b.column("asked").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_pydict({"keys": [keys.tobytes()], "counts": [held.astype(np.int64).tobytes()], "asked": [flags.tobytes()]})

    tasks = min(trees, spark.sparkContext.defaultParallelism)

    def grow(batches):
        pieces, task = [], None
        for b in batches:
            for row in b.to_pylist():
                task = row["task"]
                pieces.append((row["keys"], row["counts"], row["asked"]))
        if task is not None:
            yield from _grow(_unpacked(pieces, width, classes), range(task, trees, tasks), subset or width, bootstrap, depth)

    packed = cells.mapInArrow(pack, "keys binary, counts binary, asked binary")
    dealt = packed.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))).repartitionById(tasks, "task")
    return Forest(tuple(features), tuple(points), classes, write_table(dealt.mapInArrow(grow, GROWN), "grown"))
