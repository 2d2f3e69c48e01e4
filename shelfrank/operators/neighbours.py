"""Exact k nearest neighbours over a k-d tree of bounded nodes.

Spark splits the training points level by level, each node along its widest feature at up to ``CUTS`` values.  Every
value cut at gets a child of its own, so a value shared by many points leaves that feature behind and the next split
is along another one: nodes end at ``NODE_SIZE`` points whatever the data.  Inside a node the split goes on to
leaves of ``TILE_SIZE`` points.  A query takes the k-th distance in its home node as its reach, and walks down the
tree once more: of a node's children only those are visited whose box, by its squared gap, lies within reach and
holds points that may count.  Nothing closer can lie elsewhere, so the result is exact, ties included.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.session import write_table

NEIGHBOURS = 5
#: Points of a leaf, of a node, and queries that look into a copy of a node together.
TILE_SIZE = 48
NODE_SIZE = 4096
ASKED_AT_ONCE = 4096
CUTS = 15
#: Candidates held for a block of queries before they are cut down to k each.
CANDIDATES = 1 << 20
#: Levels whose boxes every task holds, at most 1 + 31 + 31^2 + 31^3 of them, and rows that walk them together.
TOP_LEVELS = 4
WALKED_AT_ONCE = 8192


def nearest_votes(
    train: DataFrame,
    queries: DataFrame,
    features: Sequence[str],
    label: str = "label",
    key: str = "row_id",
    k: int = NEIGHBOURS,
    exclude: str | None = None,
    tile_size: int = TILE_SIZE,
    node_size: int = NODE_SIZE,
) -> DataFrame:
    """Add ``prediction`` to ``queries``: the commonest label of the k nearest training rows.

    Equal distances go by the smaller key, equal votes by the smaller label.
    A query with a missing feature has no neighbours and a NULL prediction;
    training rows with one do not count.
    With ``exclude``, training rows that share the query's value in that column
    do not count, which serves all folds of a cross-validation in one run.
    """
    same = [exclude] if exclude else []
    complete = train.select(key, label, *same, *_numbers(features)).dropna(subset=list(features))
    points = _without_copies(complete, [*features, *same], key, k)
    search = Search(build_tree(points, features, exclude, max(node_size, 2 * k)), label, key, k, tile_size)
    # Equal queries are asked once.
    asked = queries.select(*same, *_numbers(features)).dropna(subset=list(features)).distinct()
    # Little data but much work per row: spread over all tasks.
    spark = asked.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    asked = write_table(asked.repartition(tasks).withColumn("_query", F.monotonically_increasing_id()), "queries")
    votes = search.closest(asked).groupBy("_query").agg(F.mode(label, True).alias("prediction"))
    # Here and below: tables with a row per query are merged, as their small files would pass for small tables.
    answers = asked.join(votes.hint("merge"), "_query").drop("_query")
    on = [*features, *same]
    renamed = answers.select(*[F.col(c).alias(f"_{c}") for c in on], "prediction")
    matches = [F.col(c).cast("double") == F.col(f"_{c}") for c in features]
    matches += [F.col(c) == F.col(f"_{c}") for c in same]
    return queries.join(renamed.hint("merge"), reduce(Column.__and__, matches), "left").drop(*[f"_{c}" for c in on])


def _numbers(features: Sequence[str]) -> list[Column]:
    return [F.col(c).cast("double").alias(c) for c in features]


def _without_copies(points: DataFrame, on: Sequence[str], key: str, k: int) -> DataFrame:
    """Of equal points only the k of smallest key can be among the nearest.

    The limit on the rank is applied before the shuffle as well, so that a point
    which makes up much of the table costs k rows per task.
    """
    place = F.row_number().over(Window.partitionBy(*on).orderBy(key))
    return points.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")


# The tree


@dataclass(frozen=True)
class Tree:
    """``points`` with the path of their node; per level a table of parent and ``children``, an array of boxes."""

    features: tuple[str, ...]
    exclude: str | None
    points: DataFrame
    levels: tuple[DataFrame, ...]


def build_tree(points: DataFrame, features: Sequence[str], exclude: str | None = None, node_size: int = NODE_SIZE) -> Tree:
    """Split points level by level until no node has more than ``node_size`` of them, but for nodes of equal points."""
    placed = write_table(points.withColumn("_path", F.lit("")).withColumn("_closed", F.lit(False)), "points")
    done, levels = [], []
    sides = [f(c).alias(f"_{s}_{c}") for c in features for s, f in [("low", F.min), ("high", F.max)]]
    others = [F.min(exclude).alias("_least"), F.max(exclude).alias("_most")] if exclude else []
    while True:
        spreads = F.array(*[F.col(f"_high_{c}") - F.col(f"_low_{c}") for c in features])
        nodes = placed.groupBy("_path").agg(F.count("*").alias("_n"), *sides, *others)
        nodes = nodes.withColumn("_closed", (F.col("_n") <= node_size) | (F.array_max(spreads) == 0))
        nodes = write_table(nodes.withColumn("_axis", F.array_position(spreads, F.array_max(spreads)).cast("int")), "nodes")
        box = F.struct("_path", "_closed", *[f"_{s}_{c}" for c in features for s in ("low", "high")], *(["_least", "_most"] if exclude else []))
        parent = F.expr("substring(_path, 1, length(_path) - 1)")
        levels.append(nodes.groupBy(parent.alias("_parent")).agg(F.collect_list(box).alias("_children")))
        placed = placed.drop("_closed").join(nodes.select("_path", "_closed", "_axis"), "_path")
        done.append(placed.where("_closed").drop("_axis", "_closed"))
        split = nodes.where("NOT _closed")
        if split.isEmpty():
            break
        going = placed.where("NOT _closed")
        value = F.element_at(F.array(*features), F.col("_axis"))
        shares = F.lit([j / (CUTS + 1) for j in range(1, CUTS + 1)])
        cuts = going.groupBy("_path").agg(F.sort_array(F.array_distinct(F.percentile_approx(value, shares, 1000))).alias("_cuts"))
        # Below, at, or between the cuts: each is a value of the node, so at least two children have points.
        slab = F.size(F.filter("_cuts", lambda c: c < value)) + F.size(F.filter("_cuts", lambda c: c <= value))
        # One row per node that is split; its rows must not meet in one task for it.
        onward = going.join(write_table(cuts, "cuts"), "_path").withColumn("_path", F.concat("_path", F.char(slab + 65)))
        placed = write_table(onward.drop("_cuts", "_axis"), "points")
    return Tree(tuple(features), exclude, reduce(DataFrame.unionByName, done), tuple(levels))


@dataclass(frozen=True)
class TopLevel:
    """The boxes of one level in the order of their paths; ``children`` are places in the next level, -1 where there is none."""

    path: np.ndarray
    closed: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least: np.ndarray | None
    most: np.ndarray | None
    children: np.ndarray

    def gaps(self, queries: np.ndarray, boxes: np.ndarray) -> np.ndarray:
        """The squared distance from each query to each of its row of boxes, endless where there is none."""
        total = None
        for c in range(queries.shape[1]):
            value = queries[:, c, None]
            aside = np.maximum(np.maximum(self.low[boxes, c] - value, value - self.high[boxes, c]), 0.0)
            total = aside * aside if total is None else total + aside * aside
        return np.where(boxes < 0, np.inf, total)


def top_levels(tree: Tree) -> list[TopLevel]:
    """The first ``TOP_LEVELS`` levels, whose number of boxes does not grow with the points beyond a limit."""
    tables = [level.select(F.inline("_children")).orderBy("_path").toArrow() for level in tree.levels[:TOP_LEVELS]]
    paths = [t.column("_path").to_pylist() for t in tables]
    found = []
    for depth, (table, path) in enumerate(zip(tables, paths, strict=True)):
        inner = depth + 1 < len(paths)
        children = np.full((len(path), 2 * CUTS + 1 if inner else 0), -1, np.int64)
        if inner:
            place, taken = {p: i for i, p in enumerate(path)}, [0] * len(path)
            # The root is a level of its own; its path and that of its parent are empty.
            for child, below in enumerate(paths[depth + 1]):
                parent = place[below[:-1]]
                children[parent, taken[parent]] = child
                taken[parent] += 1
        low, high = (np.column_stack([table.column(f"_{s}_{c}").to_numpy() for c in tree.features]) for s in ("low", "high"))
        least, most = (table.column(n).to_numpy() if tree.exclude else None for n in ("_least", "_most"))
        closed = np.array(table.column("_closed").to_pylist(), dtype=bool)
        found.append(TopLevel(np.array(path, dtype=object), closed, low, high, least, most, children))
    return found if paths[0] else []


def walk_home(levels: Sequence[TopLevel], queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Path of each query's node and whether it is closed: the nearest box at every level, the first in order of equally near ones."""
    path, closed = np.full(len(queries), "", dtype=object), np.zeros(len(queries), dtype=bool)
    rows, at = np.arange(len(queries)), np.zeros(len(queries), np.int64)
    for depth, level in enumerate(levels):
        path[rows], closed[rows] = level.path[at], level.closed[at]
        if depth + 1 == len(levels):
            break
        going = ~level.closed[at]
        rows, boxes = rows[going], level.children[at[going]]
        nearest = levels[depth + 1].gaps(queries[rows], boxes).argmin(axis=1)
        at = boxes[np.arange(len(rows)), nearest]
    return path, closed


def walk_touched(levels: Sequence[TopLevel], queries: np.ndarray, reach: np.ndarray, not_of: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """(row of the query, path, closed) of all last nodes whose box lies within reach and holds points that may count."""
    out = [(np.zeros(0, np.int64), np.zeros(0, dtype=object), np.zeros(0, dtype=bool))]
    todo = [(0, np.arange(len(queries)), np.zeros((len(queries), 1), np.int64))] if levels else []
    while todo:
        depth, rows, boxes = todo.pop()
        if len(rows) > WALKED_AT_ONCE:
            todo += [(depth, rows[i : i + WALKED_AT_ONCE], boxes[i : i + WALKED_AT_ONCE]) for i in range(0, len(rows), WALKED_AT_ONCE)]
            continue
        level = levels[depth]
        counts = (boxes >= 0) & (level.gaps(queries[rows], boxes) <= reach[rows, None])
        if not_of is not None:
            own = not_of[rows, None]
            counts &= ~((level.least[boxes] == own) & (level.most[boxes] == own))
        row, child = np.nonzero(counts)
        rows, at = rows[row], boxes[row, child]
        last = level.closed[at] if depth + 1 < len(levels) else np.ones(len(at), dtype=bool)
        out.append((rows[last], level.path[at[last]], level.closed[at[last]]))
        if not last.all():
            todo.append((depth + 1, rows[~last], level.children[at[~last]]))
    rows, path, closed = (np.concatenate(x) for x in zip(*out, strict=True))
    return rows, path, closed


def _gap(features: Sequence[str], box: Column) -> Column:
    """The squared distance from a query to a box."""
    total = None
    for c in features:
        aside = F.greatest(box[f"_low_{c}"] - F.col(c), F.col(c) - box[f"_high_{c}"], F.lit(0.0))
        total = aside * aside if total is None else total + aside * aside
    return total


# Inside a node


def split_leaves(points: np.ndarray, leaf_size: int) -> list[np.ndarray]:
    """Rows of each leaf: halves along the widest feature, until they are few enough or all equal."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        part = points[rows]
        spread = part.max(axis=0) - part.min(axis=0) if len(rows) else np.zeros(1)
        if len(rows) <= leaf_size or not spread.max() > 0:
            out.append(rows)
            continue
        values = part[:, int(spread.argmax())]
        middle = np.partition(values, len(values) // 2)[len(values) // 2]
        lower = values < middle if (values < middle).any() else values <= middle
        todo += [rows[lower], rows[~lower]]
    return out


def _squares(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    total = None
    for c in range(queries.shape[1]):
        gap = queries[:, c, None] - points[None, :, c]
        total = gap * gap if total is None else total + gap * gap
    return total


def _best(found: list[tuple], k: int) -> tuple[np.ndarray, ...]:
    """Of candidates (query, distance, key, row) the k best of each query."""
    query, distance, key, row = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((key, distance, query))
    place = np.arange(len(order))
    new = np.ones(len(order), dtype=bool)
    new[1:] = query[order][1:] != query[order][:-1]
    kept = order[place - np.maximum.accumulate(np.where(new, place, 0)) < k]
    return query[kept], distance[kept], key[kept], row[kept]


def search_node(points, key, others, queries, not_of, reach, k: int, leaf_size: int) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """The k best candidates (query, distance, key, row) within reach, and how many points each query was compared with.

    ``others`` and ``not_of`` are the values that points and queries must not share, or None.  Without ``reach``, leaves
    are taken by their distance until k points that count are found; their k-th distance is the reach.
    """
    leaves = split_leaves(points, leaf_size)
    boxes = [(points[rows].min(axis=0), points[rows].max(axis=0)) for rows in leaves]
    low, high = (np.stack([b[side] for b in boxes]) for side in (0, 1))
    gaps = None
    for c in range(points.shape[1]):
        aside = np.maximum(np.maximum(low[None, :, c] - queries[:, None, c], queries[:, None, c] - high[None, :, c]), 0.0)
        gaps = aside * aside if gaps is None else gaps + aside * aside
    if others is not None:
        alone = [others[rows[0]] if (others[rows] == others[rows[0]]).all() else None for rows in leaves]
        for leaf, value in enumerate(alone):
            if value is not None:
                gaps[not_of == value, leaf] = np.inf  # nothing here counts
    compared = np.zeros(len(queries), dtype=np.int64)

    def distances(at: np.ndarray, leaf: int) -> np.ndarray:
        rows = leaves[leaf]
        compared[at] += len(rows)
        squares = _squares(queries[at], points[rows])
        return squares if others is None else np.where(others[rows][None, :] != not_of[at][:, None], squares, np.inf)

    if reach is None:
        reach = np.full(len(queries), np.inf)
        nearest, pending = np.full((len(queries), k), np.inf), np.arange(len(queries))
        order = np.argsort(gaps, axis=1, kind="stable")
        for step in range(len(leaves)):
            if not len(pending):
                break
            leaf_of = order[pending, step]
            for leaf in np.unique(leaf_of):
                at = pending[leaf_of == leaf]
                both = np.concatenate([nearest[at], distances(at, leaf)], axis=1)
                nearest[at] = np.partition(both, k - 1, axis=1)[:, :k]
            reach[pending] = nearest[pending].max(axis=1)
            pending = pending[np.isinf(reach[pending])]
    none = np.zeros(0, np.int64)
    found, held = [(none, np.zeros(0), key[:0], none)], 0
    for leaf, rows in enumerate(leaves):
        at = np.flatnonzero((gaps[:, leaf] <= reach) & (gaps[:, leaf] < np.inf))
        if not len(at):
            continue
        squares = distances(at, leaf)
        query, row = np.nonzero((squares <= reach[at][:, None]) & (squares < np.inf))
        found.append((at[query], squares[query, row], key[rows[row]], rows[row]))
        held += len(query)
        if held > CANDIDATES:
            found = [_best(found, k)]
            held = len(found[0][0])
    return _best(found, k), compared


# The search


@dataclass(frozen=True)
class Search:
    tree: Tree
    label: str
    key: str
    k: int
    leaf_size: int = TILE_SIZE

    def closest(self, asked: DataFrame) -> DataFrame:
        """(_query, distance, key, label): the k nearest points that count of every query."""
        home = write_table(self._home(asked), "homes")
        inside = write_table(self._look(home.withColumn("_reach", F.lit(None).cast("double"))), "home-neighbours")
        full = inside.groupBy("_query").agg(F.count("*").alias("_n"), F.max("distance").alias("_farthest")).where(F.col("_n") >= self.k)
        reached = home.join(full.select("_query", F.col("_farthest").alias("_reach")).hint("merge"), "_query", "left")
        reached = write_table(reached, "reaches")
        lacking = reached.where("_reach IS NULL").drop("_reach")
        if not lacking.isEmpty():
            reached = reached.where("_reach IS NOT NULL").unionByName(self._reach_by_ancestors(lacking))
        # Counted by node, then grouped: the walk is done once.
        more = self._look(write_table(self.visits(reached), "visits"))
        place = F.row_number().over(Window.partitionBy("_query").orderBy("distance", self.key))
        return inside.unionByName(more).withColumn("_place", place).where(F.col("_place") <= self.k).drop("_place")

    @cached_property
    def top(self) -> list[TopLevel]:
        return top_levels(self.tree)

    def _walk(self, asked: DataFrame, walk: Callable[[np.ndarray, pa.RecordBatch], tuple], onward: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Walk down the levels: the top ones by ``walk`` of the coordinates in the tasks, then level by level.

        ``onward`` gives each open row the ``_next`` boxes to go on to, of ``_children``.
        """
        features = list(self.tree.features)

        def walked(batches):
            for batch in batches:
                queries = np.column_stack([batch.column(c).to_numpy() for c in features])
                rows, path, closed = walk(queries, batch)
                taken = batch.take(pa.array(rows))
                columns = [*taken.columns, pa.array(path, pa.string()), pa.array(closed, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, [*taken.schema.names, "_path", "_closed"])

        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in asked.schema)
        at = asked.mapInArrow(walked, f"{kinds}, _path string, _closed boolean")
        for level in self.tree.levels[TOP_LEVELS:]:
            at = at.join(level, F.when(~F.col("_closed"), F.col("_path")) == F.col("_parent"), "left").drop("_parent")
            at = onward(at).drop("_children")
            at = at.withColumns({c: F.coalesce(F.col("_next")[c], F.col(c)) for c in ("_path", "_closed")}).drop("_next")
        return at.drop("_closed")

    def _home(self, asked: DataFrame) -> DataFrame:
        """Each query with one node, of the nearest box at every level."""
        top = self.top

        def walk(queries: np.ndarray, batch: pa.RecordBatch) -> tuple:
            return np.arange(len(queries)), *walk_home(top, queries)

        def nearest(at: DataFrame) -> DataFrame:
            gaps = F.transform("_children", lambda c: F.struct(_gap(self.tree.features, c).alias("gap"), c["_path"].alias("_path"), c["_closed"].alias("_closed")))
            return at.withColumn("_next", F.array_min(gaps))

        return self._walk(asked, walk, nearest)

    def visits(self, reached: DataFrame) -> DataFrame:
        """Queries with each node but their home whose box lies within ``_reach`` and holds points that count."""
        top, exclude = self.top, self.tree.exclude

        def walk(queries: np.ndarray, batch: pa.RecordBatch) -> tuple:
            reach = batch.column("_reach").to_numpy()
            not_of = batch.column(exclude).to_numpy(zero_copy_only=False) if exclude is not None else None
            return walk_touched(top, queries, reach, not_of)

        def touched(at: DataFrame) -> DataFrame:
            box = F.col("_next")
            counts = _gap(self.tree.features, box) <= F.col("_reach")
            if exclude is not None:
                own = F.col(exclude)
                counts = counts & ~((box["_least"] == own) & (box["_most"] == own))
            return at.withColumn("_next", F.explode_outer("_children")).where(F.col("_closed") | counts)

        walked = self._walk(reached.withColumnRenamed("_path", "_home"), walk, touched)
        return walked.where("_path <> _home").drop("_home")

    def _look(self, visits: DataFrame) -> DataFrame:
        """The k best points within reach that each visit finds in its node.

        A node meets its queries in groups of about ``ASKED_AT_ONCE``, with a copy of its points for each.
        """
        tree, key, label, k, leaf_size = self.tree, self.key, self.label, self.k, self.leaf_size
        features, exclude = list(tree.features), tree.exclude
        same = [exclude] if exclude else []
        groups = visits.groupBy("_path").agg(F.ceil(F.count("*") / ASKED_AT_ONCE).cast("int").alias("_groups"))
        # One row per node; written, so that Spark knows it for the smaller table beside visits and points.
        groups = write_table(groups, "groups")
        asked = visits.join(groups, "_path").withColumn("_group", F.pmod(F.xxhash64("_query"), F.col("_groups")).cast("int"))
        points = tree.points.join(groups, "_path").withColumn("_group", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)))

        def search(left: pa.Table, right: pa.Table) -> pa.Table:
            queries, points = (
                np.column_stack([t.column(c).to_numpy() for c in features]) if t.num_rows else np.zeros((0, len(features))) for t in (left, right)
            )
            keys, queried = right.column(key), left.column("_query").to_numpy()
            query, distance, row = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
            if len(queries) and len(points):
                reach = None if left.column("_reach").null_count else left.column("_reach").to_numpy()
                others, not_of = (t.column(exclude).to_numpy() if exclude else None for t in (right, left))
                (query, distance, _, row), _ = search_node(points, keys.to_numpy(), others, queries, not_of, reach, k, leaf_size)
            taken = pa.array(row)
            return pa.table({"_query": queried[query], "distance": distance, key: keys.take(taken), label: right.column(label).take(taken)})

        kinds = {c: tree.points.schema[c].dataType.simpleString() for c in (key, label)}
        schema = f"_query long, distance double, `{key}` {kinds[key]}, `{label}` {kinds[label]}"
        left = asked.select("_path", "_group", "_query", "_reach", *same, *features).groupBy("_path", "_group")
        right = points.select("_path", "_group", key, label, *same, *features).groupBy("_path", "_group")
        return left.cogroup(right).applyInArrow(search, schema)

    def _reach_by_ancestors(self, lacking: DataFrame) -> DataFrame:
        """A reach for queries whose home holds too few points that count, from a few points of each node above it.

        A node is represented by up to 2 k points, up to k of one excluded value, so that k are left whichever is
        excluded.  Without as many points anywhere the reach is infinite; then at most k - 1 nodes hold any that count.
        """
        features, exclude, k = self.tree.features, self.tree.exclude, self.k
        same = [exclude] if exclude else []

        def few(df: DataFrame) -> DataFrame:
            for by, most in ((["_path", *same], k if same else 2 * k), (["_path"], 2 * k)):
                place = F.row_number().over(Window.partitionBy(*by).orderBy(self.key))
                df = df.withColumn("_place", place).where(F.col("_place") <= most).drop("_place")
            return df

        upward = F.transform(F.sequence(F.lit(0), F.length("_path")), lambda n: F.substring(F.col("_path"), F.lit(1), n))
        points = few(self.tree.points.select("_path", self.key, *same, *features))
        points = few(points.withColumn("_path", F.explode(upward)))
        nodes = points.groupBy("_path").agg(F.collect_list(F.struct(*same, *features)).alias("_few"))
        counting = F.filter("_few", lambda p: p[exclude] != F.col(exclude)) if exclude else F.col("_few")

        def square(p: Column) -> Column:
            return reduce(Column.__add__, [(F.col(c) - p[c]) * (F.col(c) - p[c]) for c in features])

        reach = F.get(F.sort_array(F.transform(counting, square)), F.lit(k - 1))
        asked = lacking.withColumnRenamed("_path", "_home").withColumn("_path", F.explode(F.expr("transform(sequence(0, length(_home)), n -> substring(_home, 1, n))")))
        found = asked.join(nodes, "_path").groupBy("_query").agg(F.min(reach).alias("_reach"))
        return lacking.join(found.hint("merge"), "_query").withColumn("_reach", F.coalesce("_reach", F.lit(float("inf"))))
