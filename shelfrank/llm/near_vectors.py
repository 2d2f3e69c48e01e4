"""Near-duplicate embeddings: p-stable hashing of unit vectors in several tables, then exact cosines."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.llm.components import connected_components
from shelfrank.llm.text import mix64
from shelfrank.session import write_table

#: Width of a hash interval, in units of the distance between unit vectors.
WIDTH = 2.0
#: Wanted chance that a pair just at the threshold shares a bucket in some table.
RECALL = 0.97
#: Unrelated vectors that a bucket should hold at most, on average.
CHANCE_MATES = 8
BLOCK_ROWS = 1024
SHARD_ROWS = 8192
#: Rows of small buckets that are compared by one product of matrices, rows of a large one, and pairs settled at once.
RUN_ROWS = 128
STRIP_ROWS = 256
PAIRS_AT_ONCE = 1 << 18
#: Cosines this close to the threshold are worked out again for the pair.
DOUBT = 1e-9


def collision_chance(distance: float, width: float = WIDTH) -> float:
    """Chance that two points at a distance share an interval of a random projection with normal coefficients."""
    r = width / distance
    return math.erf(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


@dataclass(frozen=True)
class Tables:
    """Random projections: ``tables`` hashes of ``bits`` quantised projections each."""

    dimension: int
    tables: int
    bits: int
    seed: int = 5

    @staticmethod
    def for_rows(dimension: int, rows: int, cosine: float) -> "Tables":
        """As many projections as keep chance mates few at this size, and as many tables as the recall needs."""
        near, far = collision_chance(math.sqrt(2 - 2 * cosine)), collision_chance(math.sqrt(2))
        bits = max(1, math.ceil(math.log(max(rows / CHANCE_MATES, 2)) / -math.log(far)))
        return Tables(dimension, math.ceil(math.log(1 - RECALL) / math.log(1 - near**bits)), bits)

    @cached_property
    def projections(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.seed)
        return rng.standard_normal((self.dimension, self.tables * self.bits)), rng.uniform(0, WIDTH, self.tables * self.bits)

    def buckets(self, unit: np.ndarray) -> np.ndarray:
        """The 64-bit bucket of each row in each table."""
        directions, shifts = self.projections
        cells = np.floor((unit @ directions + shifts) / WIDTH).astype(np.int64).reshape(len(unit), self.tables, self.bits)
        out = np.zeros((len(unit), self.tables), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k in range(self.bits):
                out = mix64(out * np.uint64(31) + cells[:, :, k].view(np.uint64) + np.uint64(k + 1))
        return out


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.ListArray) else pa.concat_arrays([c.flatten() for c in column.chunks])
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def _packed(points: DataFrame, dimension: int, kind: str) -> DataFrame:
    """(point, copies, vector) with the components as bytes of numbers of this kind, which must hold them exactly."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = pa.array([v.tobytes() for v in _matrix(batch.column(2), dimension).astype(kind)], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], vectors], names=["point", "copies", "vector"])

    return points.select("point", "copies", "embedding").mapInArrow(pack, "point long, copies long, vector binary")


def _unpack(column: pa.ChunkedArray, dimension: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).astype(np.float64).reshape(-1, dimension)


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that neither very small nor very large components leave the range of squares.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _runs(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of whole parts, given by the ends of the parts: up to ``RUN_ROWS`` rows, or one larger part."""
    low = 0
    while low < ends[-1]:
        at = max(np.searchsorted(ends, low + RUN_ROWS, side="right") - 1, np.searchsorted(ends, low, side="right"))
        yield low, int(ends[at])
        low = int(ends[at])


def _near_pairs(unit: np.ndarray, part: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of the same part, the first before the second, with at least this cosine."""
    for low in range(0, len(unit), STRIP_ROWS):
        cosines = unit[low : low + STRIP_ROWS] @ unit[low:].T
        a, b = np.nonzero(cosines >= cosine - DOUBT)
        use = (a < b) & (part[low + a] == part[low + b])
        a, b = a[use], b[use]
        # Close to the threshold a product of matrices may round by its shape; a pair is judged by itself there.
        doubt = np.flatnonzero(cosines[a, b] < cosine + DOUBT)
        below = np.einsum("ij,ij->i", unit[low + a[doubt]], unit[low + b[doubt]]) < cosine
        yield np.delete(low + a, doubt[below]), np.delete(low + b, doubt[below])


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Connects the rows of each pair: ``root`` keeps the first row that each row is connected with."""
    while len(a):
        a, b = root[a], root[b]
        a, b = np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]
        np.minimum.at(root, b, a)
        while (root[root] != root).any():
            root[:] = root[root]


def _compare(rows: pa.Table, tables: Tables, cosine: float, kind: str) -> pa.Table:
    """(point, links, joined) of the rows that link in some pair of blocks of their bucket.

    ``rows`` holds whole pairs of blocks, sorted here so that each is a part of consecutive rows.  Most
    buckets hold a few rows, so many parts are compared at once; a larger one is compared in strips.
    """
    names = ["table", "bucket", "first", "second"]
    keys = [rows.column(c).to_numpy() for c in names]
    order = np.lexsort([rows.column("point").to_numpy(), *keys[::-1]])
    table, _, first, second = keys = [k[order] for k in keys]
    point, block, copies = (rows.column(c).to_numpy()[order] for c in ("point", "block", "copies"))
    unit = _unit(_unpack(rows.column("vector"), tables.dimension, kind))[order]
    new = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    ends = np.append(np.flatnonzero(new) + 1, len(point))
    part = np.append(0, np.cumsum(new))
    links, root = np.zeros(len(point), dtype=np.int64), np.arange(len(point))
    waiting = []

    def settle() -> None:
        a, b = (np.concatenate(side) for side in zip(*waiting, strict=True))
        waiting.clear()
        _join(root, a, b)
        hashed, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        buckets = tables.buckets(unit[hashed])
        at_a, at_b = at[: len(a)], at[len(a) :]
        # A pair counts in the first table in which it meets.
        for earlier in range(table[a].max(initial=0)):
            met = (buckets[at_a, earlier] == buckets[at_b, earlier]) & (table[a] > earlier)
            a, b, at_a, at_b = a[~met], b[~met], at_a[~met], at_b[~met]
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])

    for low, high in _runs(ends):
        for a, b in _near_pairs(unit[low:high], part[low:high], cosine):
            a, b = low + a, low + b
            across = (first[a] == second[a]) | (block[a] != block[b])
            waiting.append((a[across], b[across]))
            if sum(len(x) for x, _ in waiting) >= PAIRS_AT_ONCE:
                settle()
    if waiting:
        settle()
    use = (root != np.arange(len(root))) | (links > 0)
    return pa.table({"point": point[use], "links": links[use], "joined": point[root[use]]})


def near_vectors(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding).

    Rows link if their cosine in double precision is at least ``cosine`` and they share a bucket in some
    table; equal vectors always do.  ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest vec_id reachable, ``kept`` marks the row that has it.

    Equal vectors are one point with a count, so copies are never expanded.  The pairs of a bucket
    are compared in blocks of ``BLOCK_ROWS``, dealt over tasks, and small buckets many at a time; a block
    passes on a number per point and a spanning tree, never its pairs.  No bucket is capped.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do
    vectors of different lengths with each other.  Null vec_ids count as links, but only make a
    component's id if it has no other.  An empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    # Vectors go to their buckets in the width they were given in.
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType == T.FloatType() else "<f8"
    v = F.col("embedding").cast("array<double>")
    usable = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select("vec_id", v.alias("embedding"), F.coalesce(usable, F.lit(False)).alias("usable"))
    points = rows.where("usable").groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    # Points are named by a 64-bit hash of their components.
    points = write_table(points.withColumn("point", F.xxhash64("embedding")), "vector-points")
    lengths = points.groupBy(F.size("embedding").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    sums, edges = [], []
    for length in lengths.orderBy("n").collect():  # one row per vector length
        tables = Tables.for_rows(length["n"], length["rows"], cosine)
        found = _links(points.where(F.size("embedding") == length["n"]), tables, cosine, kind)
        sums.append(found.groupBy("point").agg(F.sum("links").alias("links")))
        edges.append(found.where("point <> joined").select(F.col("point").alias("a"), F.col("joined").alias("b")))
    if not sums:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    links, joined = sums[0], edges[0]
    for more, others in zip(sums[1:], edges[1:], strict=True):
        links, joined = links.union(more), joined.union(others)
    names = connected_components(joined)
    named = points.join(names, points["point"] == names["node"], "left")
    named = named.withColumn("component", F.coalesce("component", "point")).select("point", "component", "least", "copies")
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    facts = named.join(smallest, "component").join(links, "point", "left")
    facts = facts.select(
        F.col("point").alias("of_point"), "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    keyed = rows.select("vec_id", F.when(F.col("usable"), F.xxhash64("embedding")).alias("point"))
    out = keyed.join(facts, F.col("point") == F.col("of_point"), "left")
    out = out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").cast("long").alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(points: DataFrame, tables: Tables, cosine: float, kind: str) -> DataFrame:
    """(point, links, joined) of every block in which a point links: its new links, and a point it is connected with."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                buckets = tables.buckets(_unit(_matrix(part.column(1), tables.dimension)))
                points = np.repeat(part.column(0).to_numpy(), tables.tables)
                table = np.tile(np.arange(tables.tables, dtype=np.int32), part.num_rows)
                columns = [pa.array(points), pa.array(table), pa.array(buckets.reshape(-1).view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["point", "table", "bucket"])

    places = points.select("point", "embedding").mapInArrow(hashed, "point long, table int, bucket long")
    places = write_table(places, "vector-buckets")
    full = places.groupBy("table", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = places.join(full, ["table", "bucket"])
    blocks = F.ceil(F.col("n") / BLOCK_ROWS).cast("long")
    met = met.withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64("point", F.lit(1)), blocks)})
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    met = met.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})
    met = write_table(met.select("point", "table", "bucket", "block", "first", "second"), "vector-blocks")
    # Shards hold whole pairs of blocks, several thousand rows in all.
    shards = max(1, -(-met.count() // SHARD_ROWS))
    shard = F.pmod(F.xxhash64("table", "bucket", "first", "second"), F.lit(shards))
    met = met.join(_packed(points, tables.dimension, kind), "point").withColumn("shard", shard)

    def compare(group: pa.Table) -> pa.Table:
        return _compare(group, tables, cosine, kind)

    return write_table(met.groupBy("shard").applyInArrow(compare, "point long, links long, joined long"), "vector-links")
