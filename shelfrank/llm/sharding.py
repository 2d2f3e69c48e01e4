"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Keys go to the next virtual node clockwise; a full shard sends them on.  Column expressions
and small tables only: which keys of an arc overflow, and where to, follows from the arc's counts.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.session import small_table, write_table

SHARDS = 40
VIRTUAL_NODES = 64
ROWS_PER_RANGE = 5_000
#: The ring has 2^32 places, looked up through this many equal cells.
CELLS = 4096
_PLACES = 1 << 32


def _place(*key: Column) -> Column:
    """A place on the ring, 0 to 2^32 - 1."""
    return F.conv(F.substring(F.md5(F.concat_ws("-", *key)), 1, 8), 16, 10).cast("long")


def ring_places(spark, shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """The virtual nodes as (place, shard), clockwise: ``shards * virtual_nodes`` rows."""
    nodes = spark.range(shards).withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(virtual_nodes - 1))))
    rows = nodes.select(_place(F.lit("node"), F.col("id").cast("string"), F.col("v").cast("string")).alias("p"), "id")
    return sorted((r["p"], r["id"]) for r in rows.collect())


def _arc_of(rows: DataFrame, ring: list[tuple[int, int]]) -> DataFrame:
    """Add ``arc``: the number of the first virtual node at or after ``place``, clockwise."""
    width = _PLACES // CELLS
    cells, at = [], 0
    for c in range(CELLS):
        while at < len(ring) and ring[at][0] < c * width:
            at += 1
        stop = at
        while stop < len(ring) and ring[stop][0] < (c + 1) * width:
            stop += 1
        cells.append((c, at, [ring[i][0] for i in range(at, stop)]))
    lookup = small_table(rows.sparkSession, cells, "cell long, first long, places array<long>")
    cell = F.floor(F.col("place") / width)
    rows = rows.withColumn("cell", cell).join(F.broadcast(lookup), "cell")  # CELLS rows, a fixed number
    passed = F.size(F.filter("places", lambda p: p < F.col("place")))
    return rows.withColumn("arc", (F.col("first") + passed) % len(ring)).drop("cell", "first", "places")


def deal_arcs(ring: list[tuple[int, int]], counts: dict[int, int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, from, to, shard, slot of the first): the keys of each arc by their rank in the arc.

    First every shard admits the keys of its own arcs, clockwise, until it is full.  Then the
    overflow moves on: the walk goes round the ring, each virtual node adds what its arc
    could not place and takes from the oldest that are under way while its shard has room.
    ``room`` sums up to all keys, so everything is placed after two rounds at most.
    """
    free, pieces, over = list(room), [], {}
    for arc, (_, shard) in enumerate(ring):
        n = counts.get(arc, 0)
        own = min(n, free[shard])
        free[shard] -= own
        if own:
            pieces.append((arc, 0, own, shard))
        if own < n:
            over[arc] = (own, n)
    moving: deque[list[int]] = deque()
    for step in range(2 * len(ring)):
        arc = step % len(ring)
        shard = ring[arc][1]
        if step < len(ring) and arc in over:
            moving.append([arc, *over[arc]])
        while moving and free[shard]:
            first = moving[0]
            take = min(free[shard], first[2] - first[1])
            pieces.append((first[0], first[1], first[1] + take, shard))
            free[shard] -= take
            first[1] += take
            if first[1] == first[2]:
                moving.popleft()
    filled, out = [0] * len(room), []
    for arc, low, high, shard in pieces:
        out.append((arc, low, high, shard, filled[shard]))
        filled[shard] += high - low
    return out


def shard_rows(keyed: DataFrame, shards: int = SHARDS, virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """Add shard and slot to rows (doc_id, size, text_crc32); counts of the shards are at most one apart.

    The bound of a shard is its even share: the first ``n % shards`` shards hold one row more
    than the others, so every shard is exactly full.  A key is its doc_id; keys of an arc overflow
    in the order of a hash of the row.  Slots run from 0 without gaps in each shard.

    Null doc_ids share one place on the ring; their rows overflow clockwise like others.
    Repeated rows are counted once with their number before they are shuffled and dealt out
    again at the end.  More shards than rows leave shards empty; an empty table gives no rows.
    """
    spark = keyed.sparkSession
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "size", "text_crc32")]
    rows = keyed.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumns({"place": _place(F.lit("key"), text[0]), "draw": F.xxhash64(*text)})
    ring = ring_places(spark, shards, virtual_nodes)
    rows = write_table(_arc_of(rows, ring), "shard-keys")

    # One count per virtual node: shards * virtual_nodes rows, whatever the size of the table.
    counts = {r["arc"]: r["n"] for r in rows.groupBy("arc").agg(F.sum("copies").alias("n")).collect()}
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    pieces = small_table(
        spark,
        deal_arcs(ring, counts, room),
        "arc long, low long, high long, shard int, first_slot long",
    )

    # Ranks in an arc: ranges of the draw of bounded size, rank = rows of earlier ranges + rank inside.
    shares = small_table(spark, [(a, -(-n // ROWS_PER_RANGE)) for a, n in counts.items()], "arc long, ranges long")
    share = F.shiftrightunsigned("draw", 33) * F.col("ranges") / (1 << 31)
    rows = rows.join(F.broadcast(shares), "arc").withColumn("range", F.floor(share).cast("long")).drop("ranges")
    sums = rows.groupBy("arc", "range").agg(F.sum("copies").alias("n"))
    earlier = Window.partitionBy("arc").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("arc", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("arc", "range").orderBy("draw", "doc_id", "size", "text_crc32")
    upto = F.sum("copies").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    ranked = rows.withColumn("before", upto - F.col("copies")).join(sums, ["arc", "range"])
    ranked = ranked.withColumn("low_rank", F.col("base") + F.col("before"))
    ranked = ranked.withColumn("high_rank", F.col("low_rank") + F.col("copies"))

    # An arc has few pieces (one, and one for each shard its overflow reached), so this join adds few rows.
    met = ranked.join(F.broadcast(pieces), "arc")
    met = met.where((F.col("low_rank") < F.col("high")) & (F.col("low") < F.col("high_rank")))
    start, stop = F.greatest("low_rank", "low"), F.least("high_rank", "high")
    dealt = met.withColumn("rank", F.explode(F.sequence(start, stop - 1)))
    slot = F.col("first_slot") + F.col("rank") - F.col("low")
    return dealt.select("doc_id", "size", "text_crc32", "shard", slot.alias("slot"), F.element_at(
        F.array(*[F.lit(s) for _, s in ring]), (F.col("arc") + 1).cast("int")
    ).cast("int").alias("home_shard"))


def document_keys(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text, none if null, plus 16) and text_crc32 (null text: of no bytes)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
