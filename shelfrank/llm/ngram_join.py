"""N-gram Jaccard join: globally ordered n-gram sets in prefix trees, traversed with overlap bounds.

1. Each text becomes a sorted set of 64-bit n-gram hashes; the order of the hashes is the global order.
2. The order's range is cut into more segments than two linked sets can differ in n-grams, so linked
   sets agree on a segment.  Sets that share one, directly or through others, form a candidate cluster.
3. The sets of a cluster are stored in a prefix tree.  Each is looked up in it: shared prefixes are
   overlapped once, and a subtree is left when its remaining lengths cannot reach the overlap needed.

Only sets with a shared segment are shipped, once each; large clusters are cut into blocks that meet in rounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.components import connected_components
from shelfrank.llm.text import LOWER, SpanHasher, mix64, slices, word_spans
from shelfrank.session import write_table

WORDS = 3
#: Linked from 90 of 100: link if 100 * intersection >= 90 * union.
AT_LEAST, OF = 90, 100
BAND_GROWTH = 1.5
#: Segments kept beyond the differences possible; see ``segment_keys``.
SPARE = 2
BLOCK_NGRAMS = 3 << 20
BROADCAST_ROWS = 1_000_000
#: N-grams of a node looked up at once, memory of a batch's lookup table, places where remaining lengths are known.
CHUNK = 32
LOOKUP_BYTES = 1 << 25
MARKS = 64
_U = np.uint64


# Sets


def ngram_sets(data: np.ndarray, offsets: np.ndarray, hasher: SpanHasher, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; of a shorter text the whole sequence; none without words."""
    docs = len(offsets) - 1
    empty = np.zeros(0, np.uint64)
    if not len(data):
        return [empty] * docs
    start, end, doc = word_spans(data, offsets)
    word = hasher(LOWER[data], start, end) if len(start) else empty
    count = np.bincount(doc, minlength=docs)
    ends = np.cumsum(count)
    with np.errstate(over="ignore"):
        grams = word[: max(0, len(word) - words + 1)].copy()
        for k in range(1, words):
            grams = mix64(grams * _U(31)) + word[k : len(word) - words + 1 + k]
        grams = mix64(grams)
    out = []
    for last, n in zip(ends.tolist(), count.tolist(), strict=True):
        if n >= words:
            out.append(np.unique(grams[last - n : last - words + 1]))
        elif n:
            short = _U(n)
            with np.errstate(over="ignore"):
                for value in word[last - n : last]:
                    short = mix64(np.array([short * _U(31) + value]))[0]
            out.append(np.array([short], dtype=np.uint64))
        else:
            out.append(empty)
    return out


def set_key(grams: np.ndarray) -> int:
    """A 64-bit name of a set; equal sets have equal names."""
    with np.errstate(over="ignore"):
        total = mix64(np.array([mix64(grams ^ _U(0x5BF03635)).sum() + _U(len(grams))]))
    return int(total.view(np.int64)[0])


@cache
def bands(most: int) -> list[int]:
    """Sizes at which bands begin, up to beyond ``most``."""
    edges = [1]
    while edges[-1] <= most:
        edges.append(max(edges[-1] + 1, int(edges[-1] * BAND_GROWTH)))
    return edges


def segment_keys(grams: np.ndarray) -> np.ndarray:
    """64-bit keys of a set's segments; two sets that link but differ share one.

    Sizes fall into bands.  Linked sets of sizes a and b differ in at most (a + b)(1 - t)/(1 + t)
    n-grams, so with ``SPARE`` segments more than that for the band's largest size, at least ``SPARE``
    segments agree.  A set near the end of its band also counts for the next band, where larger partners lie.
    Empty segments say little, so they are left out while fewer than ``SPARE`` are empty: then an
    agreeing one is not.  Bands whose sets cannot differ have no keys.
    """
    size = len(grams)
    if not size:
        return np.zeros(0, np.int64)
    edges = bands(1 << max(4, int(size).bit_length() + 1))
    band = int(np.searchsorted(edges, size, side="right")) - 1
    with np.errstate(over="ignore"):
        sums = np.concatenate([[_U(0)], np.cumsum(mix64(grams ^ _U(0x2545F491)), dtype=np.uint64)])
    out = []
    for b in (band, band + 1):
        if b > band and size * OF < AT_LEAST * edges[b]:
            break
        differences = 2 * (edges[b + 1] - 1) * (OF - AT_LEAST) // (OF + AT_LEAST)
        if not differences:
            continue
        segments = differences + SPARE
        segment = ((grams >> _U(32)) * _U(segments)) >> _U(32)
        bound = np.searchsorted(segment, np.arange(segments + 1, dtype=np.uint64))
        with np.errstate(over="ignore"):
            label = mix64(np.arange(segments, dtype=np.uint64) + (_U(b + 1) << _U(40)))
            keys = mix64((sums[bound[1:]] - sums[bound[:-1]]) ^ label)
        full = bound[1:] > bound[:-1]
        out.append(keys if (~full).sum() >= SPARE else keys[full])
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its set's size and name, and once per task and set the segment keys."""
    hasher, seen = SpanHasher(), set()
    for batch in batches:
        for low, high, data, offsets in slices(batch.column(2)):
            sets = ngram_sets(data, offsets, hasher)
            keys, lists = [], []
            for grams in sets:
                key = set_key(grams) if len(grams) else None
                keys.append(key)
                lists.append(None if key is None or key in seen else segment_keys(grams))
                seen.add(key)
            columns = [
                batch.column(0).slice(low, high - low),
                batch.column(1).slice(low, high - low),
                pa.array([len(g) for g in sets], pa.int64()),
                pa.array(keys, pa.int64()),
                pa.array(lists, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "n_shingles", "set_key", "segments"])


def _materialise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher, seen = SpanHasher(), set()
    for batch in batches:
        for _, _, data, offsets in slices(batch.column(0)):
            found = {}
            for grams in ngram_sets(data, offsets, hasher):
                key = set_key(grams) if len(grams) else None
                if key is not None and key not in seen:
                    seen.add(key)
                    found[key] = grams.tobytes()
            columns = [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["set_key", "grams"])


# Prefix trees


class PrefixTree:
    """A path-compressed trie of sorted sets: a node is a run of the sets in order that share a prefix."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sets = sets
        n = len(sets)
        self.sizes = np.array([len(s) for s in sets])
        shared = np.zeros(n, dtype=np.int64)
        for i in range(1, n):
            m = min(len(sets[i - 1]), len(sets[i]))
            differs = sets[i - 1][:m] != sets[i][:m]
            at = int(differs.argmax()) if m else 0
            shared[i] = at if m and differs[at] else m
        self.nodes: list[tuple[int, int, int, int, int, int]] = []
        self.children: list[list[int]] = []
        todo = [(0, n, 0, -1)]
        while todo:
            low, high, depth, parent = todo.pop()
            number = len(self.nodes)
            end = len(sets[low]) if high - low == 1 else int(shared[low + 1 : high].min())
            sizes = self.sizes[low:high]
            self.nodes.append((low, high, depth, end, int(sizes.min()), int(sizes.max())))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(number)
            if high - low > 1:
                cuts = [low, *(np.flatnonzero(shared[low + 1 : high] == end) + low + 1).tolist(), high]
                todo += [(a, b, end, number) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def links(self, labels: np.ndarray, sides: np.ndarray | None = None) -> list[tuple[int, int]]:
        """Links that join sets of different labels; ``labels`` is updated as they are found.

        The tree is walked once for a batch of queries: a node's n-grams are looked up for all
        queries that are still under way, and what they have overlapped so far is shared by the
        node's children.  A query leaves a subtree when its remaining length or that of the sets
        below cannot reach the overlap needed, or when all sets below carry its label already.
        With ``sides`` only sets of different sides are compared.
        """
        words, times = np.unique(np.concatenate(self.sets), return_counts=True)
        words = words[times > 1]  # no other set holds the rest
        if not len(words):
            return []
        places = [np.searchsorted(words, s) for s in self.sets]
        shared = [words[np.minimum(p, len(words) - 1)] == s for p, s in zip(places, self.sets, strict=True)]
        width = max(1, LOOKUP_BYTES // len(words))
        found: list[tuple[int, int]] = []
        for first in range(0, len(places), width):
            self._walk(places, shared, len(words), first, min(len(places), first + width), labels, sides, found)
        return found

    def _walk(self, places, shared, words, first, last, labels, sides, found) -> None:
        queries = np.arange(first, last)
        size = self.sizes[first:last]
        holds = np.zeros((words, last - first), dtype=np.uint8)
        for column, q in enumerate(queries):
            holds[places[q][shared[q]], column] = 1
        # How many shared n-grams of each query are still to come at some places of the order.
        marks = np.unique(np.linspace(0, words, MARKS + 1).astype(np.int64)[:-1])
        ends = [*marks[1:].tolist(), words]
        sums = np.stack([holds[m:e].sum(axis=0, dtype=np.int64) for m, e in zip(marks.tolist(), ends, strict=True)])
        left = np.cumsum(sums[::-1], axis=0)[::-1]
        todo = [(0, np.arange(last - first), np.zeros(last - first, dtype=np.int64))]
        while todo:
            number, at, overlap = todo.pop()
            low, high, depth, end, least, most = self.nodes[number]
            below = labels[low:high]
            use = (queries[at] < high - 1) & (most * OF >= AT_LEAST * size[at]) & (least * AT_LEAST <= OF * size[at])
            if (below == below[0]).all():
                use &= labels[queries[at]] != below[0]
            if sides is not None and (sides[low:high] == sides[low]).all():
                use &= sides[queries[at]] != sides[low]
            at, overlap = at[use], overlap[use]
            smallest = np.maximum(least, -(-AT_LEAST * size[at] // OF))
            need = -(-AT_LEAST * (size[at] + smallest) // (AT_LEAST + OF))
            edge, known = places[low], shared[low]
            chunk = int(min(max(CHUNK, (end - depth) // 16), 8 * CHUNK))
            while depth < end and len(at):
                stop = min(end, depth + chunk)
                piece = edge[depth:stop][known[depth:stop]]
                depth = stop
                if 2 * len(at) < len(queries):
                    overlap = overlap + holds[np.ix_(piece, at)].sum(axis=0, dtype=np.int64)
                else:
                    overlap = overlap + holds[piece].sum(axis=0, dtype=np.int64)[at]
                mark = int(np.searchsorted(marks, edge[stop - 1], side="right")) - 1
                use = overlap + np.minimum(left[mark][at], most - depth) >= need
                # Of the mark's own stretch some may be overlapped already, so the bound is never too low.
                if not use.all():
                    at, overlap, need = at[use], overlap[use], need[use]
            if not len(at):
                continue
            if high - low > 1:
                todo += [(child, at, overlap) for child in self.children[number]]
                continue
            linked = queries[at[OF * overlap >= AT_LEAST * (size[at] + len(edge) - overlap)]]
            _, one_each = np.unique(labels[linked], return_index=True)
            found += [(int(q), low) for q in linked[one_each]]
            labels[np.isin(labels, labels[linked])] = labels[low]


def _join(group: pd.DataFrame) -> pd.DataFrame:
    """Links of the clusters (or pairs of blocks) in a shard, one prefix tree each, as a spanning forest."""
    out = []
    for _, part in group.groupby(["cluster", "pair"], sort=True):
        part = part.drop_duplicates("set_key")
        if len(part) < 2:
            continue
        sets = [np.frombuffer(raw, dtype=np.uint64) for raw in part["grams"]]
        order = sorted(range(len(sets)), key=[s.astype(">u8").tobytes() for s in sets].__getitem__)
        names = part["set_key"].to_numpy()[order]
        labels = pd.factorize(part["label"].to_numpy()[order])[0]
        sides = part["block"].to_numpy()[order]
        tree = PrefixTree([sets[i] for i in order])
        out += [(names[i], names[j]) for i, j in tree.links(labels, sides if len(set(sides)) > 1 else None)]
    return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)


# The join


def jaccard_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id: the smallest doc_id reachable by links of Jaccard >= 0.9.

    Words are runs without ASCII white space, A-Z in lower case, of the whole text; a set holds its distinct
    word triples, or the whole sequence of a shorter text.  N-grams and sets are named by 64-bit
    hashes; links are exact counts of common n-grams.

    Null, empty and blank texts have an empty set and link with nothing.  Equal sets are one set from the start, so
    copies are never paired.  Null doc_ids take their component's id, null if it has no other; repeated rows
    are repeated.  An empty table gives no rows; columns other than doc_id and text are ignored.
    """
    return _grouped(docs).select("doc_id", "n_shingles", "component_id")


def _grouped(docs: DataFrame) -> DataFrame:
    """The rows of ``jaccard_groups`` with the hash of their text, ``text_key``."""
    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string"))
    schema = "doc_id long, text_key long, n_shingles long, set_key long, segments array<long>"
    described = write_table(texts.mapInArrow(_describe, schema), "ngram-sets")
    sets = described.where("set_key IS NOT NULL").groupBy("set_key")
    sets = sets.agg(F.min("doc_id").alias("least"), F.max("n_shingles").alias("n"), F.min("text_key").alias("text_key"))

    keys = described.select("set_key", F.explode("segments").alias("segment"))
    first = keys.groupBy("segment").agg(F.min("set_key").alias("a"), F.max("set_key").alias("z")).where("a < z")
    # One row per shared segment on the right, so a segment shared by very many sets can be split.
    mates = keys.join(first.select("segment", "a"), "segment").where("a <> set_key")
    clusters = connected_components(mates.select("a", F.col("set_key").alias("b")))
    members = clusters.select(F.col("node").alias("set_key"), F.col("component").alias("cluster")).join(sets, "set_key")
    members = write_table(members.select("set_key", "cluster", "n", "text_key"), "ngram-members")
    edges = _linked_sets(texts, members)

    linked = connected_components(edges)
    named = sets.join(linked, sets["set_key"] == linked["node"], "left")
    named = named.withColumn("component", F.coalesce("component", "set_key")).select("set_key", "component", "least")
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(smallest, "component").select(F.col("set_key").alias("of_set"), "component_id")
    out = described.select("doc_id", "text_key", "n_shingles", "set_key").join(named, F.col("set_key") == F.col("of_set"), "left")
    group = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_key", "n_shingles", group.alias("component_id"))


def _linked_sets(texts: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b): links that span every group of linked sets."""
    total = members.groupBy("cluster").agg(F.sum("n").alias("total"))
    blocks = F.ceil(F.col("total") / BLOCK_NGRAMS).cast("long")
    members = members.join(total, "cluster").withColumn("blocks", blocks)
    members = members.withColumn("block", F.pmod(F.xxhash64("set_key"), F.col("blocks"))).drop("total")
    members = write_table(members, "ngram-blocks")
    facts = members.agg(F.count(F.lit(1)).alias("rows"), F.max("blocks").alias("blocks"), F.sum("n").alias("n")).first()
    if not facts["rows"]:
        return members.select(F.col("set_key").alias("a"), F.col("set_key").alias("b")).limit(0)

    wanted, places = members.select("text_key").distinct(), members.drop("text_key", "n")
    if facts["rows"] <= BROADCAST_ROWS:
        wanted, places = F.broadcast(wanted), F.broadcast(places)
    chosen = texts.join(wanted, "text_key", "left_semi").select("text")
    grams = chosen.mapInArrow(_materialise, "set_key long, grams binary")
    stored = write_table(grams.join(places, "set_key"), "ngram-grams")

    shards = max(1, -(-facts["n"] // BLOCK_NGRAMS))
    edges, step = None, 0
    rows = stored.withColumn("label", F.col("set_key"))
    # Block i meets block i XOR step, first itself, then for twice as many steps each time.  In between, clusters
    # drop out that have no further blocks or are connected already.
    while edges is None or step < 1 << (facts["blocks"] - 1).bit_length():
        steps = F.sequence(F.lit(step), F.lit(max(0, 2 * step - 1)))
        mate = F.col("block").bitwiseXOR(F.col("step").cast("long"))
        pair = F.least("block", mate) * F.col("blocks") + F.greatest("block", mate)
        met = rows.withColumn("step", F.explode(steps)).where(mate < F.col("blocks")).withColumn("pair", pair)
        met = met.withColumn("shard", F.pmod(F.xxhash64("cluster", "pair"), F.lit(shards * max(1, step))))
        met = met.select("shard", "cluster", "pair", "block", "set_key", "label", "grams")
        found = write_table(met.groupBy("shard").applyInPandas(_join, "a long, b long"), "ngram-links")
        edges = found if edges is None else edges.union(found)
        step = max(1, 2 * step)
        if facts["blocks"] == 1:
            break
        linked = connected_components(edges)
        large = members.where(F.col("blocks") > step).select("set_key", "cluster")
        large = large.join(linked, large["set_key"] == linked["node"], "left")
        large = large.select("set_key", "cluster", F.coalesce("component", "set_key").alias("label"))
        open_ = large.groupBy("cluster").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y")
        labels = write_table(large.join(open_.select("cluster"), "cluster", "left_semi").select("set_key", "label"), "ngram-labels")
        if labels.isEmpty():
            break
        rows = stored.join(labels, "set_key")
    return edges


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that are their component's smallest doc_id, all columns kept.

    Rows are told apart by doc_id and text, so of several rows of one doc_id only those go that are copies of a smaller
    one.  A row without a doc_id goes if its component has one.  Rows of equal doc_id and text stay together, as do
    the rows of a component without any doc_id.  Null, empty and blank texts stay; an empty table gives no rows.
    """
    copies = _grouped(docs).where("component_id IS NOT NULL AND NOT doc_id <=> component_id")
    gone = copies.select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_text")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(gone["gone_id"]) & (F.xxhash64(docs["text"].cast("string")) == gone["gone_text"])
    return docs.join(gone, same, "left_anti")
