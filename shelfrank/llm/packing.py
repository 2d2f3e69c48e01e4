"""Packing documents into training sequences by lexical retrieval.

Documents are put in an order of their content and cut into shards of bounded size, so that neighbours meet
whatever the size of the corpus.  Each shard is a BM25 inverted index over token ids with corpus-wide
statistics; every seed document asks it for unused neighbours, which fill its window.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.text import draw_hash, draw_limit, mix64, slices
from shelfrank.llm.tokens import Encoder
from shelfrank.session import write_table

LENGTH = 4096
END_ID = 2
#: Token ids of the vocabulary fit 16 bits; the statistics have one row per id, whatever the corpus.
VOCABULARY = 1 << 16
SHARD_TOKENS = 1 << 20
K1, B = 1.2, 0.75
#: Shards that a task cuts from its range of the order, one after the other.
TASK_SHARDS = 4
#: Numbers of a profile; documents the topics are fitted on, about so many by a hash, never over twice as many.
PROFILE = 512
FIT_ROWS = 8000
HASH_PARTS = 1 << 62
#: Rows drawn per part to find where the parts begin.
PART_ROWS = 100
BRANCHES, LEAST_ROWS, ROUNDS = 16, 32, 6


@dataclass(frozen=True)
class Corpus:
    """Statistics over all documents: how many hold each id, how many there are, their mean length."""

    holding: np.ndarray
    documents: int
    mean_length: float

    def rarity(self) -> np.ndarray:
        return np.log1p((self.documents - self.holding + 0.5) / (self.holding + 0.5))


def profiles(docs: list[np.ndarray], corpus: Corpus) -> tuple[np.ndarray, np.ndarray]:
    """Per document its BM25 weights, hashed to ``PROFILE`` numbers of length 1, and its three heaviest ids as one number."""
    lengths = np.array([len(d) for d in docs], dtype=np.int64)
    doc = np.repeat(np.arange(len(docs), dtype=np.int64), lengths)
    keys, times = np.unique(doc * VOCABULARY + np.concatenate(docs), return_counts=True)
    doc, term = np.divmod(keys, VOCABULARY)
    norm = K1 * (1 - B + B * lengths / max(corpus.mean_length, 1e-9))
    weight = corpus.rarity()[term] * times * (K1 + 1) / (times + norm[doc])
    mixed = mix64(term + 1)
    place, sign = (mixed % np.uint64(PROFILE)).astype(np.int64), np.where(mixed >> np.uint64(63), 1.0, -1.0)
    x = np.bincount(doc * PROFILE + place, weights=weight * sign, minlength=len(docs) * PROFILE).reshape(-1, PROFILE)
    x = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    first = np.searchsorted(doc, np.arange(len(docs)))
    heaviest = np.zeros(len(docs), dtype=np.int64)
    for _ in range(3):
        most = np.maximum.reduceat(weight, first)
        at = np.flatnonzero(weight == most[doc])
        at = at[np.concatenate([[True], doc[at[1:]] != doc[at[:-1]]])]  # of equal weights the smallest id
        heaviest = heaviest * VOCABULARY + np.where(most > 0, term[at], 0)
        weight[at] = 0.0
    return x, heaviest


class Topics:
    """A tree of directions; its leaves, numbered from left to right, are topics of about one shard or less."""

    def __init__(self, x: np.ndarray, shards: int, seed: int = 5) -> None:
        self.nodes: list[tuple[np.ndarray, list[int]] | int] = []
        self.leaves = 0
        self._rng = np.random.default_rng(seed)
        self._grow(x, len(x) / max(1, shards))

    def _grow(self, x: np.ndarray, shard: float) -> int:
        number = len(self.nodes)
        self.nodes.append(0)
        branches = min(BRANCHES, len(x) // LEAST_ROWS, int(np.ceil(len(x) / max(shard, 1e-9))))
        centres = self._centres(x, branches) if branches > 1 else x[:0]
        if len(centres) < 2:
            self.nodes[number] = self.leaves
            self.leaves += 1
            return number
        nearest = (x @ centres.T).argmax(axis=1)
        self.nodes[number] = (centres, [self._grow(x[nearest == c], shard) for c in range(len(centres))])
        return number

    def _centres(self, x: np.ndarray, branches: int) -> np.ndarray:
        """Directions of groups by rounds of spherical k-means; each is some row's nearest, none holds all rows."""
        centres = x[self._rng.choice(len(x), size=branches, replace=False)]
        for _ in range(ROUNDS):
            nearest = (x @ centres.T).argmax(axis=1)
            sums = np.stack([x[nearest == c].sum(axis=0) for c in np.unique(nearest)])
            centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
        return centres[np.unique((x @ centres.T).argmax(axis=1))]

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each profile."""
        out = np.zeros(len(x), dtype=np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            number, rows = todo.pop()
            node = self.nodes[number]
            if isinstance(node, int):
                out[rows] = node
                continue
            centres, children = node
            nearest = (x[rows] @ centres.T).argmax(axis=1)
            todo += [(child, rows[nearest == c]) for c, child in enumerate(children) if (nearest == c).any()]
        return out


class Index:
    """BM25 postings of one shard, by id."""

    def __init__(self, docs: list[np.ndarray], corpus: Corpus) -> None:
        self.n = len(docs)
        lengths = np.array([len(d) for d in docs], dtype=np.int64)
        doc = np.repeat(np.arange(self.n, dtype=np.int64), lengths)
        keys = np.sort(np.concatenate(docs).astype(np.int64) * self.n + doc)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        times = np.diff(np.concatenate([first, [len(keys)]]))
        term, self.doc = np.divmod(keys[first], self.n)
        norm = K1 * (1 - B + B * lengths / max(corpus.mean_length, 1e-9))
        self.weight = corpus.rarity()[term] * times * (K1 + 1) / (times + norm[self.doc])
        self.start = np.searchsorted(term, np.arange(VOCABULARY + 1))

    def scores(self, query: np.ndarray) -> np.ndarray:
        """BM25 of every document of the shard for the distinct ids of a query."""
        terms = np.unique(query)
        low = self.start[terms]
        size = self.start[terms.astype(np.int64) + 1] - low
        ends = np.cumsum(size)
        place = np.arange(ends[-1]) + np.repeat(low - (ends - size), size)
        return np.bincount(self.doc[place], weights=self.weight[place], minlength=self.n)


def fill_windows(docs: list[np.ndarray], index: Index, length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """(document, start, size, window, offset) of every piece, windows full but the last.

    A seed fills its window; what room it leaves goes to its unused neighbours, best first, ties in the
    order of the documents.  The one that the window's end cuts goes on as the next seed.
    """
    unused = np.ones(len(docs), dtype=bool)
    pieces = []
    window, used = 0, 0
    seed, start, next_seed = -1, 0, 0
    while True:
        if seed < 0:
            while next_seed < len(docs) and not unused[next_seed]:
                next_seed += 1
            if next_seed == len(docs):
                return pieces
            seed, start = next_seed, 0
            unused[seed] = False
        queue, at, query = [(seed, start)], 0, seed
        seed = -1
        while at < len(queue):
            doc, start = queue[at]
            unused[doc] = False
            size = min(len(docs[doc]) - start, length - used)
            pieces.append((doc, start, size, window, used))
            used += size
            at += 1
            if used == length:
                window, used = window + 1, 0
                if start + size < len(docs[doc]):
                    seed, start = doc, start + size
                break
            if at == len(queue) and len(queue) == 1:
                rest = np.flatnonzero(unused)
                if len(rest):
                    order = np.argsort(-index.scores(docs[query])[rest], kind="stable")
                    queue += [(int(i), 0) for i in rest[order]]


def _pack(docs: list[np.ndarray], ids: list[int | None], corpus: Corpus, first: int) -> pd.DataFrame:
    """Pieces of one shard, its windows numbered from ``first``."""
    pieces = fill_windows(docs, Index(docs, corpus))
    doc, start, size, window, offset = (np.array(c, dtype=np.int64) for c in zip(*pieces, strict=True))
    lengths = np.array([len(d) for d in docs], dtype=np.int64)
    crc = [zlib.crc32(docs[d][s : s + n].astype("<u4").tobytes()) for d, s, n, _, _ in pieces]
    return pd.DataFrame(
        {
            "doc_id": pd.array(ids, dtype="Int64")[doc], "start": start, "length": size, "ids_crc32": np.array(crc, dtype=np.int64),
            "doc_tokens": lengths[doc], "sequence_id": first + window, "offset": offset,
        }
    )


def tokenize(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(row_key, doc_id, n_tokens, ids, holding): one row per document, and one per task with its document counts by id.

    ``ids`` are 16-bit numbers; the end id follows each text.  ``row_key`` tells rows apart
    whose doc_ids are equal or null; it holds once the table is written.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        key = TaskContext.get().partitionId() << 33
        holding, last = np.zeros(VOCABULARY, dtype=np.int64), np.zeros(VOCABULARY, dtype=np.int64)
        names = ["row_key", "doc_id", "n_tokens", "ids", "holding"]
        for batch in batches:
            for low, high, data, offsets in slices(batch.column(1)):
                ids, sizes = encoder(data, offsets)
                out = [np.append(x, np.uint16(END_ID)) for x in np.split(ids, np.cumsum(sizes)[:-1])]
                for x in out:
                    place = np.arange(len(x))
                    last[x] = place
                    holding[x[last[x] == place]] += 1  # each id once
                rows = len(out)
                columns = [
                    pa.array(np.arange(key, key + rows)), batch.column(0).slice(low, rows), pa.array(sizes + 1),
                    pa.array([x.tobytes() for x in out], pa.binary()), pa.nulls(rows, pa.binary()),
                ]
                key += rows
                yield pa.RecordBatch.from_arrays(columns, names=names)
        if holding.any():
            columns = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([holding.tobytes()], pa.binary())], names=names)

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(encode, "row_key long, doc_id long, n_tokens long, ids binary, holding binary")


def corpus_statistics(table: DataFrame) -> Corpus:
    """Statistics of a tokenized table, summed up over its tasks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(VOCABULARY, dtype=np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                total += np.frombuffer(raw, dtype=np.int64)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["id", "documents"])

    summed = table.where("holding IS NOT NULL").select("holding").mapInArrow(add, "id long, documents long")
    # One row per id of the vocabulary at most.
    counts = summed.groupBy("id").agg(F.sum("documents").alias("documents")).toPandas()
    holding = np.zeros(VOCABULARY)
    holding[counts["id"].to_numpy(dtype=np.int64)] = counts["documents"].to_numpy(dtype=float)
    n, mean = table.agg(F.count("row_key"), F.avg("n_tokens")).first()
    return Corpus(holding, n, mean or 0.0)


def fit_topics(rows: DataFrame, corpus: Corpus, shards: int, fit_rows: int = FIT_ROWS) -> Topics:
    """Topics of a tokenized table, as many as fill the shards, fitted on documents drawn by a hash of row and ids."""
    if shards == 1:
        return Topics(np.zeros((0, PROFILE), dtype=np.float32), 1)
    share = max(1, int(HASH_PARTS * min(1.0, fit_rows / max(1, corpus.documents))))
    drawn = rows.where(F.xxhash64("row_key", "ids").bitwiseAND(F.lit(HASH_PARTS - 1)) < share)

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                x, _ = profiles([np.frombuffer(raw, dtype=np.uint16) for raw in part.column(1).to_pylist()], corpus)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([r.tobytes() for r in x])], names=["row_key", "profile"])

    small = drawn.select("row_key", "ids").limit(2 * fit_rows).mapInArrow(profile, "row_key long, profile binary")
    fitted = small.toPandas().sort_values("row_key")
    return Topics(np.frombuffer(b"".join(fitted["profile"]), dtype=np.float32).reshape(-1, PROFILE), shards)


_PLACED = "row_key long, doc_id long, ids binary, content long, topic long, heaviest long"


def _placed(batch: pa.RecordBatch, corpus: Corpus, topics: Topics) -> Iterator[pa.RecordBatch]:
    """Rows (row_key, doc_id, ids, content) with their topic and heaviest ids."""
    for low in range(0, batch.num_rows, 256):
        part = batch.slice(low, 256)
        x, heaviest = profiles([np.frombuffer(raw, dtype=np.uint16) for raw in part.column(2).to_pylist()], corpus)
        names = ["row_key", "doc_id", "ids", "content", "topic", "heaviest"]
        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(topics.leaf(x)), pa.array(heaviest)], names=names)


def _bounds(rows: DataFrame, corpus: Corpus, topics: Topics, order: list[str], parts: int) -> list[tuple]:
    """Places of the order that part it into about as many ids each, from some rows per part drawn by a hash.

    A range partitioner does the same, but would work out every document's place twice.
    """
    if parts <= 1:
        return []

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for placed in _placed(batch, corpus, topics):
                size = pa.array([len(raw) for raw in placed.column("ids").to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([*(placed.column(c) for c in order), size], names=[*order, "size"])

    share = draw_limit(PART_ROWS * parts / max(1, corpus.documents))
    drawn = rows.where(draw_hash("row_key", "content") <= share)
    sample = drawn.mapInArrow(place, ", ".join(f"{c} long" for c in (*order, "size"))).toPandas().sort_values(order)
    done = sample["size"].cumsum().to_numpy()
    if not len(done):
        return []
    at = np.unique(np.searchsorted(done, done[-1] * np.arange(1, parts) / parts))
    return list(sample[order].iloc[at].itertuples(index=False, name=None))


def pack_documents(docs: DataFrame, tokenizer: str, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Pieces of all documents in sequences of at most ``LENGTH`` ids.

    Returns doc_id, start, length, ids_crc32 (of the piece's ids as little-endian 32-bit numbers),
    doc_tokens, sequence_id and offset.  Each id of a document lies in exactly one piece; offsets of a sequence
    have no gaps; only the last sequence of a shard is not full.

    The order of the documents goes by topic, then by their heaviest ids, then by a hash of their ids, so copies stand
    side by side and no topic or key is bound to one task.  Shards are runs of it of about
    ``shard_tokens`` ids; a longer document is a shard's one unbounded part.  Null and empty texts have the end id alone.
    Repeated rows are packed each; null doc_ids stay null; an empty table gives no rows; other columns are ignored.
    """
    table = write_table(tokenize(docs, tokenizer), "token-ids")
    corpus = corpus_statistics(table)
    shards = max(1, -(-int(corpus.documents * corpus.mean_length) // shard_tokens))
    rows = table.where("row_key IS NOT NULL").select("row_key", "doc_id", "ids")
    topics = fit_topics(rows, corpus, shards)

    rows = rows.withColumn("content", F.xxhash64("ids"))
    order = ["topic", "heaviest", "content", "row_key"]
    parts = -(-shards // TASK_SHARDS)
    bounds = _bounds(rows, corpus, topics, order, parts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for placed in _placed(batch, corpus, topics):
                at = zip(*(placed.column(c).to_pylist() for c in order), strict=True)
                yield placed.append_column("part", pa.array([bisect_left(bounds, key) for key in at], pa.int32()))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        held, ids, tokens = [], [], 0

        def shard() -> pa.RecordBatch:
            nonlocal first, held, ids, tokens
            packed = _pack(held, ids, corpus, first)
            first, held, ids, tokens = int(packed["sequence_id"].iloc[-1]) + 1, [], [], 0
            return pa.RecordBatch.from_pandas(packed, preserve_index=False)

        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.append(np.frombuffer(raw, dtype=np.uint16))
                ids.append(doc_id)
                tokens += len(held[-1])
                if tokens >= shard_tokens:
                    yield shard()
        if held:
            yield shard()

    placed = rows.mapInArrow(place, f"{_PLACED}, part int")
    # A corpus of one shard stays whole; else tasks cut shards from ranges of the order.
    dealt = placed.repartitionById(len(bounds) + 1, "part").sortWithinPartitions(*order)
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return dealt.select("doc_id", "ids").mapInArrow(pack, schema)
