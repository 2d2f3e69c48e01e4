"""Token ids of a corpus as raw files, found by document key through a minimal perfect hash.

A folder of token files holds

- ``ids/``: shards, each the raw ids of a run of documents in the order of their keys.  After the ids stand the
  documents' ends (64-bit, the first is 0) and a footer: documents, ids, width of an id in bytes, ``TOKENIDS``.
- ``shards/``: a Parquet table with one row per shard: its file and how many documents and ids lie before it.
- ``keys/``: one file per part of the keys: a minimal perfect hash, and under each key's number a fingerprint,
  the place of its first document and how many documents it has.
- ``index/``: a Parquet table with one row per part, and one (part -1) for documents without a key.

A task names its files at random and returns the names as rows, so files of lost attempts are never referred to.
Files are opened through ``pyarrow.fs``; the folder must be one that it and Spark both reach.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfrank.llm.perfect_hash import PerfectHash, fingerprints
from shelfrank.llm.text import slices
from shelfrank.llm.tokens import Encoder
from shelfrank.session import write_table

END_ID = 2
#: A task closes a shard once it holds so many ids, and goes on with another.
SHARD_IDS = 1 << 26
#: Keys of one part of the index.
PART_KEYS = 1 << 16
#: Ids read from a shard at once, but for a longer document.
READ_IDS = 1 << 20
ID = np.dtype("<u2")
MAGIC = b"TOKENIDS"
_FOOTER = "<qqq8s"
_HEAD = "<qq"
_SEED = 42


def _open(path: str):
    return pyarrow.fs.FileSystem.from_uri(path)


def part_of(key: Column, parts: int) -> Column:
    """The part of the index that knows a key; -1 for null."""
    return F.when(key.isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))


# Writing


class _Shard:
    """A shard under way."""

    def __init__(self, folder: str, number: int) -> None:
        self.number, self.name = number, f"{uuid.uuid4().hex}.ids"
        files, where = _open(folder)
        self.out = files.open_output_stream(f"{where}/ids/{self.name}")
        self.sizes: list[np.ndarray] = []
        self.docs = self.ids = 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.out.write(ids.astype(ID).tobytes())
        self.sizes.append(sizes)
        self.docs += len(sizes)
        self.ids += int(sizes.sum())

    def close(self) -> None:
        ends = np.concatenate([[0], np.cumsum(np.concatenate(self.sizes))]).astype("<i8")
        self.out.write(ends.tobytes())
        self.out.write(struct.pack(_FOOTER, self.docs, self.ids, ID.itemsize, MAGIC))
        self.out.close()


def _with_ends(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ids with the end id after each document."""
    return np.insert(ids, np.cumsum(sizes), END_ID)


def write_token_files(
    docs: DataFrame, tokenizer: str, path: str, shard_ids: int = SHARD_IDS, part_keys: int = PART_KEYS
) -> None:
    """Write the ids of all documents to a new folder, in ascending order of doc_id, each followed by the end id.

    Null texts count as empty and have the end id alone.  A null doc_id comes first.  Rows of equal doc_id
    stand next to each other, in the order of their texts, and share one key.  An empty table gives a folder
    without shards.  Columns other than doc_id and text are ignored.  One row's text must fit a task.
    """
    files, where = _open(path)
    files.create_dir(f"{where}/ids", recursive=True)
    files.create_dir(f"{where}/keys", recursive=True)
    written = write_table(_write_shards(docs, tokenizer, path, shard_ids), "token-shards")

    shards = written.where("file IS NOT NULL").select("shard", "file", F.col("n_rows").alias("n_docs"), "n_ids")
    # One row per shard; ids and documents of the shards before it.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = {f"first_{c}": F.coalesce(F.sum(f"n_{c}s").over(before), F.lit(0)) for c in ("doc", "id")}
    shards.withColumns(bases).coalesce(1).write.parquet(f"{path}/shards")
    shards = docs.sparkSession.read.parquet(f"{path}/shards")

    runs = written.where("file IS NULL").join(shards.select("shard", "first_doc"), "shard")
    # Runs of a key that several shards or slices hold become one; a frequent key is one row per slice here.
    keys = runs.groupBy("doc_id").agg(
        F.min(F.col("first_doc") + F.col("ordinal")).alias("first"), F.sum("n_rows").alias("n_rows")
    )
    keys = write_table(keys, "token-keys")
    parts = max(1, -(-keys.count() // part_keys))
    known = keys.where("doc_id IS NOT NULL").withColumn("part", part_of(F.col("doc_id"), parts))

    def index(group: pa.Table) -> pa.Table:
        name = f"{uuid.uuid4().hex}.mph"
        _write_part(path, name, *(group.column(c).to_numpy() for c in ("doc_id", "first", "n_rows")))
        row = {"part": [group.column("part")[0].as_py()], "file": [name], "parts": [parts]}
        return pa.table(row, schema=pa.schema([("part", pa.int32()), ("file", pa.string()), ("parts", pa.int64())]))

    # A group is the keys of one part, about part_keys rows whatever the documents.
    built = known.groupBy("part").applyInArrow(index, "part int, file string, parts long")
    no_key = keys.where("doc_id IS NULL").select(
        F.lit(-1).alias("part"), F.lit(None).cast("string").alias("file"), F.lit(parts).cast("long").alias("parts"), "first", "n_rows"
    )
    built.unionByName(no_key, allowMissingColumns=True).write.parquet(f"{path}/index")


def _write_shards(docs: DataFrame, tokenizer: str, path: str, shard_ids: int) -> DataFrame:
    """Writes the shards; a row per run of a key in a slice, and a row with the file's name per shard."""
    names = ["shard", "doc_id", "ordinal", "n_rows", "file", "n_ids"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, number, shard = Encoder(tokenizer), TaskContext.get().partitionId() << 32, None

        def closed() -> pa.RecordBatch:
            shard.close()
            row = [[shard.number], [None], [None], [shard.docs], [shard.name], [shard.ids]]
            kinds = [pa.int64()] * 4 + [pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            for low, high, data, offsets in slices(batch.column(1)):
                ids, sizes = encoder(data, offsets)
                if shard is None:
                    shard = _Shard(path, number)
                    number += 1
                doc_id = batch.column(0).slice(low, high - low)
                null = np.array(doc_id.is_null())
                key = doc_id.fill_null(0).to_numpy()
                starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (null[1:] != null[:-1])]))
                rows = len(starts)
                columns = [
                    pa.array(np.full(rows, shard.number)), doc_id.take(pa.array(starts)), pa.array(starts + shard.docs),
                    pa.array(np.diff(np.append(starts, high - low))), pa.nulls(rows, pa.string()), pa.nulls(rows, pa.int64()),
                ]
                shard.add(_with_ends(ids, sizes), sizes + 1)
                yield pa.RecordBatch.from_arrays(columns, names=names)
                if shard.ids >= shard_ids:
                    yield closed()
                    shard = None
        if shard is not None:
            yield closed()

    # Ranges of the order; the text's hash parts rows of one doc_id, so that no key is bound to one task.
    order = ["doc_id", "content"]
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("content"))
    ordered = texts.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return ordered.mapInArrow(write, "shard long, doc_id long, ordinal long, n_rows long, file string, n_ids long")


def _write_part(path: str, name: str, doc_id: np.ndarray, first: np.ndarray, rows: np.ndarray) -> None:
    key = doc_id.astype(np.int64).view(np.uint64)
    hashed = PerfectHash.build(key)
    number = hashed(key)
    columns = [np.zeros(len(key), kind) for kind in ("<u4", "<i8", "<i8")]
    for column, values in zip(columns, (fingerprints(key), first, rows), strict=True):
        column[number] = values
    files, where = _open(path)
    with files.open_output_stream(f"{where}/keys/{name}") as out:
        out.write(struct.pack(_HEAD, len(key), len(hashed.starts)))
        for array in (hashed.starts.astype("<i8"), hashed.words, *columns):
            out.write(array.tobytes())


# Reading


class KeyPart:
    """A part of the index in memory: where the documents of a key begin, and how many they are."""

    def __init__(self, path: str, name: str) -> None:
        files, where = _open(path)
        with files.open_input_stream(f"{where}/keys/{name}") as source:
            raw = source.read()
        keys, levels = struct.unpack_from(_HEAD, raw)
        at = struct.calcsize(_HEAD)

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(raw, kind, count, at)
            at += found.nbytes
            return found

        starts = take("<i8", levels)
        self.hash = PerfectHash.of(starts, take("<u8", int(starts[-1]) >> 6))
        self.fingerprint, self.first, self.rows = take("<u4", keys), take("<i8", keys), take("<i8", keys)

    def find(self, doc_id: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first document, documents) of each key; no documents for an unknown key but for one in 2^32."""
        key = doc_id.astype(np.int64).view(np.uint64)
        number = self.hash(key)
        known = number >= 0
        known[known] = self.fingerprint[number[known]] == fingerprints(key[known])
        number = np.where(known, number, 0)
        return np.where(known, self.first[number], -1), np.where(known, self.rows[number], 0)


class Shards:
    """The table of shards in memory; a few dozen bytes per shard."""

    def __init__(self, path: str) -> None:
        files, where = _open(path)
        table = pyarrow.parquet.read_table(f"{where}/shards", filesystem=files).sort_by("shard")
        self.path, self.files, self.where = path, files, where
        self.names = table.column("file").to_pylist()
        self.first_doc = table.column("first_doc").to_numpy()
        self.first_id = table.column("first_id").to_numpy()
        self.docs = int(self.first_doc[-1] + table.column("n_docs").to_numpy()[-1]) if self.names else 0

    def pieces(self, first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(which run, shard, first document there, documents) of runs of documents, cut at the ends of shards."""
        ends = np.append(self.first_doc[1:], self.docs)
        low = np.searchsorted(self.first_doc, first, side="right") - 1
        high = np.searchsorted(self.first_doc, first + rows, side="left") - 1
        count = np.where(rows > 0, high - low + 1, 0)
        which = np.repeat(np.arange(len(first)), count)
        shard = low[which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        start = np.maximum(first[which], self.first_doc[shard])
        stop = np.minimum((first + rows)[which], ends[shard])
        return which, shard, start - self.first_doc[shard], stop - start

    def open(self, shard: int) -> ShardReader:
        return ShardReader(self.files, f"{self.where}/ids/{self.names[shard]}", int(self.first_id[shard]))


class ShardReader:
    """One shard: its documents' ends in memory, its ids read as asked for."""

    def __init__(self, files, name: str, first_id: int) -> None:
        self.source, self.first_id = files.open_input_file(name), first_id
        size = self.source.size()
        docs, ids, width, magic = struct.unpack(_FOOTER, self.source.read_at(struct.calcsize(_FOOTER), size - struct.calcsize(_FOOTER)))
        if magic != MAGIC or width != ID.itemsize:
            raise ValueError(f"{name} is no file of token ids")
        self.ends = np.frombuffer(self.source.read_at(8 * (docs + 1), ids * width), "<i8")

    def runs(self, ordinals: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(places in ``ordinals``, their ends, their ids) in few reads: documents side by side are read together."""
        at = 0
        while at < len(ordinals):
            until = self.ends[ordinals[at]] + READ_IDS
            stop = at + 1
            while stop < len(ordinals) and ordinals[stop] == ordinals[stop - 1] + 1 and self.ends[ordinals[stop] + 1] <= until:
                stop += 1
            low, high = int(self.ends[ordinals[at]]), int(self.ends[ordinals[stop - 1] + 1])
            raw = self.source.read_at((high - low) * ID.itemsize, low * ID.itemsize)
            ends = self.ends[ordinals[at:stop] + 1] - low
            yield np.arange(at, stop), ends, np.frombuffer(raw, ID)
            at = stop


class TokenReader:
    """Keyed access without Spark: ``reader[doc_id]`` is the list of id arrays of its documents."""

    def __init__(self, path: str) -> None:
        self.path, self.shards = path, Shards(path)
        files, where = _open(path)
        rows = pyarrow.parquet.read_table(f"{where}/index", filesystem=files).to_pylist()
        self.parts = max((r["parts"] for r in rows), default=1)
        self.names = {r["part"]: r["file"] for r in rows}
        self.no_key = next(((r["first"], r["n_rows"]) for r in rows if r["part"] < 0), (0, 0))
        self._loaded: dict[int, KeyPart] = {}

    def __getitem__(self, doc_id: int | None) -> list[np.ndarray]:
        if doc_id is None:
            first, rows = (np.array([x]) for x in self.no_key)
        else:
            import xxhash

            hashed = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), seed=_SEED)
            part = (hashed - (1 << 64) if hashed >> 63 else hashed) % self.parts
            if part not in self.names:
                return []
            if part not in self._loaded:
                self._loaded[part] = KeyPart(self.path, self.names[part])
            first, rows = self._loaded[part].find(np.array([doc_id]))
        out = []
        for _, shard, start, count in zip(*self.shards.pieces(first, rows), strict=True):
            for _, ends, ids in self.shards.open(int(shard)).runs(np.arange(start, start + count)):
                out += np.split(ids, ends[:-1])
        return out


def read_token_files(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """The documents of ``keys`` (doc_id) as (doc_id, start, n_tokens, ids), read from a folder of token files.

    ``start`` counts the ids of all documents before it in the folder, ``ids`` holds little-endian 32-bit numbers.
    A key asked for twice is answered once; one that is not there gives no row; a key of several documents gives
    a row for each.  Null asks for the documents without a key.  Columns other than doc_id are ignored.
    """
    index = spark.read.parquet(f"{path}/index")
    parts = index.agg(F.max("parts")).first()[0]
    if parts is None:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids binary")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, loaded, name = Shards(path), None, None
        for batch in batches:
            doc_id, file = batch.column(0), batch.column(1).to_pylist()
            cuts = [0, *(i for i in range(1, len(file)) if file[i] != file[i - 1]), len(file)]
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                if low == high:
                    continue
                asked = doc_id.slice(low, high - low)
                if file[low] is None:
                    first, rows = (batch.column(c).slice(low, high - low).to_numpy() for c in (2, 3))
                else:
                    if file[low] != name:
                        loaded, name = KeyPart(path, file[low]), file[low]
                    first, rows = loaded.find(asked.to_numpy())
                which, shard, start, count = shards.pieces(first, rows)
                columns = [pa.array(shard), asked.take(pa.array(which)), pa.array(start), pa.array(count)]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "doc_id", "ordinal", "n_rows"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, loaded, number = Shards(path), None, -1
        for batch in batches:
            shard, key, ordinal, rows = (batch.column(c) for c in range(4))
            shard, ordinal, rows = shard.to_numpy(), ordinal.to_numpy(), rows.to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(shard)]])
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if low == high:
                    continue
                if shard[low] != number:
                    loaded, number = shards.open(int(shard[low])), int(shard[low])
                for piece in range(low, high, 4096):
                    yield from _read_pieces(loaded, key, ordinal, rows, piece, min(high, piece + 4096))

    asked = keys.select(F.col("doc_id").cast("long")).distinct().withColumn("part", part_of(F.col("doc_id"), parts))
    found = asked.join(index, "part").repartition("part").sortWithinPartitions("part")
    pieces = found.select("doc_id", "file", "first", "n_rows").mapInArrow(find, "shard long, doc_id long, ordinal long, n_rows long")
    dealt = pieces.repartition("shard").sortWithinPartitions("shard", "ordinal")
    return dealt.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def _read_pieces(reader: ShardReader, key: pa.Array, ordinal, rows, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """Documents of some runs of a shard, the runs in ascending order, in steps of ``READ_IDS`` documents."""
    steps = -(-rows[low:high] // READ_IDS)
    run = np.repeat(np.arange(low, high), steps)
    done = READ_IDS * (np.arange(len(run)) - np.repeat(np.cumsum(steps) - steps, steps))
    start, count = ordinal[run] + done, np.minimum(rows[run] - done, READ_IDS)
    at = 0
    while at < len(run):
        stop = max(at + 1, at + int(np.searchsorted(np.cumsum(count[at:]), READ_IDS, side="right")))
        which = np.repeat(run[at:stop], count[at:stop])
        before = np.repeat(np.cumsum(count[at:stop]) - count[at:stop], count[at:stop])
        wanted = np.repeat(start[at:stop], count[at:stop]) + np.arange(len(which)) - before
        for places, ends, ids in reader.runs(wanted):
            sizes = np.diff(np.concatenate([[0], ends]))
            buffers = [None, pa.py_buffer(np.concatenate([[0], ends * 4]).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))]
            columns = [
                key.take(pa.array(which[places])), pa.array(reader.first_id + reader.ends[wanted[places]]), pa.array(sizes),
                pa.Array.from_buffers(pa.binary(), len(ends), buffers),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids"])
        at = stop
