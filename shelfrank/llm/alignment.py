"""Aligning the tokens of two tokenizers over the same texts, and counting which ids go together.

The tokens of both are intervals of bytes.  Sorted by start, a token that starts where the ends seen so far reach
opens a new group, so the groups are the finest pieces of the text that both tokenizers cut out alike.  All tokens of
one side are linked with all of the other within a group.

Neither tokenizer has a token across the border between a sign and a space after it, so texts are cut there, and
each different word is tokenized and aligned once by a task.  Documents are worked off in chunks: a chunk names its
words' id pairs once and each document as words with their times.  The corpus-wide counts are joined to
the chunk's pairs and go back to the chunk as one list.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.text import SpanHasher, slices
from shelfrank.session import write_table

#: Text bytes of a chunk; a longer document is a chunk.
CHUNK_BYTES = 1 << 22
SLICE_BYTES = 1 << 19
#: Words given to a tokenizer at once, whose own records of them are many times their size.
AT_ONCE = 1024
#: Words and their bytes remembered by a task, beyond which it starts afresh with the next chunk.
REMEMBERED, REMEMBERED_BYTES = 200_000, 1 << 23
SPACE_MARK = "▁"
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
DIGITS = 6
#: (document, pair) entries that are told apart at once.
ENTRIES = 1 << 19
#: Bytes that surely end no white space: ASCII signs.
_SOLID = np.zeros(256, dtype=bool)
_SOLID[33:127] = True


# Tokens and their bytes


class Vocabulary:
    """The bytes of every id, laid end to end."""

    def __init__(self, pieces: list[bytes]) -> None:
        self.sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(pieces), dtype=np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ids):
            return np.zeros(0, np.uint8)
        return self.data[np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - sizes), sizes)]


def _letter_bytes() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself, or the next from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevelTokens:
    """Ids by a byte-level tokenizer file, whose pieces end before a space that follows a sign."""

    def __init__(self, path: str) -> None:
        # Tasks already take all cores; threads of its own would only cost memory.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        byte = _letter_bytes()
        pieces = [b""] * self.tokenizer.get_vocab_size()
        for piece, i in self.tokenizer.get_vocab().items():
            pieces[i] = bytes(byte[c] for c in piece) if all(c in byte for c in piece) else piece.encode()
        self.vocabulary = Vocabulary(pieces)

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]


class PieceTokens:
    """Ids by a sentence-piece model; bytes without a piece are pieces ``<0xHH>``.  Texts begin with a space."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            byte = _BYTE_PIECE.fullmatch(piece)
            if SPACE_MARK in piece.lstrip(SPACE_MARK):
                raise ValueError(f"piece {piece} has a space after a sign, so texts cannot be cut at spaces")
            pieces.append(bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE_MARK, " ").encode())
        self.vocabulary = Vocabulary(pieces)

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode([t[1:] for t in texts], num_threads=1)  # the model puts the first space itself


# Groups


def coalesce_intervals(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every token of either side, from the sizes of tokens that cover the same bytes."""
    ends = np.concatenate([np.cumsum(a_sizes), np.cumsum(b_sizes)])
    starts = ends - np.concatenate([a_sizes, b_sizes])
    side = np.repeat([0, 1], [len(a_sizes), len(b_sizes)])
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    opens = np.ones(len(order), dtype=bool)
    opens[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(opens) - 1
    return group[: len(a_sizes)], group[len(a_sizes) :]


def _numerals(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0 to count - 1, left-aligned in a row with room for a separator, and how many they are."""
    rows = np.zeros((count, DIGITS + 1), dtype=np.uint8)
    sizes = np.ones(count, dtype=np.int64)
    for i in range(count):
        text = str(i).encode()
        rows[i, : len(text)] = np.frombuffer(text, np.uint8)
        sizes[i] = len(text)
    return rows, sizes


class GroupWriter:
    """Groups as ``a1,a2|b1;a3|b2,b3`` in decimal ids."""

    def __init__(self, ids: int) -> None:
        if ids > 10**DIGITS:
            raise ValueError("ids have too many digits")
        self.rows, self.sizes = _numerals(ids)

    def __call__(self, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, first: np.ndarray) -> list[bytes]:
        """One text per document; ``first`` holds the documents' first groups and the number of groups."""
        groups = int(first[-1])
        a_before = np.concatenate([[0], np.cumsum(np.bincount(a_group, minlength=groups))])
        b_before = np.concatenate([[0], np.cumsum(np.bincount(b_group, minlength=groups))])
        total = len(a) + len(b)
        ids, mark = np.empty(total, dtype=np.int64), np.full(total, ord(","), dtype=np.uint8)
        ids[np.arange(len(a)) + b_before[a_group]] = a
        ids[np.arange(len(b)) + a_before[b_group + 1]] = b
        mark[a_before[1:] + b_before[:-1] - 1] = ord("|")
        ends = a_before + b_before
        mark[ends[1:] - 1] = ord(";")
        size = self.sizes[ids]
        digits = self.rows[ids]
        digits[np.arange(total), size] = mark
        text = digits[np.arange(DIGITS + 1) <= size[:, None]].tobytes()
        places = np.concatenate([[0], np.cumsum(size + 1)])
        cuts = places[ends[first]].tolist()
        return [text[low : high - 1] for low, high in zip(cuts[:-1], cuts[1:], strict=True)]


# Chunks


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of several runs, one after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_counts=True)


def _narrow(numbers: np.ndarray) -> bytes:
    """As little-endian numbers of the fewest bytes; their width follows from the length."""
    most = int(numbers.max(initial=0))
    return numbers.astype(next(f"<u{w}" for w in (1, 2, 4, 8) if most < 1 << 8 * w)).tobytes()


def _wide(raw: bytes, count: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{max(1, len(raw) // max(1, count))}").astype(np.int64)


def linked_pairs(a, b, a_group, b_group, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, pair, links): the different id pairs ``a << 32 | b`` that each text links, and how often.

    ``first`` holds the texts' first groups and the number of groups.  Equal ids of a group are taken together first.
    """
    (a_keys, a_times), (b_keys, b_times) = _counted(a_group << 32 | a), _counted(b_group << 32 | b)
    of_a, of_b, low = a_keys >> 32, b_keys >> 32, (1 << 32) - 1
    size = np.bincount(of_b, minlength=int(first[-1]))
    left = np.repeat(np.arange(len(a_keys)), size[of_a])
    right = _runs((np.cumsum(size) - size)[of_a], size[of_a])
    pair = (a_keys[left] & low) << 32 | (b_keys[right] & low)
    text = np.searchsorted(first, of_a[left], side="right") - 1
    order = np.lexsort((pair, text))
    text, pair, links = text[order], pair[order], (a_times[left] * b_times[right])[order]
    new = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (pair[1:] != pair[:-1]))) if len(pair) else np.zeros(0, np.int64)
    return text[new], pair[new], np.add.reduceat(links, new) if len(new) else links


def _encoded(side, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All ids of some texts, and how many each has."""
    ids, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for low in range(0, len(texts), AT_ONCE):
        lists = side(texts[low : low + AT_ONCE])
        sizes.append(np.fromiter(map(len, lists), np.int64, len(lists)))
        ids.append(np.fromiter(chain.from_iterable(lists), np.int64, int(sizes[-1].sum())))
    return np.concatenate(ids), np.concatenate(sizes)


class _Grown:
    """An array that grows at its end."""

    def __init__(self, kind) -> None:
        self.size, self.data = 0, np.zeros(1024, dtype=kind)

    def add(self, values: np.ndarray) -> None:
        end = self.size + len(values)
        if end > len(self.data):
            self.data = np.concatenate([self.data, np.zeros(max(end, len(self.data)), self.data.dtype)])
        self.data[self.size : end] = values
        self.size = end

    @property
    def values(self) -> np.ndarray:
        return self.data[: self.size]


class Words:
    """Different words with their figures, groups and id pairs; told apart by 64-bit hashes of their bytes."""

    FIGURES = ("n_a", "n_b", "n_groups", "n_links")

    def __init__(self, a_path: str, b_path: str) -> None:
        self.sides = ByteLevelTokens(a_path), PieceTokens(b_path)
        self.writer = GroupWriter(max(len(s.vocabulary.sizes) for s in self.sides))
        self.hasher = SpanHasher()
        self.forget()

    def forget(self) -> None:
        self.known: dict[int, int] = {}
        self.groups: list[bytes] = []
        self.bytes = 0
        self.figures = {n: _Grown(np.int64) for n in self.FIGURES}
        self.sound, self.size = _Grown(bool), _Grown(np.int64)
        self.pairs, self.links = _Grown(np.int64), _Grown(np.int64)

    def __call__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The numbers of the words that stand there; new ones are learned."""
        codes, keys = pd.factorize(self.hasher(data, start, end))
        number = np.array([self.known.get(k, -1) for k in keys.tolist()], dtype=np.int64)
        new = np.flatnonzero(number < 0)
        if len(new):
            at = np.empty(len(keys), dtype=np.int64)
            at[codes[::-1]] = np.arange(len(codes))[::-1]
            text = data.tobytes()
            number[new] = len(self.groups) + np.arange(len(new))
            self.known.update(zip(keys[new].tolist(), number[new].tolist(), strict=True))
            self._learn([text[start[i] : end[i]] for i in at[new].tolist()])
        return number[codes]

    def _learn(self, words: list[bytes]) -> None:
        texts = [w.decode() for w in words]
        whole, cuts = np.frombuffer(b"".join(words), np.uint8), np.concatenate([[0], np.cumsum([len(w) for w in words])])
        sound, found = np.ones(len(words), dtype=bool), []
        for side in self.sides:
            ids, sizes = _encoded(side, texts)
            found.append((ids, sizes))
            spelled = side.vocabulary.spell(ids)
            ends = np.concatenate([[0], np.cumsum(side.vocabulary.sizes[ids])])[np.concatenate([[0], np.cumsum(sizes)])]
            if not np.array_equal(ends, cuts) or not np.array_equal(spelled, whole):
                for i in range(len(words)):
                    sound[i] &= np.array_equal(spelled[ends[i] : ends[i + 1]], whole[cuts[i] : cuts[i + 1]])
        (a, n_a), (b, n_b) = ((ids[np.repeat(sound, sizes)], np.where(sound, sizes, 0)) for ids, sizes in found)
        a_group, b_group = coalesce_intervals(*(s.vocabulary.sizes[ids] for s, ids in zip(self.sides, (a, b), strict=True)))
        groups = int(a_group[-1]) + 1 if len(a) else 0
        first = np.append(a_group, groups)[np.concatenate([[0], np.cumsum(n_a)])]
        links = np.concatenate([[0], np.cumsum(np.bincount(a_group, minlength=groups) * np.bincount(b_group, minlength=groups))])
        for name, values in zip(self.FIGURES, (n_a, n_b, np.diff(first), links[first[1:]] - links[first[:-1]]), strict=True):
            self.figures[name].add(values)
        self.groups += self.writer(a, b, a_group, b_group, first)
        word, pair, times = linked_pairs(a, b, a_group, b_group, first)
        self.size.add(np.bincount(word, minlength=len(words)))
        self.pairs.add(pair)
        self.links.add(times)
        self.sound.add(sound)
        self.bytes += len(whole)

    def pairs_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How many id pairs each of some words has, the pairs and their links."""
        sizes = self.size.values
        place = _runs((np.cumsum(sizes) - sizes)[words], sizes[words])
        return sizes[words], self.pairs.values[place], self.links.values[place]


def documents_holding(doc: np.ndarray, word: np.ndarray, sizes: np.ndarray, places: np.ndarray, pairs: int) -> np.ndarray:
    """In how many documents each pair comes up, from the different words of each document, by document."""
    starts, size = np.cumsum(sizes) - sizes, sizes[word]
    total, done, low, before = np.zeros(pairs, dtype=np.int64), np.cumsum(size), 0, 0
    ends = np.flatnonzero(np.append(doc[1:] != doc[:-1], True)) + 1 if len(doc) else []
    for k, high in enumerate(ends):
        if k + 1 < len(ends) and done[ends[k + 1] - 1] - before <= ENTRIES:
            continue
        entries = np.repeat(doc[low:high], size[low:high]) * pairs + places[_runs(starts[word[low:high]], size[low:high])]
        entries.sort()
        entries = entries[np.flatnonzero(np.append(True, entries[1:] != entries[:-1]))] if len(entries) else entries
        total += np.bincount(entries % max(1, pairs), minlength=pairs)
        low, before = high, int(done[high - 1])
    return total


#: A row per document, with its different words and their times; and one per chunk (``n_pairs`` not null), with
#: how many pairs its words have, their places in ``pairs`` and links, and in how many documents each pair is held.
_COLUMNS = {
    "chunk": "long", "doc_id": "long", "n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups": "string",
    "count": "long", "members": "binary", "times": "binary", "n_pairs": "long", "sizes": "binary", "pairs": "binary", "held": "binary",
}
_ARROW = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _batch(rows: int, **columns) -> pa.RecordBatch:
    arrays = [pa.array(columns[n], _ARROW[k]) if n in columns else pa.nulls(rows, _ARROW[k]) for n, k in _COLUMNS.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(_COLUMNS))


class _Chunk:
    """Documents as numbers of words, until they are enough to be closed."""

    def __init__(self, words: Words) -> None:
        self.words = words
        self._clear()

    def _clear(self) -> None:
        self.kept, self.rows, self.size, self.docs = [], [], 0, 0

    def add(self, doc_id: pa.Array, data: np.ndarray, offsets: np.ndarray) -> None:
        docs = len(offsets) - 1
        whole = np.insert(data, offsets[:-1], 32)  # a space before each text
        begins = offsets[:-1] + np.arange(docs)
        solid = _SOLID[whole]
        solid[1:] |= (whole[:-1] == 0xC3) & (whole[1:] >= 0x80)  # the letters of Latin-1
        cut = np.zeros(len(whole), dtype=bool)
        cut[1:] = (whole[1:] == 32) & solid[:-1]
        cut[begins[1:] - 1] = cut[-1:] = False  # a last space goes with the word before it
        cut[begins] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(whole))
        doc = np.searchsorted(begins, start, side="right") - 1
        given = (np.diff(offsets) > 0)[doc]
        start, end, doc = start[given], end[given], doc[given]
        word = self.words(whole, start, end)
        sound = np.bincount(doc[~self.words.sound.values[word]], minlength=docs) == 0
        word, doc = word[sound[doc]], doc[sound[doc]]
        cuts = np.searchsorted(doc, np.arange(docs + 1))
        figures = {}
        for name, grown in self.words.figures.items():
            total = np.concatenate([[0], np.cumsum(grown.values[word])])
            figures[name] = total[cuts[1:]] - total[cuts[:-1]]
        groups, numbers = self.words.groups, word.tolist()
        digests = [
            hashlib.sha256(b";".join([groups[w] for w in numbers[x:y]])).hexdigest() if y > x else ""
            for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
        ]
        self.kept.append((word, doc + self.docs))
        self.rows.append((doc_id, {**figures, "groups": digests}))
        self.docs += docs
        self.size += len(data)

    def close(self, chunk: int) -> Iterator[pa.RecordBatch]:
        word, doc = (np.concatenate(x) for x in zip(*self.kept, strict=True))
        used, local = np.unique(word, return_inverse=True)
        sizes, pairs, links = self.words.pairs_of(used)
        pairs, places = np.unique(pairs, return_inverse=True)
        width = max(1, len(used))
        keys, times = _counted(doc * width + local)
        doc, word = np.divmod(keys, width)
        held = documents_holding(doc, word, sizes, places, len(pairs))
        yield _batch(
            1, chunk=[chunk], count=[len(used)], members=[_narrow(places)], times=[_narrow(links)], n_pairs=[len(pairs)],
            sizes=[_narrow(sizes)], pairs=[_narrow(pairs)], held=[_narrow(held)],
        )
        at = 0
        cuts = np.searchsorted(doc, np.arange(self.docs + 1)).tolist()
        for doc_id, columns in self.rows:
            docs = len(doc_id)
            parts = list(zip(cuts[at : at + docs], cuts[at + 1 : at + docs + 1], strict=True))
            yield _batch(
                docs, chunk=np.full(docs, chunk), doc_id=doc_id, **columns, members=[_narrow(word[x:y]) for x, y in parts],
                times=[_narrow(times[x:y]) for x, y in parts], count=[y - x for x, y in parts],
            )
            at += docs
        self._clear()
        if len(self.words.known) > REMEMBERED or self.words.bytes > REMEMBERED_BYTES:
            self.words.forget()


def _describe(docs: DataFrame, a_path: str, b_path: str, chunk_bytes: int) -> DataFrame:
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chunk = _Chunk(Words(a_path, b_path)), TaskContext.get().partitionId() << 32
        for batch in batches:
            for low, high, data, offsets in slices(batch.column(1), SLICE_BYTES):
                held.add(batch.column(0).slice(low, high - low), data, offsets)
                if held.size >= chunk_bytes:
                    yield from held.close(chunk)
                    chunk += 1
        if held.docs:
            yield from held.close(chunk)

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(describe, ", ".join(f"{n} {k}" for n, k in _COLUMNS.items()))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per chunk and pair of its list: in how many of its documents it is linked."""
    for batch in batches:
        for chunk, count, pairs, held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            columns = [pa.array(np.full(count, chunk)), pa.array(_wide(pairs, count)), pa.array(_wide(held, count))]
            yield pa.RecordBatch.from_arrays(columns, names=["chunk", "pair", "held"])


_RESULT = {"doc_id": "long", "n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "n_best": "long", "count_sum": "long", "groups": "string"}


def _score(described: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of a chunk, given the counts of its pairs."""
    is_chunk = described.column("n_pairs").is_valid()
    table, docs = described.filter(is_chunk).to_pylist(), described.filter(pc.invert(is_chunk))
    if not table:
        return pa.table({n: pa.array([], _ARROW[k]) for n, k in _RESULT.items()})
    table = table[0]
    order = np.argsort(counts.column("pair").to_numpy())
    sizes = _wide(table["sizes"], table["count"])
    places, links = (_wide(table[c], int(sizes.sum())) for c in ("members", "times"))
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    scores = []
    for c in ("best", "held"):
        of_pair = counts.column(c).to_numpy()[order].astype(np.int64)
        total = np.concatenate([[0], np.cumsum(of_pair[places] * links)])
        scores.append(total[cuts[1:]] - total[cuts[:-1]])
    out = {n: docs.column(n) for n in _RESULT if n in docs.column_names}
    lists = [docs.column(c).to_pylist() for c in ("members", "times", "count")]
    members, times = (
        np.concatenate([np.zeros(0, np.int64), *(_wide(raw, n) for raw, n in zip(side, lists[2], strict=True))]) for side in lists[:2]
    )
    cuts = np.concatenate([[0], np.cumsum(lists[2])]).astype(np.int64)
    for name, score in zip(("n_best", "count_sum"), scores, strict=True):
        total = np.concatenate([[0], np.cumsum(score[members] * times)])
        out[name] = pa.array(total[cuts[1:]] - total[cuts[:-1]])
    return pa.table([out[n] for n in _RESULT], names=list(_RESULT))


def align_tokens(docs: DataFrame, a_path: str, b_path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """How the tokens of two tokenizers align in every text, and how well the links agree with the corpus.

    A is a byte-level tokenizer file and reads a space and the text, B a sentence-piece model, which puts the space
    itself.  Returns per document doc_id, n_a and n_b (tokens), n_groups, n_links (pairs of tokens that share a group),
    n_best (links whose id pair is linked in as many documents as any of its A id), count_sum (over links: how many
    documents link the pair), and groups, the SHA-256 of ``a1,a2|b1;a3|b2,b3`` in decimal ids.

    Null and empty texts, and texts that the joined bytes of either side do not give back, have no tokens: zeros
    and an empty ``groups``.  Every row is a document, so repeated rows count again; null doc_ids are kept.  An empty
    table gives no rows; other columns are ignored.  A group costs the square of its different ids, and a
    task remembers some 100,000 words and one chunk.
    """
    described = write_table(_describe(docs, a_path, b_path, chunk_bytes), "token-words")
    # A row per chunk and different pair, not per link or document.
    lists = described.where("n_pairs IS NOT NULL").select("chunk", "n_pairs", "pairs", "held")
    named = lists.mapInArrow(_pairs, "chunk long, pair long, held long")
    counts = named.groupBy("pair").agg(F.sum("held").alias("held"))
    counts = write_table(counts.withColumn("a", F.shiftrightunsigned("pair", 32)), "pair-counts")
    # One A id has at most a row per B id here.
    most = counts.groupBy("a").agg(F.max("held").alias("most"))
    counts = counts.join(most, "a").select("pair", "held", (F.col("held") == F.col("most")).alias("best"))
    back = named.select("chunk", "pair").join(counts, "pair")
    scored = described.groupBy("chunk").cogroup(back.groupBy("chunk"))
    return scored.applyInArrow(_score, ", ".join(f"{n} {k}" for n, k in _RESULT.items()))
