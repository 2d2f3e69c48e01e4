"""Token ids of whole texts by a public tokenizer that splits at white space.

Texts consist of far fewer different pieces than pieces, so each piece is encoded once and looked
up afterwards.  A piece is a run of letters, a digit, or a run of other signs, where the tokenizer's
own splitting is certain to cut there too; any other word goes to the tokenizer as it is.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

from shelfrank.llm.text import LOWER, SPACE, SpanHasher, word_spans

#: Pieces remembered by a task; beyond that it starts afresh, so memory is bounded.
REMEMBERED = 500_000

_LETTER, _DIGIT, _SIGN, _OTHER = 1, 2, 3, 4
_KIND = np.full(256, _OTHER, dtype=np.uint8)
_KIND[33:127] = _SIGN
_KIND[48:58] = _DIGIT
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[39] = _OTHER  # the apostrophe starts contractions


class Encoder:
    """Encodes slices of texts; one per task, as it keeps what it has seen."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.as_letters = ByteLevel(add_prefix_space=False, use_regex=False)
        self.hasher = SpanHasher()
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.parts: list[np.ndarray] = []
        self.ids = np.zeros(0, np.uint16)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)

    def _pieces(self, data: np.ndarray, offsets: np.ndarray):
        """Lower-cased bytes, piece starts, ends and documents, and which pieces are plain."""
        start, end, doc = word_spans(data, offsets)
        kind = _KIND[data]
        # The letters of Latin-1 beyond ASCII, two bytes each.
        pair = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0xBF) & ((data[1:] & 0xDF) != 0x97))
        kind[pair] = kind[pair + 1] = _LETTER
        kind[1:][(data[1:] == 124) & (data[:-1] == 60)] = _OTHER  # "<|" may open a special token
        inside = ~SPACE[data]
        word = np.cumsum(np.bincount(start, minlength=len(data))) - 1
        odd = np.bincount(word[inside & (kind == _OTHER)], minlength=len(start)) > 0
        odd_byte = inside & odd[np.maximum(word, 0)]
        kind[odd_byte] = _OTHER
        low = np.where(odd_byte, data, LOWER[data])
        begins = np.zeros(len(data), dtype=bool)
        begins[start] = True
        begins[1:] |= inside[1:] & inside[:-1] & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)) & (word[1:] == word[:-1])
        first = np.flatnonzero(begins)
        own = word[first]
        last = np.minimum(np.concatenate([first[1:], [len(data)]]), end[own])
        return low, first, last, doc[own], ~odd[own]

    def _encode(self, pieces: list[bytes], plain: np.ndarray) -> list[np.ndarray]:
        model, out = self.tokenizer.model, [None] * len(pieces)
        whole = []
        for i, piece in enumerate(pieces):
            if not plain[i]:
                whole.append(i)
                continue
            text = piece.decode()
            if not piece.isascii():
                text = "".join(x for x, _ in self.as_letters.pre_tokenize_str(text.lower()))
            out[i] = [t.id for t in model.tokenize(text)]
        if whole:
            texts = [pieces[i].decode("utf-8", "replace") for i in whole]
            for i, found in zip(whole, self.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
                out[i] = found.ids
        return out

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice as 16-bit numbers, and how many each document has."""
        docs = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.uint16), np.zeros(docs, np.int64)
        low, first, last, doc, plain = self._pieces(data, offsets)
        if not len(first):
            return np.zeros(0, np.uint16), np.zeros(docs, np.int64)
        codes, keys = pd.factorize(self.hasher(low, first, last))
        if len(self.known) > REMEMBERED:
            self._forget()
        number = np.array([self.known.get(k, -1) for k in keys.tolist()], dtype=np.int64)
        new = np.flatnonzero(number < 0)
        if len(new):
            at = np.empty(len(keys), dtype=np.int64)
            at[codes[::-1]] = np.arange(len(codes))[::-1]
            text = low.tobytes()
            found = self._encode([text[first[i] : last[i]] for i in at[new]], plain[at[new]])
            number[new] = len(self.sizes) + np.arange(len(new))
            self.known.update(zip(keys[new].tolist(), number[new].tolist(), strict=True))
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.ids = np.concatenate([self.ids, np.fromiter((i for x in found for i in x), np.uint16, int(sizes.sum()))])
        which = number[codes]
        sizes = self.sizes[which]
        ends = np.cumsum(sizes)
        place = np.arange(ends[-1]) + np.repeat(self.starts[which] - (ends - sizes), sizes)
        return self.ids[place], np.bincount(doc, weights=sizes, minlength=docs).astype(np.int64)
