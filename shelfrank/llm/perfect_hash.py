"""A minimal perfect hash of distinct 64-bit keys: n keys to the numbers 0 to n - 1, about 3 bits a key.

Level by level the keys left are thrown into twice as many bits.  A key alone in its bit is settled there, the
others go on to the next level.  The number of a key is the rank of its bit, so a look-up takes one or two probes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from shelfrank.llm.text import mix64

SPREAD = 2
_U = np.uint64


def _thrown(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    salt = mix64(np.array([level + 1], dtype=np.uint64))[0]
    return mix64(keys ^ salt) % _U(bits)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    """32 bits of each key that say nothing about its place."""
    return (mix64(keys ^ _U(0xA5A5_5A5A_0F0F_F0F0)) >> _U(32)).astype(np.uint32)


@dataclass(frozen=True)
class PerfectHash:
    """``starts`` are the levels' first bits and the end; ``before`` counts the bits set before each word."""

    starts: np.ndarray
    words: np.ndarray
    before: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """Of distinct keys as unsigned 64-bit numbers; equal keys never part, so they are refused."""
        left = keys.astype(np.uint64)
        if len(np.unique(left)) < len(left):
            raise ValueError("keys are repeated")
        starts, levels = [0], []
        while len(left):
            bits = -(-max(64, SPREAD * len(left)) // 64) * 64
            place = _thrown(left, len(levels), bits)
            alone = np.bincount(place, minlength=bits) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            starts.append(starts[-1] + bits)
            left = left[~alone[place]]
        words = np.concatenate(levels) if levels else np.zeros(0, "<u8")
        return cls.of(np.array(starts, dtype=np.int64), words)

    @classmethod
    def of(cls, starts: np.ndarray, words: np.ndarray) -> PerfectHash:
        counts = np.bitwise_count(words).astype(np.int64)
        return cls(starts, words, np.cumsum(counts) - counts)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key.  A key that was not built in gets any number or -1."""
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level in range(len(self.starts) - 1):
            if not len(left):
                break
            first, end = int(self.starts[level]), int(self.starts[level + 1])
            bit = _thrown(keys[left], level, end - first).astype(np.int64) + first
            word, shift = self.words[bit >> 6], (bit & 63).astype(np.uint64)
            found = (word >> shift) & _U(1) == 1
            lower = word & ((_U(1) << shift) - _U(1))
            rank = self.before[bit >> 6] + np.bitwise_count(lower).astype(np.int64)
            out[left[found]] = rank[found]
            left = left[~found]
        return out
