"""A minimal perfect hash in numpy: bit levels, each keeping the keys that met no other key there."""

from __future__ import annotations

import io

import numpy as np

from pagemart.llm.quality import mixed

SPREAD = 2.0
LEVEL = np.uint64(0xD6E8FEB86659FD93)


def _places(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        step = LEVEL * np.uint64(level + 1)
        return (mixed(high ^ step) + mixed(low + step)) % np.uint64(size)


class MinimalPerfectHash:
    """Distinct 128-bit keys, given as two arrays of 64 bits, to the numbers 0 … n - 1.

    About four bits a key. A key that was not given gets -1 or any number, so a caller that may hold
    such keys compares a stored fingerprint.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, before = [], 0
        for words in levels:
            counts = np.bitwise_count(words).astype(np.int64)
            self.ranks.append(before + np.cumsum(counts) - counts)
            before += int(counts.sum())
        self.size = before

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> MinimalPerfectHash:
        levels: list[np.ndarray] = []
        while len(high):
            if len(levels) == 200:
                raise ValueError("the keys are not distinct")
            size = 64 * max(1, int(np.ceil(SPREAD * len(high) / 64)))
            at = _places(high, low, len(levels), size)
            alone = np.bincount(at.astype(np.int64), minlength=size)[at] == 1
            marks = np.zeros(size, np.uint8)
            marks[at[alone]] = 1
            levels.append(np.packbits(marks, bitorder="little").view("<u8"))
            high, low = high[~alone], low[~alone]
        return cls(levels)

    def find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        found = np.full(len(high), -1, np.int64)
        open_rows = np.arange(len(high))
        for level, (words, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            if not len(open_rows):
                break
            at = _places(high[open_rows], low[open_rows], level, 64 * len(words))
            word, bit = (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
            held = words[word]
            here = (held & bit) != 0
            found[open_rows[here]] = ranks[word[here]] + np.bitwise_count(held[here] & (bit[here] - np.uint64(1)))
            open_rows = open_rows[~here]
        return found

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, *self.levels)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, stored: bytes) -> MinimalPerfectHash:
        with np.load(io.BytesIO(stored)) as arrays:
            return cls([arrays[f"arr_{k}"] for k in range(len(arrays.files))])
