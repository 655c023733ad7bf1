"""Splitting texts into pre-tokens for byte-level BPE, for many texts at once in numpy.

The rule is that of ``public_tokenizers.PATTERN``: contractions, runs of letters, of numbers and of other
signs, each with at most one blank before it, and white space. Every place of a text belongs to one
pre-token, so a split is a set of start places, found by comparing neighbouring character classes.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import numpy as np

from pagemart.llm.base import once
from pagemart.llm.quality import STEP, STEP_INVERSE, mixed, powers

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: Texts of more code points are split in parts, so that the arrays of a worker stay small.
LONG = 500_000
#: The code points with Unicode's White_Space property.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _classes() -> np.ndarray:
    kinds, table = {"L": LETTER, "N": NUMBER}, np.zeros(0x110000, np.uint8)  # OTHER
    # Planes 4 to 16 have no letters and no numbers: they are empty, or hold tags, variants and private signs.
    table[:0x40000] = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x40000)), np.uint8, 0x40000)
    table[WHITE] = SPACE
    return table


def classes() -> np.ndarray:
    return once("classes", _classes)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def starts(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The places where pre-tokens start; ``firsts`` are the places where texts start."""
    kinds = classes()[points]
    new_text = np.zeros(len(points), bool)
    new_text[firsts[firsts < len(points)]] = True
    begin = new_text.copy()
    begin[1:] |= kinds[1:] != kinds[:-1]
    inner, white = ~new_text[1:], kinds == SPACE
    start = begin.copy()
    start[:-1] |= white[:-1] & ~white[1:] & inner  # the last blank before a word
    start[1:] &= ~(begin[1:] & ~white[1:] & (points[:-1] == 0x20) & inner)  # taken by the blank before

    quotes = np.flatnonzero(start & (points == 0x27))
    padded = np.concatenate([points, np.zeros(2, points.dtype)])
    ends_text = np.concatenate([new_text, np.ones(2, bool)])
    one, two = padded[quotes + 1], padded[quotes + 2]
    near, far = ~ends_text[quotes + 1], ~ends_text[quotes + 2]
    short = near & np.isin(one, [ord(c) for c in "stmd"])
    long = near & far & (
        ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    )
    start[quotes[short | long] + 1] = False
    after = np.concatenate([quotes[short] + 2, quotes[long] + 3])
    start[after[after < len(points)]] = True
    return np.flatnonzero(start)


def span_keys(points: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each span of code points. Different spans may have the same: compare them, too."""
    values = once("point values", lambda: mixed(np.arange(0x110000)))
    prefix = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(values[points] * powers(STEP, len(points)), out=prefix[1:])
    return (prefix[ends] - prefix[begins]) * powers(STEP_INVERSE, len(points) + 1)[begins]


def key_of(text: str) -> int:
    points = code_points(text)
    return int(span_keys(points, np.array([0]), np.array([len(points)]))[0])


def cut_long(text: str, most: int = LONG) -> Iterator[str]:
    """Parts of a long text that split as the whole does: cut where white space follows another sign."""
    begin = 0
    while len(text) - begin > most:
        at = text.find(" ", begin + most)
        while at != -1 and (at == begin or classes()[ord(text[at - 1])] == SPACE):
            at = text.find(" ", at + 1)
        if at == -1:
            break
        yield text[begin:at]
        begin = at
    yield text[begin:]


def same_spans(
    points: np.ndarray, begins: np.ndarray, sizes: np.ndarray, pool: np.ndarray, offsets: np.ndarray, lengths: np.ndarray
) -> np.ndarray:
    """Whether each span of ``points`` is, sign by sign, the span of ``pool`` given beside it. Spans are not empty."""
    same = sizes == lengths
    rows = np.flatnonzero(same)
    if len(rows):
        size = sizes[rows]
        firsts = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(firsts, size)
        differ = points[place + np.repeat(begins[rows], size)] != pool[place + np.repeat(offsets[rows], size)]
        same[rows] = ~np.logical_or.reduceat(differ, firsts)
    return same


class PieceMemory:
    """Ids of pre-tokens met before: a direct-mapped table of fixed size, so memory stays bounded.

    A slot has the pre-token itself beside its key, and a hit is one only if the signs are the same. Pre-tokens of more
    than ``longest`` signs are not held; they are spelt anew.
    """

    def __init__(self, slots: int = 1 << 19, ids: int = 1 << 21, longest: int = 128):
        self.shift, self.most, self.longest = np.uint64(64 - slots.bit_length() + 1), ids, longest
        self.keys = np.zeros(slots, np.uint64)
        self.offsets, self.lengths = np.zeros(slots, np.int64), np.zeros(slots, np.int32)
        self.places, self.sizes = np.zeros(slots, np.int64), np.zeros(slots, np.int32)
        self.ids, self.points = np.zeros(0, np.int32), np.zeros(0, np.uint32)

    def look_up(
        self, keys: np.ndarray, points: np.ndarray, begins: np.ndarray, ends: np.ndarray,
        spell: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]],
    ) -> tuple[np.ndarray, np.ndarray]:
        """(offset, length) into ``ids`` for each span; ``spell`` gives the ids of spans not held, by
        their place: all ids one after another, and how many are of each span."""
        if len(self.ids) > self.most or len(self.points) > 2 * self.most:
            self.sizes[:], self.ids, self.points = 0, np.zeros(0, np.int32), np.zeros(0, np.uint32)
        slots, sizes = (keys >> self.shift).astype(np.int64), ends - begins
        offsets, lengths = self.offsets[slots], self.lengths[slots].astype(np.int64)
        held = self.keys[slots] == keys
        at = np.flatnonzero(held)
        held[at] = same_spans(points, begins[at], sizes[at], self.points, self.places[slots[at]], self.sizes[slots[at]])
        unknown = np.flatnonzero(~held)
        if len(unknown):
            new, first, back = np.unique(keys[unknown], return_index=True, return_inverse=True)
            first = unknown[first]
            like = first[back]
            odd = unknown[~same_spans(points, begins[unknown], sizes[unknown], points, begins[like], sizes[like])]
            spelt, counts = spell(np.concatenate([first, odd]))
            starts_at = len(self.ids) + np.cumsum(counts) - counts
            self.ids = np.concatenate([self.ids, spelt])
            offsets[unknown], lengths[unknown] = starts_at[back], counts[back]
            offsets[odd], lengths[odd] = starts_at[len(new) :], counts[len(new) :]
            keep = np.flatnonzero(sizes[first] <= self.longest)
            words, bounds = gathered(points, begins[first[keep]], sizes[first[keep]])
            slots = (new[keep] >> self.shift).astype(np.int64)
            self.keys[slots], self.offsets[slots], self.lengths[slots] = new[keep], starts_at[keep], counts[keep]
            self.places[slots], self.sizes[slots] = len(self.points) + bounds[:-1], sizes[first[keep]]
            self.points = np.concatenate([self.points, words])
        return offsets, lengths


def gathered(pool: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pool's runs one after another, and where each begins (one more entry: the end)."""
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    return pool[np.repeat(offsets - bounds[:-1], lengths) + np.arange(bounds[-1])], bounds
