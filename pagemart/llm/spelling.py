"""Spelling variants: words one edit apart, found by range searches over letter counts.

A word is a point: how often it has each letter. One edit moves a point by at most one up and one down, so near
words lie within an L1 distance of two. Words are searched by pairs of lengths: equal lengths, and a length with
the next. For each length a k-d tree over a bounded sample of its words cuts the points into cells; a word is stored in the
cell of its point and asked for in every cell whose box its reach meets. In a task a finer k-d tree over the cell's
points passes whole sets of questions down, dropping those out of reach of a box; at a leaf the order of the letters decides.
The sample sets only where the cuts are; every word is stored and asked for.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemart.llm.base import query, slices, table
from pagemart.session import discard, materialise

#: Letters A-Z, a-z and U+00C0 to U+00FF, as bytes of UTF-8 after A-Z are lower-cased.
RUN, BREAK = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+"), re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]")
MIN_CHARS, MIN_COUNT, FORM_TIMES, NOISE = 5, 3, 2, 97
PART, HELD = 1 << 20, 400_000
#: Words a cell is to hold, words of a block of a cell that is far larger, and words that the cuts are drawn from.
CELL, BLOCK, SAMPLE = 20_000, 60_000, 40_000
LEAF = 32
#: a to z have a number each; the letters beyond share the rest, which never moves two near words further apart.
SIZE = 32
EQUAL, LONGER = 0, 1


def parts(text: bytes, most: int) -> Iterator[bytes]:
    """The text in parts that cut no run."""
    begin = 0
    while len(text) - begin > most:
        cut = BREAK.search(text, begin + most)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:]


def without_noise(run: bytes, seed: int, noise: int) -> bytes:
    """The run, less one letter if its checksum with the document's is a multiple of ``noise``."""
    h = zlib.crc32(run, seed)
    if h % noise:
        return run
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def word_counts(
    docs: DataFrame, id_col: str, text_col: str, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, noise: int = NOISE,
    part: int = PART, held: int = HELD,
) -> DataFrame:
    """(word, n) of the words with enough letters that occur often enough in all texts together."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}

        def handed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(counts, pa.binary()).cast(pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"]
            )

        for batch in slices(batches, "text"):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                seed, before = zlib.crc32(f"{doc}:".encode()), counts.get
                for piece in parts(text or b"", part):
                    for word, n in Counter(RUN.findall(piece.lower())).items():
                        word = without_noise(word, seed, noise)
                        if len(word) >= min_chars and (word.isascii() or len(word.decode()) >= min_chars):
                            counts[word] = before(word, 0) + n
                    if len(counts) > held:
                        yield handed()
                        counts.clear()
        yield handed()

    found = rows.mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def points(words: list[bytes]) -> np.ndarray:
    """One row a word (in Latin-1): how often it has each letter, up to 255."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    place = np.where(letters >= 0xC0, 26 + letters % (SIZE - 26), letters - ord("a"))
    flat = np.bincount(np.repeat(np.arange(len(words)), sizes) * SIZE + place, minlength=len(words) * SIZE)
    return np.minimum(flat, 255).astype(np.uint8).reshape(-1, SIZE)


class Cuts:
    """A k-d tree of halving cuts: ``count <= bound`` of one letter to the left, the rest to the right."""

    def __init__(self, sample: np.ndarray, most: int):
        self.nodes: list[tuple[int, int, int, int]] = []  # letter, bound, left, right; a leaf has letter -1 and its number
        self.members: list[np.ndarray] = []
        self._grow(sample, np.arange(len(sample)), most)

    def _grow(self, sample: np.ndarray, rows: np.ndarray, most: int) -> int:
        at = len(self.nodes)
        self.nodes.append((-1, len(self.members), 0, 0))
        cut = self._best(sample[rows]) if len(rows) > most else None
        if cut is None:
            self.members.append(rows)
            return at
        letter, bound = cut
        low = sample[rows, letter] <= bound
        left = self._grow(sample, rows[low], most)
        self.nodes[at] = (letter, bound, left, self._grow(sample, rows[~low], most))
        return at

    @staticmethod
    def _best(some: np.ndarray) -> tuple[int, int] | None:
        """The cut nearest to halving the rows; None if all are equal."""
        best, found = len(some) // 2 + 1, None
        for bound in range(4):
            low = (some <= bound).sum(axis=0)
            off = np.where((low > 0) & (low < len(some)), np.abs(low - len(some) / 2), np.inf)
            letter = int(off.argmin())
            if off[letter] < best:
                best, found = off[letter], (letter, bound)
        if found is None and (spread := some.max(axis=0) - some.min(axis=0)).any():
            letter = int(spread.argmax())
            found = letter, int(np.sort(some[:, letter])[(len(some) - 1) // 2])
            if found[1] == some[:, letter].max():
                found = letter, found[1] - 1
        return found

    def reached(self, asked: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of ``asked``) for each leaf whose box lies within ``up`` steps up and ``down`` steps down, 0 or 1 each."""
        n = len(asked)
        stack = [(0, np.arange(n), np.full(n, up, np.int16), np.full(n, down, np.int16))]
        while stack:
            node, rows, ups, downs = stack.pop()
            if not len(rows):
                continue
            letter, bound, left, right = self.nodes[node]
            if letter < 0:
                yield bound, rows
                continue
            over = asked[rows, letter].astype(np.int16) - bound
            to_left = downs - np.maximum(over, 0)
            keep = to_left >= 0
            stack.append((left, rows[keep], ups[keep], to_left[keep]))
            to_right = ups - np.maximum(1 - over, 0)
            keep = to_right >= 0
            stack.append((right, rows[keep], to_right[keep], downs[keep]))


def signatures(some: np.ndarray) -> np.ndarray:
    """64 bits a point: whether each letter occurs, and whether twice. One step changes one bit at most."""
    bits = np.concatenate([some > 0, some > 1], axis=1)
    return np.packbits(bits, axis=1).view(np.uint64)[:, 0]


def in_reach(asked: np.ndarray, stored: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The (asked, stored) places whose signatures are at most ``most`` bits apart, in parts of bounded size."""
    step = max(1, (1 << 19) // max(1, len(stored)))
    for at in range(0, len(asked), step):
        a, b = np.nonzero(np.bitwise_count(asked[at : at + step, None] ^ stored[None]) <= most)
        yield a + at, b


def one_edit(asked: np.ndarray, stored: np.ndarray) -> np.ndarray:
    """Whether rows are one replaced letter apart, or one letter that only ``asked`` has, by the order of the letters."""
    length = stored.shape[1]
    near = np.zeros(len(asked), bool)
    step = max(1, (1 << 21) // max(1, length))
    for at in range(0, len(asked), step):
        some, own = asked[at : at + step], stored[at : at + step]
        if asked.shape[1] == length:
            near[at : at + step] = (some != own).sum(axis=1) == 1
        else:
            front, back = some[:, :-1] != own, (some[:, 1:] != own)[:, ::-1]
            front = np.where(front.any(axis=1), front.argmax(axis=1), length)
            back = np.where(back.any(axis=1), back.argmax(axis=1), length)
            near[at : at + step] = front + back >= length
    return near


def cell_links(rows: pa.Table) -> pa.Table:
    """(word, n_near, best): of a cell's rows (role, word, n, stored), what each word's near words in it are."""
    words = [w.encode("latin-1") for w in rows["word"].to_pylist()]
    n, role = rows["n"].to_numpy(), rows["role"].to_numpy()
    is_stored = rows["stored"].to_numpy(zero_copy_only=False)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    held = np.flatnonzero(is_stored)
    pairs = []
    if len(held):
        length = int(sizes[held[0]])
        letters = lambda at, size: np.frombuffer(b"".join(words[i] for i in at), np.uint8).reshape(-1, size)
        stored = letters(held, length)
        at_stored = points([words[i] for i in held])
        cuts, signs = Cuts(at_stored, LEAF), signatures(at_stored)
        for kind, up in ((EQUAL, 1), (LONGER, 0)):
            at = np.flatnonzero(~is_stored & (role == kind))
            if not len(at):
                continue
            asked, at_asked = letters(at, length + kind), points([words[i] for i in at])
            own_signs = signatures(at_asked)
            for leaf, some in cuts.reached(at_asked, up, 1):
                own = cuts.members[leaf]
                for a, b in in_reach(own_signs[some], signs[own], 1 + up):
                    a, b = some[a], own[b]
                    near = one_edit(asked[a], stored[b])
                    a, b = at[a[near]], held[b[near]]
                    pairs.append((a, b))
                    if kind == LONGER:  # words of equal length ask for each other, these do not
                        pairs.append((b, a))
    a = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, np.int64)
    b = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, np.int64)
    by_word = np.argsort(np.argsort(np.array(words, object), kind="stable"))
    order = np.lexsort((by_word[b], -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.diff(a, prepend=-1))
    best = pa.StructArray.from_arrays(
        [pa.array(-n[b[first]]), rows["word"].combine_chunks().take(pa.array(b[first]))], ["less", "word"]
    )
    return pa.table({"word": rows["word"].take(pa.array(a[first])), "n_near": pa.array(np.diff(np.append(first, len(a)))), "best": best})


def cell_rows(words: DataFrame, cuts: dict[int, Cuts]) -> DataFrame:
    """(size, cell, role, stored, word, n): each word where it is stored, and wherever it is asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "word", 200_000):
            texts = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            at_all = points(texts)
            for size in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == size)
                for target, role, stored, up, down in ((size, EQUAL, True, 0, 0), (size, EQUAL, False, 1, 1), (size - 1, LONGER, False, 0, 1)):
                    tree = cuts.get(target)
                    for cell, rows in tree.reached(at_all[own], up, down) if tree else ((0, np.arange(len(own))),):
                        some, k = batch.take(pa.array(own[rows])), len(rows)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(k, target)), pa.array(np.full(k, cell)), pa.array(np.full(k, role)), pa.array(np.full(k, stored)), some.column(0), some.column(1)],
                            names=["size", "cell", "role", "stored", "word", "n"],
                        )

    return words.mapInArrow(run, "size long, cell long, role long, stored boolean, word string, n long")


def cuts_of(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> dict[int, Cuts]:
    """The cuts for each length that has more words than a cell; from at most ``2 * sample`` words, chosen by their hash."""
    sizes = {r["size"]: r["count"] for r in words.groupBy(F.length("word").alias("size")).count().where(F.col("count") > cell).collect()}
    if not sizes:
        return {}
    total, out = sum(sizes.values()), {}
    chosen = words.where(F.length("word").isin(list(sizes)) & (F.pmod(F.xxhash64("word", F.lit(5)), F.lit(1 << 30)) < int(min(1.0, sample / total) * (1 << 30))))
    drawn = [r.word.encode("latin-1") for r in chosen.select("word").limit(2 * sample).collect()]
    for size, count in sizes.items():
        own = [w for w in drawn if len(w) == size]
        if own:
            out[size] = Cuts(points(own), max(4, len(own) * cell // count))
            out[size].members.clear()
    return out


def near_words(words: DataFrame, cell: int = CELL, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """(word, n_near, best) of the words that have a near word; ``best`` is that of largest n, then the smallest."""
    rows = materialise(cell_rows(words, cuts_of(words, cell, sample)), "cells")
    # A cell far over its size, as of very many words with the same letters, is cut into blocks on both sides.
    sizes = rows.groupBy("size", "cell").agg(F.count(F.when(F.col("stored"), 1)).alias("n_stored"), F.count(F.when(~F.col("stored"), 1)).alias("n_asked"))
    count = lambda c, most: F.greatest(F.lit(1), F.ceil(F.col(c) / most)).cast("long")
    sizes = sizes.select("size", "cell", count("n_stored", block).alias("stores"), count("n_asked", 10 * block).alias("asks"))
    own = lambda c: F.pmod(F.xxhash64("word"), c)
    upto = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    dealt = rows.join(sizes, ["size", "cell"]).withColumn("store", F.explode(F.when(F.col("stored"), F.array(own("stores"))).otherwise(upto("stores"))))
    dealt = dealt.withColumn("ask", F.explode(F.when(F.col("stored"), upto("asks")).otherwise(F.array(own("asks")))))
    dealt = dealt.select("size", "cell", "store", "ask", "role", "stored", "word", "n")
    links = dealt.groupBy("size", "cell", "store", "ask").applyInArrow(cell_links, "word string, n_near long, best struct<less: long, word: string>")
    return links.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
    times: int = FORM_TIMES, noise: int = NOISE, cell: int = CELL, block: int = BLOCK, sample: int = SAMPLE, part: int = PART, held: int = HELD,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n): each frequent word with the spelling it is most likely a variant of.

    Words are runs of letters with A-Z lower-cased; by a checksum of id and run one run in ``noise`` lacks a letter. The form is
    the near word of largest n (ties: the smallest) if it has at least ``times`` (2 or more) as many occurrences; the root is
    where forms lead. A null text has no words, a null id counts as '', repeated rows are counted each. An empty table
    gives no rows; other columns are not read, whatever their names.
    """
    words = materialise(word_counts(docs, id_col, text_col, min_chars, min_count, noise, part, held), "words")
    near = near_words(words, cell, block, sample)
    form_n = F.when(-F.col("best.less") >= times * F.col("n"), -F.col("best.less"))
    found = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form_n.alias("form_n"),
        F.when(form_n.isNotNull(), F.col("best.word")).alias("form"),
    )
    found = materialise(found, "forms")
    # Each round doubles how far ``root`` looks; a form has twice its word's n, so chains have under 64 steps.
    open_rows, done = found.where("form is not null").select("word", F.col("form").alias("root")), []
    for _ in range(8):
        ahead = open_rows.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialise(open_rows.join(ahead, "root", "left").select("word", "root", "next"), "roots")
        done.append(moved.where("next is null").select("word", "root"))
        steps = moved.where("next is not null")
        if steps.isEmpty():
            break
        # Words already at their root stay in the table that others look up.
        open_rows = moved.select("word", F.coalesce("next", "root").alias("root"))
    else:
        raise RuntimeError("forms do not end")
    return found.join(done[-1], "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


@query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
