"""Packing documents into training sequences of one length.

Documents are tokenised once, on the executors, and cut into full windows and a rest. The pieces, without
their ids, are dealt at random into groups of a set size; inside a group first-fit decreasing places
them, with a tournament tree over the room left in the bins, so each piece finds the first bin that takes
it in a logarithmic number of steps. A group's size bounds the memory of a task; more groups need more tasks.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from pagemart.llm.base import once, query, slices, table, text_kept
from pagemart.llm.pretokens import LONG, PieceMemory, code_points, cut_long, gathered, span_keys, starts
from pagemart.session import materialise

WINDOW = 2048
GROUP = 8192


def _byte_signs() -> np.ndarray:
    """The sign that stands for each byte in a byte-level vocabulary: itself where it can be printed, else one from 256 on."""
    signs = np.sort(np.fromiter(map(ord, pre_tokenizers.ByteLevel.alphabet()), np.uint32))
    table = np.arange(256, dtype="<u4")
    table[~np.isin(table, signs)] = signs[signs > 255]
    return table


class Vocabulary:
    """A tokenizer file with byte-level splitting; pre-tokens met before are not encoded again."""

    def __init__(self, path: str):
        # A task has one core: threads of the library's own would only take turns on it.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        tokenizer = Tokenizer.from_file(path)
        self.special = {str(t): i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.normalizer = tokenizer.normalizer
        # Pre-tokens are handed over as signs of their bytes with blanks between, which are no such signs: one call for many.
        self.tokenizer = Tokenizer(tokenizer.model)
        self.tokenizer.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.signs = _byte_signs()
        vocabulary = tokenizer.get_vocab(with_added_tokens=False)
        self.sizes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        if all(chr(sign) in vocabulary for sign in self.signs):  # else some bytes have no id of their own
            self.sizes[list(vocabulary.values())] = list(map(len, vocabulary))
        self.memory = PieceMemory()

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text, as the tokenizer gives them without special tokens added."""
        parts, begin = [], 0
        while self.special:
            near = min(((at, s) for s in self.special if (at := text.find(s, begin)) >= 0), default=None)
            if near is None:
                break
            parts += [*map(self._plain, cut_long(text[begin : near[0]])), np.array([self.special[near[1]]], np.int32)]
            begin = near[0] + len(near[1])
        parts += map(self._plain, cut_long(text[begin:]))
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def _plain(self, text: str) -> np.ndarray:
        return self.together([text])[0]

    def together(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of several texts that hold no special token and are not long."""
        if self.normalizer is not None:
            texts = [self.normalizer.normalize_str(t) for t in texts]
        joined = "".join(texts)
        points = code_points(joined)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        firsts = np.cumsum(sizes) - sizes
        begins = starts(points, firsts)
        ends = np.append(begins[1:], len(points))
        keys = span_keys(points, begins, ends)

        def spell(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            words, bounds = gathered(points, begins[rows], ends[rows] - begins[rows])
            raw = np.frombuffer(words.tobytes().decode("utf-32-le").encode(), np.uint8)
            at = np.flatnonzero(raw & 0xC0 != 0x80)[bounds[1:-1]]  # the first byte of each word after the first
            signs = np.insert(self.signs[raw], at, 0x20).tobytes().decode("utf-32-le")
            ids = np.array(self.tokenizer.encode_batch_fast([signs], add_special_tokens=False)[0].ids, np.int32)
            ends_at = np.cumsum(self.sizes[ids])
            if len(ids) and ends_at[-1] == len(raw):
                return ids, np.diff(np.searchsorted(ends_at, np.append(at, len(raw)), "right"), prepend=0)
            # Pieces are not the bytes they stand for: the library tells which word each is of.
            found = self.tokenizer.encode(signs, add_special_tokens=False)
            return np.array(found.ids, np.int32), np.bincount(np.array(found.word_ids, np.int64), minlength=len(rows))

        offsets, lengths = self.memory.look_up(keys, points, begins, ends, spell)
        ids, bounds = gathered(self.memory.ids, offsets, lengths)
        cuts = np.append(bounds[np.searchsorted(begins, firsts)], len(ids))
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def encode_each(self, texts: list[str]) -> Iterator[np.ndarray]:
        plain = [t for t in texts if len(t) <= LONG and not any(s in t for s in self.special)]
        done = iter(self.together(plain))
        for t in texts:
            yield next(done) if len(t) <= LONG and not any(s in t for s in self.special) else self.encode(t)


def _vocabulary(path: str) -> Vocabulary:
    return once(("vocabulary", path), lambda: Vocabulary(path))


PIECES_DDL = "start long, length long, ids_crc32 long, doc_tokens long, salt long"


def token_pieces(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = 1,
    with_ids: bool = False,
) -> DataFrame:
    """Each document's ids and ``end_id``, cut every ``window`` ids: one row per piece, with the ids if asked for.

    ``salt`` numbers the pieces of a task in a mixed order; it deals repeated rows apart later.
    """
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            rows, columns = [], [[], [], [], [], []]
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for row, ids in enumerate(_vocabulary(path).encode_each(texts)):
                ids = np.append(ids, end_id).astype("<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    rows.append(row)
                    values = (start, len(piece), zlib.crc32(piece.tobytes()), len(ids), piece.astype(np.int32) if with_ids else None)
                    for column, value in zip(columns, values, strict=True):
                        column.append(value)
            salt = np.random.default_rng(zlib.crc32(repr(columns[2][:64]).encode())).integers(0, 1 << 62, len(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(salt, pa.int64()),
                 *([pa.array(columns[4], pa.list_(pa.int32()))] if with_ids else [])],
                names=[id_col, "start", "length", "ids_crc32", "doc_tokens", "salt", *(["ids"] if with_ids else [])],
            )

    return text_kept(docs.select(id_col, text_col), text_col).mapInArrow(
        run, f"`{id_col}` {kind}, {PIECES_DDL}" + ", ids array<int>" * with_ids
    )


def first_fit(lengths: list[int], room: int) -> list[int]:
    """The bin of each length, in the given order: the first bin with room enough.

    A tournament tree holds the room left in each bin, and in each inner node the most below it.
    """
    leaves = 1
    while leaves < len(lengths):
        leaves *= 2
    most = [room] * (2 * leaves)
    bins = []
    for length in lengths:
        node = 1
        while node < leaves:
            node *= 2
            node += most[node] < length
        bins.append(node - leaves)
        most[node] -= length
        while node > 1:
            node //= 2
            left, right = most[2 * node], most[2 * node + 1]
            best = left if left >= right else right
            if most[node] == best:
                break
            most[node] = best
    return bins


def packed(pieces: DataFrame, id_col: str = "doc_id", window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to the rows of ``token_pieces``, which should be a written table.

    Groups hold about ``group`` pieces. Ties in length go by id, start and checksum; equal rows are interchangeable.
    """
    groups = -(-pieces.count() // group) or 1
    dealt = pieces.withColumn("group_no", F.pmod(F.xxhash64(id_col, "start", "salt"), F.lit(groups)))
    out = [f for f in pieces.schema.fields if f.name != "salt"]

    def place(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), (id_col, "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        filled: dict[int, int] = {}
        lengths, offsets = rows["length"].to_pylist(), []
        bins = first_fit(lengths, window)
        for at, length in zip(bins, lengths, strict=True):
            offsets.append(filled.get(at, 0))
            filled[at] = offsets[-1] + length
        first = rows["group_no"][0].as_py() << 32
        placed = rows.select([f.name for f in out]).append_column("sequence_id", pa.array([first + b for b in bins], pa.int64()))
        return placed.append_column("offset", pa.array(offsets, pa.int64()))

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out) + ", sequence_id long, offset long"
    return dealt.groupBy("group_no").applyInArrow(place, ddl)


def pack_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = 1,
    group: int = GROUP, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: where it lies in its document and in which sequence, at which place.

    A null text counts as empty: its document is the end id alone. Rows with a null id and repeated rows are
    packed like any other. An empty table gives no rows. Other columns are not read, whatever their names.
    With ``with_ids`` the rows carry the ids themselves, for a sink that writes the sequences.
    """
    pieces = token_pieces(docs, path, id_col, text_col, window, end_id, with_ids)
    return packed(materialise(pieces, "pieces"), id_col, window, group)


@query("op1_pack_ffd")
def op1_pack_ffd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
