"""Byte-level BPE encoding and decoding in two tiers.

Whole pre-tokens that are in the vocabulary are resolved by a minimal perfect hash over the vocabulary,
for all pre-tokens of a batch at once; the stored piece is compared sign by sign, since a pre-token may be absent. Other
pre-tokens are merged from their bytes: a doubly linked list of parts and a heap of mergeable neighbours.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pagemart.llm.base import once, query, slices, table, text_kept
from pagemart.llm.mph import MinimalPerfectHash
from pagemart.llm.pretokens import LONG, PieceMemory, code_points, cut_long, gathered, key_of, same_spans, span_keys, starts


def merged(word: bytes, single: list[int], pairs: dict[int, int]) -> list[int]:
    """The ids of a pre-token, merging the neighbours of lowest rank first, the leftmost of equals.

    ``pairs`` has the rank of two neighbouring ids, keyed by left << 32 | right; a merged part's id is the rank.
    """
    n = len(word)
    ids = [single[b] for b in word]
    after, before = list(range(1, n + 1)), list(range(-1, n))
    ranks = [pairs.get(a << 32 | b, -1) for a, b in zip(ids, ids[1:], strict=False)]
    ranks.append(-1)
    heap = [rank << 32 | i for i, rank in enumerate(ranks) if rank >= 0]
    heapq.heapify(heap)
    while heap:
        entry = heapq.heappop(heap)
        left, rank = entry & 0xFFFFFFFF, entry >> 32
        if ranks[left] != rank:  # a neighbour was merged meanwhile
            continue
        middle = after[left]
        end = after[left] = after[middle]
        ids[left], ranks[left], ranks[middle] = rank, -1, -1
        if end < n:
            before[end] = left
            ranks[left] = joined = pairs.get(rank << 32 | ids[end], -1)
            if joined >= 0:
                heapq.heappush(heap, joined << 32 | left)
        if left:
            near = before[left]
            ranks[near] = joined = pairs.get(ids[near] << 32 | rank, -1)
            if joined >= 0:
                heapq.heappush(heap, joined << 32 | near)
    found, i = [], 0
    while i < n:
        found.append(ids[i])
        i = after[i]
    return found


class Codec:
    """A rank file ready for use; kept by the worker."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.pairs = {
            ranks[piece[:k]] << 32 | ranks[piece[k:]]: rank
            for piece, rank in ranks.items() for k in range(1, len(piece)) if piece[:k] in ranks and piece[k:] in ranks
        }
        self.spelt = [b""] * (max(ranks.values()) + 1)
        texts, ids = [], []
        for piece, rank in ranks.items():
            self.spelt[rank] = piece
            try:
                texts.append(piece.decode())
                ids.append(rank)
            except UnicodeDecodeError:
                pass  # part of a character: never a whole pre-token
        keys = np.fromiter(map(key_of, texts), np.uint64, len(texts))
        self.hash = MinimalPerfectHash.build(keys, keys)
        at = self.hash.find(keys, keys)
        self.keys, self.ids = np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.int32)
        self.keys[at], self.ids[at] = keys, ids
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.points, self.places, self.sizes = code_points("".join(texts)), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        self.places[at], self.sizes[at] = np.cumsum(sizes) - sizes, sizes
        self.numerals = [str(i) for i in range(len(self.spelt))]
        self.memory = PieceMemory()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts one after another, and where each text's begin."""
        joined = "".join(texts)
        points = code_points(joined)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        firsts = np.cumsum(sizes) - sizes
        begins = starts(points, firsts)
        ends = np.append(begins[1:], len(points))
        keys = span_keys(points, begins, ends)

        found = self.hash.find(keys, keys)
        whole = (found >= 0) & (self.keys[found] == keys)
        hits = np.flatnonzero(whole)
        whole[hits] = same_spans(points, begins[hits], (ends - begins)[hits], self.points, self.places[found[hits]], self.sizes[found[hits]])
        rest = np.flatnonzero(~whole)

        def spell(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = rest[rows]
            words = (joined[a:b].encode("utf-8", "surrogatepass") for a, b in zip(begins[at].tolist(), ends[at].tolist(), strict=True))
            spelt = [merged(word, self.single, self.pairs) for word in words]
            counts = np.fromiter(map(len, spelt), np.int64, len(spelt))
            return np.fromiter(chain.from_iterable(spelt), np.int32, int(counts.sum())), counts

        offsets, lengths = np.zeros(len(keys), np.int64), np.ones(len(keys), np.int64)
        offsets[rest], lengths[rest] = self.memory.look_up(keys[rest], points, begins[rest], ends[rest], spell)
        pool = self.memory.ids
        offsets[whole] = len(pool) + found[whole]
        ids, bounds = gathered(np.concatenate([pool, self.ids]), offsets, lengths)
        return ids, np.append(bounds[np.searchsorted(begins, firsts)], len(ids))

    def encode_each(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text; long texts are cut where the split allows it."""
        short: list[str] = []
        for text in texts:
            if len(text) > LONG:
                yield from self._together(short)
                short = []
                yield np.concatenate([self.encode([part])[0] for part in cut_long(text)])
            else:
                short.append(text)
        yield from self._together(short)

    def _together(self, texts: list[str]) -> Iterator[np.ndarray]:
        if texts:
            ids, bounds = self.encode(texts)
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                yield ids[a:b]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.spelt.__getitem__, ids))


def codec(path: str) -> Codec:
    return once(("codec", path), lambda: Codec(path))


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id column, and ``ids`` of the whole text by the rank file at ``path`` on every executor.

    A null text counts as empty and has no ids. Repeated rows are each encoded; other columns are not read.
    """
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids = pa.array(list(codec(path).encode_each(texts)), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[id_col, "ids"])

    return text_kept(docs.select(id_col, text_col), text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: the id column, and ``decoded``, the bytes of its ids; null ids give no bytes."""
    kind = dict(encoded.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            decoded = [codec(path).decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(decoded, pa.binary())], names=[id_col, "decoded"])

    return encoded.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, decoded binary")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_tokens``, and digests of the ids and of the bytes decoded from them, in one pass."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            counts, of_ids, of_bytes, own = [], [], [], codec(path)
            for ids in own.encode_each([t or "" for t in batch.column(1).to_pylist()]):
                ids = ids.tolist()
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(own.numerals.__getitem__, ids)).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return text_kept(docs.select(id_col, text_col), text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


@query("op4_byte_bpe")
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
