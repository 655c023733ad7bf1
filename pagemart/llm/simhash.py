"""SimHash near-duplicates, found at the anchors of a covering code.

A fingerprint has two halves of 32 bits. Of two fingerprints that differ in at most t bits, one half
differs in at most t // 2. The anchors of a half are the words of the Hamming code on 31 bits, with the
32nd bit as it is: every value lies within one bit of an anchor (the covering radius). Two halves that
differ in d bits have a point midway, within (d + 1) // 2 bits of both, and the point has its anchor. So each
fingerprint is replicated to the anchors of all points within half the half's threshold, which lie within
covering radius plus that distance of it, and any two that link meet at an anchor at least once: 17
anchors of 2 ** 27 a half for t = 4. Fingerprints are compared per anchor, exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemart.llm.base import query, table, text_kept
from pagemart.llm.components import connected_components
from pagemart.session import materialise

WORD = re.compile(rb"[^\x20\x09-\x0d]+")
SHINGLE = 4
THRESHOLD = 4
#: The most fingerprints of an anchor that are compared in one cell; larger anchors are split into cells.
CELL = 4096


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits: each is 1 if it is set in over half of the hashes of the text's shingles."""
    words = WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    begins, ends = begins[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(begins), 1 << 16):
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(begins[at : at + (1 << 16)], ends[at : at + (1 << 16)], strict=True)], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(begins), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Per row: the id column and ``fp``, the fingerprint as a signed long."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=[id_col, "fp"])

    return text_kept(docs.select(id_col, text_col), text_col).mapInArrow(run, f"`{id_col}` {kind}, fp long")


def nearest_anchor(values: np.ndarray) -> np.ndarray:
    """The code word within one bit of each 32-bit value: the syndrome of bits 1 to 31 names the bit to turn."""
    syndrome = np.zeros(values.shape, np.uint64)
    for k in range(5):
        mask = np.uint64(sum(1 << (i - 1) for i in range(1, 32) if i >> k & 1))
        syndrome |= (np.bitwise_count(values & mask).astype(np.uint64) & np.uint64(1)) << np.uint64(k)
    turn = np.where(syndrome > 0, np.uint64(1) << (syndrome - np.minimum(syndrome, np.uint64(1))), np.uint64(0))
    return values ^ turn


def anchors(fps: np.ndarray, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) pairs; an anchor's number holds the half in bit 32."""
    reach = (threshold // 2 + 1) // 2
    turns = np.array([sum(1 << b for b in bits) for n in range(reach + 1) for bits in combinations(range(32), n)], np.uint64)
    rows, found = [], []
    for half in (0, 1):
        values = (fps >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        near = np.sort(nearest_anchor(values[:, None] ^ turns[None, :]), axis=1)
        new = np.ones(near.shape, bool)
        new[:, 1:] = near[:, 1:] != near[:, :-1]
        rows.append(np.nonzero(new)[0])
        found.append((near[new] | np.uint64(half << 32)).view(np.int64))
    return np.concatenate(rows), np.concatenate(found)


def replicated(distinct: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(anchor, fp) for every anchor a fingerprint is compared at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fps), 4096):
                part = fps[at : at + 4096]
                rows, found = anchors(part.view(np.uint64), threshold)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(part[rows])], names=["anchor", "fp"])

    return distinct.select("fp").mapInArrow(run, "anchor long, fp long")


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links to the same components, one a node: each node that is not its component's smallest, and that one."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def compared(cells: np.ndarray, fps: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the runs of equal ``cells``, as stars."""
    bits, kept_a, kept_b, held = fps.view(np.uint64), [], [], 0
    at, step = np.arange(len(cells) - 1), 1
    while True:
        at = at[at + step < len(cells)]
        at = at[cells[at] == cells[at + step]]
        if not len(at):
            break
        near = at[(np.bitwise_count(bits[at] ^ bits[at + step]) <= threshold) & (fps[at] != fps[at + step])]
        if len(near):
            kept_a.append(fps[near])
            kept_b.append(fps[near + step])
            held += len(near)
        if held > 1 << 20:
            a, b = stars(np.concatenate(kept_a), np.concatenate(kept_b))
            kept_a, kept_b, held = [a], [b], 0
        step += 1
    if not kept_a:
        return fps[:0], fps[:0]
    return stars(np.concatenate(kept_a), np.concatenate(kept_b))


def links(distinct: DataFrame, threshold: int = THRESHOLD, cell: int = CELL) -> DataFrame:
    """Links (a, b) that join the same fingerprints as all pairs within the threshold do.

    An anchor with more than ``cell`` fingerprints is split into blocks, and each pair of blocks becomes a
    cell of its own, so no pair is left out and no task holds more than two blocks.
    """
    at = replicated(distinct, threshold)
    large = at.groupBy("anchor").count().where(F.col("count") > cell)
    large = large.select("anchor", F.ceil(F.col("count") / (cell // 2)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int")
    cells = (
        at.join(large, "anchor", "left")
        .withColumn("own", F.coalesce(own, F.lit(0)))
        .withColumn("other", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))))
        .select(F.xxhash64("anchor", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "fp")
    )
    spread = cells.repartition("cell").sortWithinPartitions("cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for batch in _ended(batches):
            if batch is None:
                now, rest = rest, None
            else:
                keys = np.concatenate([rest[0], batch.column(0).to_numpy(zero_copy_only=False)])
                fps = np.concatenate([rest[1], batch.column(1).to_numpy(zero_copy_only=False)])
                cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
                now, rest = (keys[:cut], fps[:cut]), (keys[cut:], fps[cut:])
            if len(now[0]) > 1:
                a, b = compared(*now, threshold)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return spread.mapInArrow(run, "a long, b long")


def _ended(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, threshold: int = THRESHOLD, cell: int = CELL,
) -> DataFrame:
    """Per row: the id column, ``fp`` and ``component_id``, the smallest id reachable over links.

    Exact copies share a fingerprint and stand for one node; links are between different fingerprints. Texts
    without words (null, empty) have fingerprint zero and are linked like any other. Rows with a null id
    belong to their component without naming it; a component of such rows alone has a null id. Repeated rows
    are each returned. An empty table gives no rows. Other columns are not read.
    """
    base = materialise(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    least = base.groupBy("fp").agg(F.min(id_col).alias("least"))
    rooted = connected_components(links(least, threshold, cell)).withColumnRenamed("node", "fp")
    named = least.join(rooted, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    whole = named.groupBy("root").agg(F.min("least").alias("component_id"))
    component = named.join(whole, "root").select("fp", "component_id")
    return base.join(component, "fp").select(id_col, "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows whose id names their component, with all columns as they were; rows without an id stay."""
    others = near_duplicates(docs, id_col, text_col, **options).where(F.col("component_id") != F.col(id_col))
    return docs.join(others.select(id_col).distinct(), id_col, "left_anti").select(*docs.columns)


@query("op2_simhash_anchors")
def op2_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
