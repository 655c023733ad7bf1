"""Near copies by Jaccard similarity of word shingles: SimHash finds the candidates, whole shingle sets decide.

Rows with the same shingle set are one node. A node has ``WORDS`` SimHash fingerprints of 64 bits, each from its own
mixing of the shingle hashes, so at similarity s a bit differs with acos(2s / (1 + s)) / pi, 0.15 at 0.8. Each half of
a fingerprint goes to its anchor of the covering code of ``simhash``, and to those of the values that differ from it in
one or two of its weakest bits, the ones whose counts are nearest to even. Nodes that share an anchor are candidates: at 0.8 two
halves do so with probability 0.28, one of the 24 halves with 0.9996. Candidates that differ in over a quarter of all
bits are dropped (0.8 lies over seven deviations below that), the others are compared on the whole sets, and only pairs
at or over the threshold are links. Anchors of few nodes give pairs. In larger ones a node is first compared with all
others; that joins groups of copies at a cost linear in their size. Nodes left in different components are compared in
blocks: a block's sets are sent once, and one product of its (node, shingle) marks gives the overlaps of all its pairs exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemart.llm.base import slices, text_kept
from pagemart.llm.components import connected_components
from pagemart.llm.simhash import WORD, _ended, nearest_anchor, stars
from pagemart.session import discard, materialise

SHINGLE, SIMILARITY = 5, 0.8
#: Fingerprints of a node, its weakest bits of a half that are turned one at a time, and those turned two at a time.
WORDS, WEAK, PAIRED = 12, 6, 4
#: The most bits of all fingerprints in which candidates differ: a quarter.
FAR = WORDS * 16
#: Anchors of at most so many nodes give all their pairs.
SMALL = 8
#: Rounds in which one node of each larger anchor meets all others, before the rest is compared in blocks.
STARS = 2
#: Nodes and bytes of sets in one half of a block, and shingles marked at once.
BLOCK_NODES, BLOCK_BYTES, MARKED = 800, 4_000_000, 4096


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The different 64-bit hashes of the text's shingles, in order; a shorter text is one shingle, one without words none."""
    words = WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if not words:
        return np.zeros(0, np.uint64)
    joined, digest, k = b" ".join(words), xxhash.xxh64_intdigest, min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])[: len(words) - k + 1]
    pairs = zip(begins.tolist(), ends[k - 1 :].tolist(), strict=True)
    return np.unique(np.fromiter((digest(joined[a:b], 42) for a, b in pairs), np.uint64, len(begins)))


def fingerprints(hashes: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(the SimHash fingerprints of a set of hashes, the weakest bits of each half), weakest first."""
    draw = np.random.default_rng(11).integers(0, 1 << 63, (2, words, 1)).astype(np.uint64)
    ones, lanes = np.zeros((words, 8, 8), np.int64), np.uint64(0x0101010101010101)
    for at in range(0, len(hashes), 255 * 16):
        mixed = (hashes[None, at : at + 255 * 16] ^ draw[0]) * (draw[1] * np.uint64(2) + np.uint64(1))
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(29)
        firsts = np.arange(0, mixed.shape[1], 255)
        for k in range(8):  # bit k of each byte: eight counts in a number, which 255 rows do not overflow
            sums = np.add.reduceat((mixed >> np.uint64(k)) & lanes, firsts, axis=1)
            ones[:, :, k] += sums.view(np.uint8).reshape(words, len(firsts), 8).sum(axis=1, dtype=np.int64)
    lead = 2 * ones.reshape(words, 64) - len(hashes)
    weak = np.argsort(np.abs(lead).reshape(2 * words, 32), axis=1, kind="stable")[:, :WEAK].astype(np.uint8)
    return np.packbits(lead > 0, axis=1, bitorder="little").view("<u8").ravel(), weak


def anchors_of(fps: np.ndarray, weak: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the anchors of each row's fingerprints; a bucket's number holds the half from bit 32 on."""
    half = np.stack([fps & np.uint64(0xFFFFFFFF), fps >> np.uint64(32)], axis=2).reshape(len(fps), -1)
    turns = np.uint64(1) << weak.reshape(*half.shape, -1).astype(np.uint64)
    pairs = [turns[:, :, a] | turns[:, :, b] for a, b in combinations(range(PAIRED), 2)]
    turns = np.concatenate([np.zeros_like(turns[:, :, :1]), turns, np.stack(pairs, axis=2)], axis=2)
    near = np.sort(nearest_anchor(half[:, :, None] ^ turns), axis=2)
    new = np.ones(near.shape, bool)
    new[:, :, 1:] = near[:, :, 1:] != near[:, :, :-1]
    near |= (np.arange(half.shape[1], dtype=np.uint64) << np.uint64(32))[None, :, None]
    return np.nonzero(new)[0], near[new].view(np.int64)


def band_keys(hashes: np.ndarray) -> list[int]:
    """The buckets of a shingle set; an empty one has none."""
    if not len(hashes):
        return []
    fps, weak = fingerprints(hashes)
    return anchors_of(fps[None], weak[None])[1].tolist()


def marked(rows: DataFrame, row: str, text_col: str, shingle: int) -> DataFrame:
    """(row, digest, fps, weak): the 128-bit hash of each row's shingle set, its fingerprints and their weak bits; NULL without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            digests, fps, weak = [], [], []
            for text in batch.column(1):
                hashes = shingle_set(text.as_py(), shingle)
                digests.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                words, bits = fingerprints(hashes) if len(hashes) else (None, None)
                fps.append(None if words is None else words.view(np.int64))
                weak.append(None if bits is None else bits.tobytes())
            columns = [batch.column(0), pa.array(digests, pa.binary()), pa.array(fps, pa.list_(pa.int64())), pa.array(weak, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "digest", "fps", "weak"])

    return text_kept(rows.select(row, text_col), text_col).mapInArrow(run, "row long, digest binary, fps array<long>, weak binary")


def anchored(nodes: DataFrame) -> DataFrame:
    """(bucket, node) for every anchor a node is compared at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            fps = batch.column(1).flatten().to_numpy().view(np.uint64).reshape(batch.num_rows, -1)
            weak = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            rows, found = anchors_of(fps, weak)
            yield pa.RecordBatch.from_arrays([pa.array(found), batch.column(0).take(pa.array(rows))], names=["bucket", "node"])

    return nodes.where("fps IS NOT NULL").select("node", "fps", "weak").mapInArrow(run, "bucket long, node long")


def meetings(cells: DataFrame, small: int = SMALL) -> DataFrame:
    """(bucket, a, b) from (bucket, node): the pairs of buckets of 2 to ``small`` nodes, without a bucket; of larger
    buckets each node, with a NULL ``b``. A task holds one batch and ``small`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, wide = (np.zeros(0, np.int64), np.zeros(0, np.int64)), None

        def out(bucket: np.ndarray, node: np.ndarray, large: np.ndarray) -> pa.RecordBatch:
            first, second, at, step = [], [], np.flatnonzero(~large), 1
            while True:
                at = at[at + step < len(bucket)]
                at = at[bucket[at] == bucket[at + step]]
                if not len(at):
                    break
                first.append(node[at])
                second.append(node[at + step])
                step += 1
            pairs = np.concatenate([*first, node[:0]]), np.concatenate([*second, node[:0]])
            n, m = len(pairs[0]), int(large.sum())
            none = np.arange(n + m) < n
            a, b = np.concatenate([np.minimum(*pairs), node[large]]), np.concatenate([np.maximum(*pairs), np.zeros(m, np.int64)])
            places = np.concatenate([np.zeros(n, np.int64), bucket[large]])
            return pa.RecordBatch.from_arrays([pa.array(places, mask=none), pa.array(a), pa.array(b, mask=~none)], names=["bucket", "a", "b"])

        for batch in _ended(batches):
            bucket, node = held if batch is None else (np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns, strict=True))
            if not len(bucket):
                continue
            starts = np.flatnonzero(np.diff(bucket, prepend=bucket[0] - 1))
            sizes = np.diff(np.append(starts, len(bucket)))
            large = sizes > small
            large[0] |= wide is not None and bucket[0] == wide
            cut = len(bucket) if batch is None or large[-1] else int(starts[-1])
            wide = int(bucket[-1]) if large[-1] else None
            held = bucket[cut:], node[cut:]
            yield out(bucket[:cut], node[:cut], np.repeat(large, sizes)[:cut])

    return cells.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "bucket long, a long, b long")


def near_pairs(pairs: DataFrame, nodes: DataFrame, far: int = FAR) -> DataFrame:
    """(center, node): the pairs (a, b) whose fingerprints differ in at most ``far`` bits."""
    own = lambda c: nodes.select(F.col("node").alias(c), F.col("fps").alias(f"fps_{c}"))
    differ = F.aggregate(F.zip_with("fps_a", "fps_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, m: n + m)
    return pairs.join(own("a"), "a").join(own("b"), "b").where(differ <= far).select(F.col("a").alias("center"), F.col("b").alias("node"))


def sets_of(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, hashes) from (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            hashes = [shingle_set(t.as_py(), shingle).tobytes() for t in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(hashes, pa.binary())], names=["node", "hashes"])

    return texts.mapInArrow(run, "node long, hashes binary")


def _set(column: pa.Array, at: int) -> np.ndarray:
    return np.frombuffer(column[at].as_buffer(), np.uint64)


def star_links(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (center, node) whose shingle sets have at least this Jaccard similarity.

    The rows of a center come sorted behind its own, so its set is sent once a block and a task holds two sets.
    """
    nodes = pairs.join(sets, "node").select("center", "node", "hashes", F.pmod(F.xxhash64("node"), F.lit(64)).alias("block"))
    # A center stands before each block of its nodes; blocks follow the hash of a node, so they are the same in every run.
    blocks = pairs.select("center", F.pmod(F.xxhash64("node"), F.lit(64)).alias("block")).distinct()
    centers = blocks.join(sets.withColumnRenamed("node", "center"), "center").select("center", F.lit(None).cast("long").alias("node"), "hashes", "block")
    rows = nodes.unionByName(centers).repartition("center", "block").sortWithinPartitions("center", "block", F.col("node").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(0, np.uint64)
        for batch in batches:
            kept = []
            for at, node in enumerate(batch.column(1).to_pylist()):
                if node is None:
                    own = _set(batch.column(2), at).copy()
                    continue
                other = _set(batch.column(2), at)
                low, high = sorted((len(own), len(other)))
                if low >= similarity * high:
                    place = np.minimum(np.searchsorted(own, other), len(own) - 1)
                    both = int(np.count_nonzero(own[place] == other))
                    if both >= similarity * (low + high - both):
                        kept.append(at)
            yield batch.select([0, 1]).take(pa.array(kept, pa.int64())).rename_columns(["a", "b"])

    return rows.select("center", "node", "hashes").mapInArrow(run, "a long, b long")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many members each two sets share: a sum of products of 0/1 marks, over the members that occur twice or more."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    members, number, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(counts > 1) - 1
    keep = counts[number] > 1
    number, owner = shared[number[keep]], owner[keep]
    order = np.argsort(number, kind="stable")
    number, owner = number[order], owner[order]
    total = np.zeros((n, n), np.float32)
    for at in range(0, int(number[-1]) + 1 if len(number) else 0, MARKED):
        low, high = np.searchsorted(number, [at, at + MARKED])
        marks = np.zeros((n, MARKED), np.float32)
        marks[owner[low:high], number[low:high] - at] = 1
        total += marks @ marks.T
    return total


def linked(nodes: np.ndarray, roots: np.ndarray, sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of nodes with different roots, as stars: they join what all links of the block join."""
    sizes = np.array([len(s) for s in sets], np.float64)
    both = overlaps(sets).astype(np.float64)
    near = (both >= similarity * (sizes[:, None] + sizes[None] - both)) & (roots[:, None] != roots[None])
    a, b = np.nonzero(np.triu(near, 1))
    return stars(nodes[a], nodes[b]) if len(a) else (nodes[:0], nodes[:0])


def block_links(cells: DataFrame, sets: DataFrame, similarity: float, nodes: int = BLOCK_NODES, most: int = BLOCK_BYTES) -> DataFrame:
    """Links (a, b) across roots between the nodes of each bucket, from (bucket, node, root).

    A bucket over the bounds is dealt over blocks by a hash of the node, and each pair of blocks is a cell of its
    own, so no pair is left out and no cell holds more than about two blocks.
    """
    sized = cells.join(sets.select("node", F.length("hashes").alias("bytes")), "node")
    whole = sized.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("same"))
    # Buckets of the very same nodes are compared once.
    whole = whole.groupBy("n", "bytes", "same").agg(F.min("bucket").alias("bucket"))
    blocks = F.greatest(F.ceil(F.col("n") / nodes), F.ceil(F.col("bytes") / most)).cast("int").alias("blocks")
    dealt = cells.join(whole.select("bucket", blocks), "bucket").withColumn("own", F.pmod(F.xxhash64("node", F.lit(7)), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node", "root")
    key = ["bucket", "low", "high"]
    rows = dealt.join(sets, "node").select(*key, "node", "root", "hashes").repartition(*key).sortWithinPartitions(*key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []

        def done() -> pa.RecordBatch:
            own = np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.int64)
            a, b = linked(*own, [h[2] for h in held], similarity)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            keys = zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True)
            for at, (*place, node, root) in enumerate(keys):
                if place != cell:
                    if len(held) > 1:
                        yield done()
                    cell, held = place, []
                held.append((node, root, _set(batch.column(5), at).copy()))
        if len(held) > 1:
            yield done()

    return rows.mapInArrow(run, "a long, b long")


def components_of(members: DataFrame, sets: DataFrame, similarity: float, roots: DataFrame | None = None) -> DataFrame:
    """(node, root) of the nodes that are linked, from (bucket, node); ``roots`` are those known before."""
    tested = None
    if roots is None:
        roots = members.sparkSession.createDataFrame([], "node long, root long")
    for star in range(STARS + 1):
        cells = materialise(members.join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root")), "cells")
        order = F.struct(F.xxhash64("node", F.lit(star)), "node")
        ends = cells.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min_by(F.struct("node", "root"), order).alias("mid"))
        ends = ends.where("low != high").select("bucket", F.col("mid.node").alias("center"), F.col("mid.root").alias("center_root"))
        if star < STARS:
            pairs = cells.join(ends, "bucket").where("root != center_root").select("center", "node").distinct()
            if tested is not None:
                pairs = pairs.join(tested, ["center", "node"], "left_anti")
            pairs = materialise(pairs, "pairs")
            found = materialise(star_links(pairs, sets, similarity), "links")
            tested = pairs
        else:
            found = materialise(block_links(cells.join(ends.select("bucket"), "bucket", "left_semi"), sets, similarity), "links")
        former, roots = roots, contracted(roots, found)
        discard(cells, found, former)
    discard(tested)
    return roots


def contracted(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after more links: only the links between the roots known so far go through the components."""
    root_of = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    named = links.join(root_of("a"), "a", "left").join(root_of("b"), "b", "left")
    named = named.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")).where("a != b").distinct()
    joined = materialise(connected_components(named), "joined")
    further = joined.select(F.col("node").alias("root"), F.col("root").alias("new"))
    old = roots.join(further, "root", "left").select("node", F.coalesce("new", "root").alias("root"))
    result = materialise(old.unionByName(joined.join(old, "node", "left_anti")), "roots")
    discard(joined)
    return result


def near_copies(rows: DataFrame, row: str, text_col: str, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(row, component): ``component`` is the smallest row number that links lead to. ``row`` holds different longs and
    ``rows`` must give the same ones each time it is read."""
    base = materialise(marked(rows, row, text_col, shingle), "marks")
    nodes = materialise(base.groupBy("digest").agg(F.min("row").alias("node"), F.first("fps").alias("fps"), F.first("weak").alias("weak")), "nodes")
    met = materialise(meetings(anchored(nodes)), "meetings")
    pairs = materialise(near_pairs(met.where("b IS NOT NULL").select("a", "b").distinct(), nodes), "pairs")
    members = met.where("b IS NULL").select("bucket", F.col("a").alias("node"))
    needed = pairs.select(F.explode(F.array("center", "node")).alias("node")).unionByName(members.select("node")).distinct()
    texts = text_kept(rows.select(F.col(row).alias("node"), F.col(text_col).alias("text")), "text")
    sets = materialise(sets_of(texts.join(needed, "node", "left_semi"), shingle), "sets")
    links = materialise(star_links(pairs, sets, similarity), "links")
    roots = contracted(rows.sparkSession.createDataFrame([], "node long, root long"), links)
    if not members.isEmpty():
        roots = components_of(members, sets, similarity, roots)
    named = nodes.select("digest", "node").join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("component"))
    found = materialise(base.select("row", "digest").join(named, "digest").select("row", "component"), "components")
    discard(base, nodes, met, pairs, links, sets)
    return found


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each component, that with the smallest id, nulls last; columns are as they were.

    Rows without an id are rows like others, and of repeated rows one stays. Texts without words (null, empty) are
    copies of each other. An empty table gives no rows.
    """
    row = "row_number_" + "_".join(docs.columns)
    rows = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = near_copies(rows, row, text_col, **options).withColumnRenamed("row", row)
    own = rows.select(row, F.col(id_col).isNull().alias("late"), F.col(id_col).alias("id")).join(found, row)
    kept = own.groupBy("component").agg(F.min(F.struct("late", "id", row)).alias("first")).select(F.col(f"first.{row}").alias(row))
    return rows.join(kept, row, "left_semi").select(*docs.columns)
