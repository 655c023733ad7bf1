"""Line dedup by sharded minimal perfect hashes.

Every line long enough has a key, and every key a 128-bit hash. The distinct hashes are dealt over shards;
each shard is a minimal perfect hash with arrays of fingerprints and counts, and the keeping document
of the keys that count. They are a table of a few bytes a key in the shared folder. Documents probe with their
lines' hashes, never the lines, and only the shard that holds a hash is asked; a shard that very many
documents ask is copied, so that no task answers more than a set number of probes. The answers, dropped
lines only, go back to their documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemart.llm.base import query, slices, table, text_kept
from pagemart.llm.mph import MinimalPerfectHash
from pagemart.llm.quality import mixed
from pagemart.session import materialise

STRIPPED = " \t\n\x0b\x0c\r"
MIN_CHARS = 20
MIN_DOCS = 3
#: Keys of one shard, and probes answered by one copy of it.
SHARD_KEYS = 250_000
SHARD_PROBES = 1_000_000


def line_hash(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """16 bytes of the line's key; None if the key is too short."""
    key = line.strip(STRIPPED)
    return xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass").lower()) if len(key) >= min_chars else None


def line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(doc, high, low): the hashes of a row's distinct keys; rows without an id give none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            ids, digests = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = {h for line in (text or "").split("\n") if (h := line_hash(line, min_chars))} if doc is not None else ()
                ids += [doc] * len(own)
                digests += own
            both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["doc", "high", "low"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), text_col)
    return text_kept(rows, text_col).mapInArrow(run, "doc long, high long, low long")


def _unsigned(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64).view(np.uint64)


def shard_arrays(keys: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per shard from (shard, high, low, docs, keeper): the hash, fingerprints, counts and keepers."""

    def build(rows: pa.Table) -> pa.Table:
        high, low = _unsigned(rows["high"]), _unsigned(rows["low"])
        index = MinimalPerfectHash.build(high, low)
        at = index.find(high, low)
        prints, counts, keepers = np.zeros(len(at), "<u4"), np.zeros(len(at), "<u4"), np.zeros(len(at), "<i8")
        prints[at] = mixed(high ^ mixed(low)) >> np.uint64(32)
        counts[at] = np.minimum(rows["docs"].to_numpy(), (1 << 32) - 1)
        keepers[at] = rows["keeper"].to_numpy()
        held = [index.to_bytes(), prints.tobytes(), counts.tobytes(), keepers[counts >= min_docs].tobytes()]
        names = ["hash", "prints", "counts", "keepers"]
        return pa.table({"shard": rows["shard"][:1], **{n: pa.array([v], pa.binary()) for n, v in zip(names, held, strict=True)}})

    return keys.groupBy("shard").applyInArrow(build, "shard long, hash binary, prints binary, counts binary, keepers binary")


def probed(probes: DataFrame, arrays: DataFrame, min_docs: int = MIN_DOCS, shard_probes: int = SHARD_PROBES) -> DataFrame:
    """(doc, high, low) of the probes (shard, doc, high, low) whose line another document keeps."""
    asked = probes.groupBy("shard").count().select("shard", F.ceil(F.col("count") / shard_probes).cast("long").alias("copies"))
    left = probes.join(asked, "shard").select("shard", F.pmod(F.xxhash64("doc"), "copies").alias("copy"), "doc", "high", "low")
    right = arrays.join(asked, "shard").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))

    def ask(some: pa.Table, shard: pa.Table) -> pa.Table:
        if not (some.num_rows and shard.num_rows):
            return some.select(["doc", "high", "low"]).slice(0, 0)
        high, low, doc = _unsigned(some["high"]), _unsigned(some["low"]), some["doc"].to_numpy()
        read = {n: shard[n][0].as_buffer() for n in ("prints", "counts", "keepers")}
        prints, counts, keepers = (np.frombuffer(read[n], t) for n, t in (("prints", "<u4"), ("counts", "<u4"), ("keepers", "<i8")))
        at = MinimalPerfectHash.from_bytes(shard["hash"][0].as_py()).find(high, low)
        hit = (at >= 0) & (prints[at] == (mixed(high ^ mixed(low)) >> np.uint64(32))) & (counts[at] >= min_docs)
        place = np.cumsum(counts >= min_docs) - 1
        rows = np.flatnonzero(hit)
        rows = rows[keepers[place[at[rows]]] != doc[rows]]
        return some.select(["doc", "high", "low"]).take(pa.array(rows))

    return (
        left.groupBy("shard", "copy")
        .cogroup(right.select("shard", "copy", "hash", "prints", "counts", "keepers").groupBy("shard", "copy"))
        .applyInArrow(ask, "doc long, high long, low long")
    )


def dropped_lines(
    docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int, shard_keys: int, shard_probes: int
) -> DataFrame:
    """(doc, gone): the hashes of the keys each document loses, 16 bytes each."""
    found = materialise(line_keys(docs, id_col, text_col, min_chars), "line-keys")
    counted = found.distinct().groupBy("high", "low").agg(F.count(F.lit(1)).alias("docs"), F.max("doc").alias("keeper"))
    keys = materialise(counted, "line-counts")
    shards = -(-keys.count() // shard_keys) or 1
    shard = F.pmod(F.xxhash64("high", "low"), F.lit(shards)).alias("shard")
    arrays = materialise(shard_arrays(keys.select(shard, "*"), min_docs), "line-arrays")
    gone = probed(found.select(shard, "*"), arrays, min_docs, shard_probes)
    return gone.distinct().groupBy("doc").agg(F.collect_list(F.struct("high", "low")).alias("gone"))


def without(text: str | None, gone: set[bytes], min_chars: int) -> tuple[int, int, str]:
    """(lines, lines dropped, the other lines joined)."""
    lines = (text or "").split("\n")
    if not gone:
        return len(lines), 0, text or ""
    kept = [line for line in lines if line_hash(line, min_chars) not in gone]
    return len(lines), len(lines) - len(kept), "\n".join(kept)


def _cleaned(docs, id_col, text_col, min_chars, min_docs, shard_keys, shard_probes, fields, ddl, result):
    gone = dropped_lines(docs, id_col, text_col, min_chars, min_docs, shard_keys, shard_probes)
    hidden = "gone"
    while hidden in docs.columns:
        hidden += "_"
    gone = gone.withColumnRenamed("gone", hidden)
    joined = text_kept(docs, text_col).join(gone, F.col("doc") == docs[id_col].cast("long"), "left").select(*docs.columns, hidden)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            names = batch.schema.names
            texts = batch.column(names.index(text_col)).to_pylist()
            lists = batch.column(names.index(hidden))
            flat = np.column_stack([lists.flatten().field(k).to_numpy(zero_copy_only=False) for k in (0, 1)]).astype("<i8").tobytes()
            ends = np.cumsum(np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False))).astype(int).tolist()
            done, begin = [], 0
            for text, end in zip(texts, ends, strict=True):
                done.append(without(text, {flat[16 * k : 16 * k + 16] for k in range(begin, end)}, min_chars))
                begin = end
            yield result(batch.select(names[:-1]), done)

    return joined.select(*fields, hidden).mapInArrow(run, ddl)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
    shard_keys: int = SHARD_KEYS, shard_probes: int = SHARD_PROBES,
) -> DataFrame:
    """The rows with their shared lines dropped from the text; all columns as they were.

    A key held by ``min_docs`` documents stays in the largest whole-number id that holds it. Lines with
    shorter keys stay. A null text stays null. Rows without an id are left as they are and do not count.
    Repeated rows of one id count as one document and lose the same lines.
    """

    def result(batch: pa.RecordBatch, done: list) -> pa.RecordBatch:
        at = batch.schema.names.index(text_col)
        texts = pa.array([None if old is None else d[2] for old, d in zip(batch.column(at).to_pylist(), done, strict=True)], pa.string())
        return pa.RecordBatch.from_arrays([texts if k == at else c for k, c in enumerate(batch.columns)], names=batch.schema.names)

    schema = text_kept(docs, text_col).schema
    return _cleaned(docs, id_col, text_col, min_chars, min_docs, shard_keys, shard_probes, docs.columns, schema, result)


def line_digests(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
    shard_keys: int = SHARD_KEYS, shard_probes: int = SHARD_PROBES,
) -> DataFrame:
    """Per row: id, ``n_lines`` before dropping, ``n_dropped`` and ``kept_sha256`` of what ``dedup_lines`` keeps.

    A null or empty text is one empty line. An empty table gives no rows.
    """

    def result(batch: pa.RecordBatch, done: list) -> pa.RecordBatch:
        digests = [hashlib.sha256(d[2].encode("utf-8", "surrogatepass")).hexdigest() for d in done]
        columns = [batch.column(0), pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64()), pa.array(digests, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=[id_col, "n_lines", "n_dropped", "kept_sha256"])

    ddl = f"`{id_col}` {dict(docs.dtypes)[id_col]}, n_lines long, n_dropped long, kept_sha256 string"
    docs = docs.select(id_col, text_col)
    return _cleaned(docs, id_col, text_col, min_chars, min_docs, shard_keys, shard_probes, docs.columns, ddl, result)


ORACLE = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
shared AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= {MIN_CHARS}
  GROUP BY k HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
marked AS (SELECT keyed.*, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


@query("op7_line_dedup", ORACLE)
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digests(table(spark, sf_dir, "documents"))
