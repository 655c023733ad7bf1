"""Shared parts of the training-data operators: registry, worker-side caches, byte-bounded batches."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(key, build: Callable):
    """``build()``, kept for the life of this Python worker.

    Functions of this package travel with the job, so their module globals are new in every task;
    the store hangs on ``sys`` to outlive them.
    """
    store = sys.__dict__.setdefault("_pagemart_llm", {})
    if key not in store:
        store[key] = build()
    return store[key]


def let_go(*kinds: str) -> None:
    """Drop what ``once`` keeps under these first words of its keys: tables that the work at hand does not need."""
    store = sys.__dict__.get("_pagemart_llm", {})
    for key in [k for k in store if isinstance(k, tuple) and k[0] in kinds]:
        del store[key]


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Row ranges of the batches with about ``most`` bytes of text each, or a single longer row."""
    for batch in batches:
        lengths = batch.column(column).cast(pa.large_string()).fill_null("")
        ends = memoryview(lengths.buffers()[1]).cast("q")[lengths.offset : lengths.offset + len(lengths) + 1]
        start = 0
        for row in range(1, batch.num_rows + 1):
            if row == batch.num_rows or ends[row + 1] - ends[start] > most:
                yield batch.slice(start, row - start)
                start = row


def text_kept(docs: DataFrame, column: str) -> DataFrame:
    """The rows with ``column`` cast to text, other columns untouched."""
    return docs if dict(docs.dtypes)[column] == "string" else docs.withColumn(column, docs[column].cast("string"))


def text_filter(keep: Callable[[str | None], bool], column: str) -> Column:
    """A boolean column: ``keep`` of each text. Only texts go to Python and only booleans come back."""

    def run(texts: pa.Array) -> pa.Array:
        let_go("vocabulary", "codec", "word lengths")  # of a packing or counting job that this worker served before
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        return pa.array([keep(t.as_py()) for part in slices([batch], "text") for t in part.column(0)], pa.bool_())

    return F.arrow_udf(run, "boolean")(F.col(column).cast("string"))
