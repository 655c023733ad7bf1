"""Outputs: JSON feeds, semicolon CSV tables and the run record."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemart.functions import collections as C
from pagemart.functions import text as X
from pagemart.session import create_file, delete_path, names_in


def feed_view(records: DataFrame, *moments: str) -> DataFrame:
    """Records as they go to a feed: record times become text."""
    return records.withColumns({name: X.iso_text(F.col(name)) for name in moments})


def write_json(records: DataFrame, path: str) -> None:
    records.write.json(path)


def write_csv(table: DataFrame, path: str) -> None:
    table.write.option("sep", ";").option("header", True).csv(path)


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name[:-5]) for name in names_in(spark, f"{path}/_feed") if name.endswith(".json") and name[:-5].isdigit())


def feed_batches(spark: SparkSession, path: str) -> list[str] | None:
    """The batches of the feed by its newest whole manifest; None if there never was one.

    A manifest whose writing broke off does not parse and is passed over.
    """
    for version in reversed(_versions(spark, path)):
        row = spark.read.text(f"{path}/_feed/{version}.json", wholetext=True).first()
        try:
            return json.loads(row[0] if row else "")["batches"]
        except ValueError:
            continue
    return None


def write_feed(records: DataFrame, path: str, kind: str = "json", append: bool = False, **options: str) -> str:
    """Write records as a new batch of a feed and return the batch's name; without ``append`` they replace the feed.

    The rows go to a folder of their own, and the manifest that lists it is written last: ``read_feed`` sees the
    former feed until then, also if the driver is lost half-way. Of two writers at once one fails, as a manifest is never replaced.
    """
    spark, path = records.sparkSession, path.rstrip("/")
    former, version = (feed_batches(spark, path) or []) if append else [], max(_versions(spark, path), default=0) + 1
    batch = f"batch-{uuid.uuid4().hex}"
    records.write.format(kind).options(**options).save(f"{path}/{batch}")
    create_file(spark, f"{path}/_feed/{version}.json", json.dumps({"kind": kind, "batches": [*former, batch]}))
    return batch


def read_feed(spark: SparkSession, path: str, schema: str, kind: str = "json", **options: str) -> DataFrame:
    """The rows of the feed's batches, and of nothing else that lies there."""
    path = path.rstrip("/")
    batches = feed_batches(spark, path)
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(kind).options(**options).load([f"{path}/{batch}" for batch in batches])


def drop_unlisted(spark: SparkSession, path: str) -> int:
    """Delete batches that the feed does not hold: replaced ones and those that broke off. Not while others read or write it."""
    path = path.rstrip("/")
    held = set(feed_batches(spark, path) or [])
    old = [name for name in names_in(spark, path) if name.startswith("batch-") and name not in held]
    for name in old:
        delete_path(spark, f"{path}/{name}")
    return len(old)


def write_pages(pages: DataFrame, name: str, path: str, buckets: int) -> None:
    """Store captured pages as a table bucketed by page id.

    Filters by a list of page ids, such as the winners of a de-duplication, then move the ids only:
    the bodies are read where they lie.
    """
    writer = pages.write.bucketBy(buckets, "page_id").sortBy("page_id")
    writer.option("path", path).saveAsTable(name)


def run_summary(counts: DataFrame, params: Column, run_id: Column | None = None) -> DataFrame:
    """Counts of a run with its id (0 if none) and the user's parameters as a map."""
    return counts.withColumn("params", C.parse_params(params, job_id=F.coalesce(run_id, F.lit(0)) if run_id is not None else F.lit(0)))
