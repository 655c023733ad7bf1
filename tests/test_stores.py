"""Stored keys of earlier runs, and feeds that a broken-off write does not change."""

import os

import pytest
from pyspark.sql import functions as F

from pagemart.operators import links
from pagemart.operators.seen import SeenKeys
from pagemart.sources import sinks


def keys(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "url_key string")


def test_only_buckets_in_question_are_read(spark, tmp_path):
    seen = SeenKeys(spark, str(tmp_path), 64)
    seen.add(keys(spark, *[f"k{i}" for i in range(5000)]), "url_key", "one")
    asked = keys(spark, "k7", "k8", *[f"new{i}" for i in range(20)])
    possible = seen._possible(asked, "url_key")
    read = seen._read(possible)
    wanted = {(r.run, r.bucket) for r in possible.select("run", "bucket").distinct().collect()}
    names = {tuple(part.split("=")[1] for part in os.path.dirname(f).split(os.sep)[-2:]) for f in _files(read)}
    assert names == {(run, str(bucket)) for run, bucket in wanted} and len(names) < 10
    assert sorted(r.url_key for r in seen.unseen(asked, "url_key").collect()) == sorted(f"new{i}" for i in range(20))


def _files(rows):
    """Files that the plan's scan is left with after the partitions are chosen."""
    return [r[0] for r in rows.select(F.input_file_name()).distinct().collect()]


def test_runs_against_sets(spark, tmp_path):
    seen = SeenKeys(spark, str(tmp_path), 8)
    asked = keys(spark, "a", "a", "b", "c", "", None, "e")
    assert seen.unseen(asked, "url_key").count() == 7
    seen.add(keys(spark), "url_key", "empty")
    seen.add(keys(spark, None), "url_key", "nulls")
    assert seen.unseen(asked, "url_key").count() == 7
    seen.add(keys(spark, "a", "a", "", None), "url_key", "first")
    seen.add(keys(spark, "b", "x"), "url_key", "second")
    left = lambda: sorted((r.url_key for r in seen.unseen(asked, "url_key").collect()), key=repr)
    assert left() == sorted(["c", "e", None], key=repr)
    seen.add(keys(spark, "e"), "url_key", "second")  # replaces the run
    assert left() == sorted(["b", "c", None], key=repr)
    seen.compact("whole")
    assert seen.runs() == ["whole"] and left() == sorted(["b", "c", None], key=repr)
    with pytest.raises(ValueError, match="there is a run whole"):
        seen.compact("whole")


def test_a_run_without_its_filter_is_not_read(spark, tmp_path):
    seen = SeenKeys(spark, str(tmp_path), 8)
    seen.add(keys(spark, "a"), "url_key", "one")
    os.remove(tmp_path / "words" / "run=one" / "_SUCCESS")
    assert seen.runs() == [] and seen.unseen(keys(spark, "a"), "url_key").count() == 1
    seen.add(keys(spark, "a"), "url_key", "one")
    assert seen.unseen(keys(spark, "a"), "url_key").count() == 0


def test_many_keys_against_a_plain_join(spark, tmp_path):
    seen = SeenKeys(spark, str(tmp_path), 16)
    stored = spark.range(0, 60_000, 3).select(F.concat(F.lit("u"), "id").alias("url_key"))
    asked = spark.range(0, 50_000, 2).select(F.concat(F.lit("u"), "id").alias("url_key"), "id")
    seen.add(stored, "url_key", "one")
    left = seen.unseen(asked, "url_key")
    assert left.columns == ["url_key", "id"]
    assert left.count() == asked.join(stored, "url_key", "left_anti").count() and left.where("id % 3 = 0").isEmpty()
    assert seen._possible(asked, "url_key").count() < asked.count() * 0.4  # a third is stored


def test_pages_of_a_second_run(spark, tmp_path):
    pages = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 3)], "page_id bigint, url string, at int")
    pages = pages.withColumn("fetched_at", F.timestamp_seconds("at"))
    seen = SeenKeys(spark, str(tmp_path))
    first = links.dedupe_pages(pages, F.col("url"), seen)
    assert sorted(r.page_id for r in first.collect()) == [1, 3]
    seen.add(first.where("url_key = 'a'"), "url_key", "one")
    assert [r.page_id for r in links.dedupe_pages(pages, F.col("url"), seen).collect()] == [3]


SCHEMA = "id bigint, name string"


def rows(spark, *ids):
    return spark.createDataFrame([(i, f"n{i}") for i in ids], SCHEMA)


def held(spark, path, **options):
    return sorted(r.id for r in sinks.read_feed(spark, path, SCHEMA, **options).collect())


@pytest.mark.parametrize("kind, options", [("json", {}), ("csv", {"sep": ";", "header": "true"}), ("parquet", {})])
def test_feed_of_batches(spark, tmp_path, kind, options):
    path = str(tmp_path / "feed")
    assert held(spark, path, kind=kind, **options) == []
    sinks.write_feed(rows(spark, 1, 2), path, kind, **options)
    sinks.write_feed(rows(spark, 3), path, kind, append=True, **options)
    assert held(spark, path, kind=kind, **options) == [1, 2, 3]
    sinks.write_feed(rows(spark, 4), path, kind, **options)
    assert held(spark, path, kind=kind, **options) == [4]
    assert sinks.drop_unlisted(spark, path) == 2 and held(spark, path, kind=kind, **options) == [4]


def test_a_write_that_breaks_off_leaves_the_former_feed(spark, tmp_path):
    path = str(tmp_path / "feed")
    sinks.write_feed(rows(spark, 1), path)
    broken = rows(spark, 2, 3).withColumn("name", F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="lost"):
        sinks.write_feed(broken, path)
    rows(spark, 9).write.json(f"{path}/batch-without-a-manifest")
    assert held(spark, path) == [1]
    (tmp_path / "feed" / "_feed" / "2.json").write_text('{"kind": "json", "bat')  # lost while it wrote the manifest
    assert held(spark, path) == [1]
    sinks.write_feed(rows(spark, 5), path, append=True)
    assert held(spark, path) == [1, 5]


def test_two_writers_at_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "feed")
    sinks.write_feed(rows(spark, 1), path)
    monkeypatch.setattr(sinks, "_versions", lambda *_: [])  # the second has not seen the first
    with pytest.raises(Exception, match="exists"):
        sinks.write_feed(rows(spark, 2), path)
    monkeypatch.undo()
    assert held(spark, path) == [1]
