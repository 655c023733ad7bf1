"""Streams give what the batch jobs give."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from pagemart.functions import urls as U
from pagemart.operators import health
from pagemart.plans import catalog
from pagemart.registry import render as R
from pagemart.streaming import jobs

SF = "/root/testdata/sf0.001"


def split(rows, order, path, parts=3):
    """The rows as several files, in order, so that a stream reads them in several batches."""
    total = rows.count()
    ranked = rows.toPandas().sort_values(order).reset_index(drop=True)
    for i in range(parts):
        piece = ranked.iloc[total * i // parts : total * (i + 1) // parts]
        rows.sparkSession.createDataFrame(piece, rows.schema).coalesce(1).write.mode("append").parquet(str(path))
    return str(path)


def test_health_and_counters(spark, tmp_path):
    log = R.fetch_log(spark, SF)
    path = split(log, ["ts", "request_id"], tmp_path / "log")
    stream = jobs.file_stream(spark, path, 1)
    found = {r.proxy: tuple(r)[1:] for r in jobs.final_health(stream, str(tmp_path / "health"), str(tmp_path / "health-state"), base=7200, cap=172800).collect()}
    newest = log.agg(F.max("ts")).first()[0]
    seen = newest.replace(microsecond=newest.microsecond // 1000 * 1000) - dt.timedelta(minutes=10)
    batch = health.endpoint_state(health.outcomes(log), F.lit(seen), base=7200, cap=172800)
    assert found == {r.proxy: (r.state, r.failed_attempts, r.next_check) for r in batch.collect()}

    counts = jobs.final_counters(jobs.file_stream(spark, path, 1), str(tmp_path / "counts"), str(tmp_path / "counts-state"))
    wanted = (
        health.outcomes(log).where("ban AND status IS NOT NULL").groupBy(F.window("ts", "30 seconds").start.alias("w"), "status").count()
    )
    assert {tuple(r) for r in counts.collect()} == {tuple(r) for r in wanted.collect()}


def test_items_and_duplicates(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", F.col("html").alias("body"), R.moment("page_id").alias("fetched_at"))
    path = split(pages, "page_id", tmp_path / "pages", 2)
    stream = jobs.incremental_items(jobs.file_stream(spark, path, 1), catalog.menu_categories, str(tmp_path / "items"), str(tmp_path / "items-state"))
    assert sorted(map(repr, stream.collect())) == sorted(map(repr, catalog.menu_categories(pages).collect()))

    split(pages, "page_id", tmp_path / "pages", 2)
    unique = jobs.dedupe_stream(jobs.file_stream(spark, path, 1), U.strip_query(F.col("url")), "fetched_at", "1 hour")
    keys = [r.url_key for r in jobs.run_to_table(unique.select("url_key"), str(tmp_path / "keys"), str(tmp_path / "keys-state")).collect()]
    assert len(keys) == len(set(keys)) == pages.select(U.strip_query(F.col("url"))).distinct().count()


START = dt.datetime(2024, 1, 1)
LOG = "request_id bigint, url string, proxy string, ts timestamp, status int, body_len int, exception string"


def add_file(spark, rows, schema, path, number):
    """One more file of a stream's folder; streams read files by their time of change."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))
    newest = max(path.glob("*.parquet"), key=lambda p: p.stat().st_mtime_ns)
    os.utime(newest, (1_700_000_000 + number, 1_700_000_000 + number))


@pytest.mark.parametrize("seed", [1, 2])
def test_late_rows_give_the_batch_result(spark, tmp_path, seed):
    """Rows come up to nine minutes late, over five batches; the watermark is ten."""
    rng = random.Random(seed)
    rows = [(i, "u", f"p{rng.randrange(4)}", START + dt.timedelta(seconds=20 * i + rng.randrange(20)), 403 if rng.random() < 0.7 else 200, 9, None) for i in range(200)]
    arrived = sorted(rows, key=lambda r: r[3] + dt.timedelta(seconds=rng.randrange(540)))
    for k in range(5):
        add_file(spark, arrived[k * 40 : k * 40 + 40], LOG, tmp_path / "log", k)
    stream = jobs.file_stream(spark, str(tmp_path / "log"), 1)
    found = jobs.final_health(stream, str(tmp_path / "t"), str(tmp_path / "c"), base=60, cap=3600).collect()
    seen = max(r[3] for r in rows) - dt.timedelta(minutes=10)
    batch = health.endpoint_state(health.outcomes(spark.createDataFrame(rows, LOG)), F.lit(seen), base=60, cap=3600)
    assert {r.proxy: tuple(r)[1:] for r in found} == {r.proxy: (r.state, r.failed_attempts, r.next_check) for r in batch.collect()}


def test_streams_go_on_where_they_stopped(spark, tmp_path):
    schema = "page_id bigint, url string, fetched_at timestamp"

    def run(name, job):
        stream = jobs.file_stream(spark, str(tmp_path / "pages"), 1)
        return jobs.run_to_table(job(stream), str(tmp_path / name), str(tmp_path / f"{name}-state")).collect()

    unique = lambda s: jobs.dedupe_stream(s, F.col("url"), "fetched_at", "7 days").select("url_key")
    add_file(spark, [(1, "a", START), (2, "b", START)], schema, tmp_path / "pages", 0)
    assert sorted(r.page_id for r in run("items", lambda s: s)) == [1, 2]
    assert sorted(r.url_key for r in run("keys", unique)) == ["a", "b"]
    assert sorted(r.page_id for r in run("items", lambda s: s)) == [1, 2]
    add_file(spark, [(3, "b", START), (4, "c", START)], schema, tmp_path / "pages", 1)
    assert sorted(r.page_id for r in run("items", lambda s: s)) == [1, 2, 3, 4]
    assert sorted(r.url_key for r in run("keys", unique)) == ["a", "b", "c"]


def test_health_goes_on_and_resets(spark, tmp_path):
    bans = [(i, "u", p, START + dt.timedelta(seconds=i), 403, 9, None) for i, p in enumerate("abab")]
    add_file(spark, bans[:3], LOG, tmp_path / "log", 0)
    run = lambda **o: {r.proxy: (r.state, r.failed_attempts) for r in jobs.final_health(jobs.file_stream(spark, str(tmp_path / "log"), 1), str(tmp_path / "t"), str(tmp_path / "c"), **o).collect()}
    assert run() == {"a": ("dead", 2), "b": ("dead", 1)}
    add_file(spark, bans[3:], LOG, tmp_path / "log", 1)
    assert run() == {"a": ("dead", 2), "b": ("dead", 2)}
    assert run(reset_when_none_left=True) == {"a": ("unchecked", 2), "b": ("unchecked", 2)}


def test_counts_do_not_hang_on_the_order_of_files(spark, tmp_path):
    """Files with the newest rows first, one a batch, then another run: every ban counts."""
    rng = random.Random(3)
    rows = [(i, "u", "p", START + dt.timedelta(minutes=i * 7), rng.choice([403, 500, 200]), 9, None) for i in range(300)]
    for k in range(4):
        add_file(spark, rows[(3 - k) * 60 : (4 - k) * 60], LOG, tmp_path / "log", k)
    run = lambda: {tuple(r) for r in jobs.final_counters(jobs.file_stream(spark, str(tmp_path / "log"), 1), str(tmp_path / "t"), str(tmp_path / "c")).collect()}

    def wanted(some):
        bans = health.outcomes(spark.createDataFrame(some, LOG)).where("ban AND status IS NOT NULL")
        return {tuple(r) for r in bans.groupBy(F.window("ts", "30 seconds").start.alias("w"), "status").count().collect()}

    assert run() == wanted(rows[:240])
    add_file(spark, rows[240:], LOG, tmp_path / "log", 9)
    assert run() == wanted(rows) == run()


def test_each_key_once_over_the_run(spark, tmp_path):
    """Copies 30 days apart, files in the wrong order, four batches and a second run."""
    schema = "page_id bigint, url string, fetched_at timestamp"
    pages = [(i, f"u{i % 7}" if i % 3 else None, START + dt.timedelta(days=30 * (i // 7))) for i in range(28)]
    for k in range(4):
        add_file(spark, pages[(3 - k) * 7 : (4 - k) * 7], schema, tmp_path / "pages", k)

    def run():
        stream = jobs.file_stream(spark, str(tmp_path / "pages"), 1)
        found = jobs.unique_pages(stream, F.col("url"), str(tmp_path / "t"), str(tmp_path / "c"), "page_id").collect()
        assert len({r.url_key for r in found}) == len(found)
        return {r.url_key: r.page_id for r in found}

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    first = run()
    assert set(first) == {p[1] for p in pages}
    assert all(p >= 21 for k, p in first.items() if k in {q[1] for q in pages[21:]})
    add_file(spark, [(99, "u1", START), (100, "new", START)], schema, tmp_path / "pages", 9)
    assert run() == {**first, "new": 100}
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_stream_ends_when_no_endpoint_is_left(spark, tmp_path):
    def at(i, proxy, status):
        return (i, "u", proxy, START + dt.timedelta(seconds=i), status, 9, None)

    files = [[at(0, "a", 200), at(1, "b", 403)], [at(2, "a", 403), at(3, "b", 403)], [at(4, "a", 200)], [at(5, "b", 200)]]
    for k, rows in enumerate(files):
        add_file(spark, rows, LOG, tmp_path / "log", k)

    def run(name, **options):
        stream = jobs.file_stream(spark, str(tmp_path / "log"), 1)
        found = jobs.final_health(stream, str(tmp_path / name), str(tmp_path / f"{name}-c"), stop_when_none_left=True, base=3600, cap=7200, **options)
        return {r.proxy: r.state for r in found.collect()}, [tuple(r) for r in jobs.stopped_for(spark, str(tmp_path / name)).collect()]

    states, ended = run("t")
    assert states == {"a": "dead", "b": "dead"} and ended == [(1, "no_proxies")]
    # The next run takes up the files that the first left.
    assert run("t") == ({"a": "good", "b": "good"}, [])
    assert run("t") == ({"a": "good", "b": "good"}, [])
    # An endpoint of the list that was never tried is left.
    assert run("listed", endpoints=spark.createDataFrame([("a",), ("new",)], "proxy string")) == ({"a": "good", "b": "good"}, [])


def test_an_error_in_a_batch_is_not_taken_for_an_end(spark, tmp_path):
    add_file(spark, [(1, "u")], "id bigint, url string", tmp_path / "in", 0)

    def broken(rows, batch_id):
        raise ValueError("broken check")

    with pytest.raises(Exception, match="broken check"):
        jobs.run_to_table(jobs.file_stream(spark, str(tmp_path / "in"), 1), str(tmp_path / "t"), str(tmp_path / "c"), ends=broken)
