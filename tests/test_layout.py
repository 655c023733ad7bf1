"""Where rows move, and where lineage is cut."""

import contextlib
import io
import os
import re
import subprocess
import sys

from pyspark.sql import functions as F

from pagemart import session
from pagemart.functions import urls as U
from pagemart.operators import frontier, html_rules, joins, links, scans
from pagemart.operators.html_rules import Rule
from pagemart.registry import QUERIES
from pagemart.sources import readers, sinks

SF = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_shared_dir_is_the_configured_one(spark, checkpoint_dir):
    assert session.shared_dir(spark) == checkpoint_dir
    assert session.scratch_path(spark, "x").startswith(f"{checkpoint_dir}/x-")
    spark.range(3).checkpoint()
    assert session.shared_dir(spark) == checkpoint_dir


def test_materialised_rows_are_read_from_files(spark):
    df = spark.range(5).withColumn("t", F.current_timestamp())
    again = session.materialise(df, "rows")
    assert again.dtypes == df.dtypes and again.count() == 5
    assert "FileScan parquet" in plan(again)


def test_rules_do_not_shuffle_and_read_two_columns(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    text = plan(html_rules.extract_rules(pages, [Rule("h", "h1::text")], keep=("page_id",), body="html"))
    assert "Exchange" not in text and "ReadSchema: struct<page_id:bigint,html:string>" in text


def test_filter_on_canonical_runs_before_parsing(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").withColumnRenamed("html", "body")
    own, _ = links.resolve_canonical(pages, links.canonical_href(F.col("body")))
    lines = plan(html_rules.extract_rules(own, [Rule("h", "h1::text")], keep=("page_id",))).splitlines()
    parse = next(i for i, line in enumerate(lines) if "MapInArrow" in line)
    search = [i for i, line in enumerate(lines) if "Filter" in line and "canonical" in line]
    assert search and min(search) > parse


def test_dedupe_of_bucketed_pages_moves_ids_only(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet").withColumn("fetched_at", F.timestamp_seconds("page_id"))
    sinks.write_pages(pages, "bucketed_pages", str(tmp_path / "pages"), 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        unique = links.dedupe_pages(readers.captured_pages(spark, "bucketed_pages"), U.strip_query(F.col("url")))
        text = plan(unique)
        moved = [line for line in text.splitlines() if "Exchange hashpartitioning(page_id" in line]
        assert "Bucketed: true" in text and len(moved) == 1
        keys = pages.select(U.strip_query(F.col("url"))).distinct().count()
        assert unique.count() == keys
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE bucketed_pages")


def test_no_cross_joins_and_no_unbounded_windows(spark):
    """Windows in registered queries have keys, and no join is a cross join."""
    for name in ("w2_position_by_offset", "w3_position_running", "j1_category_context", "st1_endpoint_health", "flagship_best_placed"):
        text = plan(QUERIES[name](spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_scans_have_one_path(spark):
    """The plan is the same whatever the sizes of the keys, and windows have the chunk among their keys."""
    plans = []
    for key in (F.lit("hot"), F.col("id").cast("string")):
        df = spark.range(3000).select("id", key.alias("k"), (F.col("id") % 50).alias("at"))
        text = plan(scans.row_number(df, ["k"], "at", "id", "n"))
        plans.append([re.search(r"\w+", line)[0] for line in text.splitlines() if "Window" in line or "Join" in line])
        assert "_chunk" in text
    assert plans[0] == plans[1]


def test_scratch_is_deleted(spark, checkpoint_dir):
    rows = session.materialise(spark.range(5), "gone")
    kept = session.materialise(spark.range(5), "kept")
    session.discard(rows)
    assert not os.path.exists(rows._scratch) and os.path.exists(kept._scratch) and kept.count() == 5
    assert session.clear_scratch(spark) >= 1 and not os.path.exists(kept._scratch)


def test_hot_keys_are_dealt_over_salts(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"))
    lookup = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    found = joins.salted_lookup(rows, lookup, "k", F.col("id"), parts=10, salts=8)
    assert found.where("v != k * 2 OR v IS NULL").count() == 0 and found.count() == 1000


def test_half_of_the_rows_on_one_key_are_spread_evenly(spark):
    rows = spark.range(400_000).select("id", F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"))
    lookup = spark.range(-1, 400_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(before, ("false", "-1", "20"), strict=True):
            spark.conf.set(k, v)
        found = joins.salted_lookup(rows, lookup, "k", F.col("id")).where("v = k * 2")
        tasks = sorted(r["count"] for r in found.groupBy(F.spark_partition_id().alias("t")).count().collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(tasks) == 400_000 and len(tasks) == 20 and tasks[-1] <= 2 * tasks[10]


def test_salts_are_bounded(spark):
    counts = spark.createDataFrame([(k, 1 + 5_000_000 * (k == 0) + 40_000 * (0 < k < 200)) for k in range(5000)], "k int, count long")
    salts = [r.salts for r in joins.salts_of(counts, "k", 100).collect()]
    assert len(salts) < 400 and sum(salts) <= 16 * 100 + len(salts) and max(salts) > 500


def test_a_round_shuffles_only_its_frontier(spark):
    """Links and found nodes are read by their buckets; what is shuffled are the new nodes alone."""
    edges = spark.range(4000).select((F.col("id") % 50).alias("src"), F.when(F.col("id") % 3 == 0, F.col("id") % 97).otherwise(F.col("id")).alias("dst"))
    hot = spark.range(4000).select(F.lit(7).cast("long").alias("src"), (F.col("id") + 10_000).alias("dst"))
    seeds = spark.createDataFrame([(3,), (7,), (None,)], "node long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    graph = frontier.Adjacency(seeds, edges.unionByName(hot))
    try:
        assert {r.src for r in graph.salts.collect()} >= {7}
        assert graph.store(1)
        text = plan(graph.reached(2))
        moved = text.count("Exchange hashpartitioning")
        # The frontier, on its way to the salts and to the links, the salts, and the nodes it leads to.
        assert "Bucketed: true" in text and moved <= 4, text
        for line in text.split("Exchange hashpartitioning")[1:]:
            assert "dst" not in line.split("(")[1].split(",")[0]
        assert text.count("SelectedBucketsCount") == 2 or text.count("Bucketed: true") >= 2, text
        columns = {r.node for r in graph.reached(2).collect()}
    finally:
        graph.close()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    pairs = {(r.src, r.dst) for r in edges.unionByName(hot).collect()}
    one = {d for s, d in pairs if s in (3, 7)} - {3, 7}
    assert columns == {d for s, d in pairs if s in one} - one - {3, 7}


AWAY = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
import __spark_entry__ as entry
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", entry.queries()["htm1_extract_rules"](spark, sys.argv[2]).count())
"""


def test_workers_need_no_installed_package(tmp_path):
    """Workers start in a folder from which the package cannot be imported."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    done = subprocess.run(
        [sys.executable, "-c", AWAY, root, SF], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "rows " in done.stdout, done.stderr[-2000:]


def test_bodies_are_not_made_in_the_tasks_that_read_the_table(spark, tmp_path):
    """A filter on the body stays above the dealing: one file must not become one task of rendering."""
    from pagemart.operators import links
    from pagemart.registry import render

    rows = [(i, f"name {i}", "Brand#1", "KIND", float(i)) for i in range(400)]
    part = spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double")
    part.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    pages = render.product_pages(spark, str(tmp_path))
    own, _ = links.resolve_canonical(pages, links.canonical_href(pages["body"]))
    assert own.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert "Exchange" not in own._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.page_id for r in own.select("page_id").collect()) == [i for i in range(400) if i % 9 != 4]
