"""Ordered scans and joins against brute force, with hot keys, ties and NULLs."""

import datetime as dt
import decimal
import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemart.functions import moments as M
from pagemart.operators import frontier, joins, links, scans


def make_rows(n, seed, days=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", None])
        moment = None if rng.random() < 0.05 else (3 if rng.random() < 0.5 else rng.randrange(days))
        rows.append((i, key, moment, rng.random() < 0.7, rng.randrange(-5, 9)))
    rng.shuffle(rows)
    return rows


def in_order(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    for key, group in groups.items():
        yield key, sorted(group, key=lambda r: (r[2] is None, r[2] or 0, r[0]))


SCHEMA = "id bigint, k string, at bigint, hit boolean, v int"


@pytest.mark.parametrize("n, seed, parts", [(1, 0, 4), (40, 1, 9), (900, 2, 30), (900, 3, 1), (900, 3, None)])
def test_scans_equal_brute_force(spark, n, seed, parts):
    rows = make_rows(n, seed)
    df = spark.createDataFrame(rows, SCHEMA)
    place, total, top, last, run = {}, {}, {}, {}, {}
    for _, group in in_order(rows):
        s, m, l, c = 0, None, None, 0
        for i, row in enumerate(group, 1):
            s += row[4]
            m = row[4] if m is None else max(m, row[4])
            l = row[4] if row[4] > 0 else l
            c = c + 1 if row[3] else 0
            place[row[0]], total[row[0]], top[row[0]], last[row[0]], run[row[0]] = i, s, m, l, c
    found = scans.running(
        df, ["k"], "at", "id", s=("sum", F.col("v")), m=("max", F.col("v")), l=("last", F.when(F.col("v") > 0, F.col("v"))),
        n=("sum", F.lit(1)), parts=parts,
    ).collect()
    assert len(found) == n
    assert {r.id: (r.n, r.s, r.m, r.l) for r in found} == {i: (place[i], total[i], top[i], last[i]) for i in place}
    streaks = scans.streak(df, ["k"], "at", "id", F.col("hit"), "run", parts).collect()
    assert {r.id: r.run for r in streaks} == run


ORDERS = {
    "bigint": lambda i: i, "decimal(38,20)": lambda i: decimal.Decimal(f"100000000000000000.{i:020d}"), "string": lambda i: f"m{i:03d}",
    "timestamp": lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=i), "double": lambda i: i / 7, "date": lambda i: dt.date(2024, 1, 1) + dt.timedelta(i),
}


@pytest.mark.parametrize("kind, tie", [(kind, "bigint") for kind in ORDERS] + [("string", "string")])
def test_any_order_type_at_any_number_of_ranges(spark, kind, tie):
    """One key with all rows; decimals that are equal as doubles; a NULL tie comes first."""
    rng = random.Random(kind)
    rows = [(i, "hot", None if i % 13 == 0 else rng.randrange(40), i % 3 == 0) for i in range(120)]
    own_tie = lambda i: None if i == 7 else f"r{i:03d}" if tie == "string" else i
    typed = [(i, k, None if at is None else ORDERS[kind](at), own_tie(i), hit) for i, k, at, hit in rows]
    df = spark.createDataFrame(typed, f"id bigint, k string, at {kind}, tie {tie}, hit boolean")
    place, run, wanted = 0, 0, {}
    for i, _, at, hit in sorted(rows, key=lambda r: (r[2] is None, r[2] or 0, r[0] != 7, r[0])):
        place, run = place + 1, run + 1 if hit else 0
        wanted[i] = (place, run)
    for parts in (1, 25):
        numbered = scans.row_number(df, ["k"], "at", "tie", "n", parts)
        found = scans.streak(numbered, ["k"], "at", "tie", F.col("hit"), "run", parts).collect()
        assert {r.id: (r.n, r.run) for r in found} == wanted, parts


def test_chunks_split_a_hot_value(spark):
    """Neither one key nor one order value may fill a chunk."""
    df = spark.range(4000).select("id", F.lit("hot").alias("k"), F.lit(7).alias("at"))
    sizes = [r["count"] for r in scans.chunked(df, ["k"], "at", "id", parts=8).groupBy("k", "_chunk").count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 4000 / 8 * 2.5
    df = spark.range(4000).select("id", F.lit("hot").alias("k"), (F.col("id") * 37 % 4000).alias("at"))
    sizes = [r["count"] for r in scans.chunked(df, ["k"], "at", "id", parts=8).groupBy("k", "_chunk").count().collect()]
    assert max(sizes) <= 4000 / 8 * 2.5


def test_empty_input(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert scans.row_number(df, ["k"], "at", "id", "n").collect() == []


@pytest.mark.parametrize("parts", [10, 1])
def test_global_order(spark, parts):
    df = spark.range(100).select("id", (F.col("id") % 7).alias("at"))
    found = {r.id: r.n for r in scans.row_number(df, [], "at", "id", "n", parts).collect()}
    assert found == {i: n for n, i in enumerate(sorted(range(100), key=lambda i: (i % 7, i)), 1)}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_lookup(spark, how):
    rows = [(i, 1 if i % 2 else (i % 9 if i % 8 else None)) for i in range(500)]
    df = spark.createDataFrame(rows, "id bigint, k int")
    lookup = spark.createDataFrame([(k, f"v{k}") for k in range(0, 6)], "k int, v string")
    found = joins.salted_lookup(df, lookup, "k", F.col("id"), how, parts=10, salts=4)
    wanted = {(i, k, f"v{k}" if k is not None and k < 6 else None) for i, k in rows}
    if how == "inner":
        wanted = {w for w in wanted if w[2]}
    got = [(r.id, r.k, r.v) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == wanted
    given = joins.salted_lookup(df, lookup, "k", F.col("id"), how, parts=10, salts=4, counts=df.groupBy("k").count())
    assert {(r.id, r.k, r.v) for r in given.collect()} == wanted


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 7), st.integers(0, 7)), max_size=20))
def test_reachable(spark, pairs):
    edges = spark.createDataFrame(pairs or [(0, 0)], "src int, dst int")
    seeds = spark.createDataFrame([(0,), (5,)], "node int")
    depth, newest, level = {0: 0, 5: 0}, {0, 5}, 0
    while newest:
        level += 1
        newest = {d for s, d in pairs if s in newest and d not in depth}
        depth.update(dict.fromkeys(newest, level))
    found = frontier.reachable_pages(seeds, edges).collect()
    assert sorted((r.node, r.depth) for r in found) == sorted(depth.items())


def test_explode_count(spark):
    df = spark.createDataFrame([("a", 0), ("b", -1), ("c", None), ("d", 1), ("e", 2500)], "k string, n bigint")
    found = links.explode_count(df, F.col("n"), "i").groupBy("k").agg(F.count("*").alias("c"), F.max("i").alias("m"), F.countDistinct("i").alias("d"))
    assert {(r.k, r.c, r.m, r.d) for r in found.collect()} == {("d", 1, 0, 1), ("e", 2500, 2499, 2500)}


def test_dedupe_keeps_one_per_key(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(i, f"u{i % 3 if i > 5 else 0}?q={i}", start + dt.timedelta(days=i % 4)) for i in range(-5, 30)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, fetched_at timestamp")
    key = F.substring_index("url", "?", 1)
    best = {}
    for i, url, at in rows:
        k = url.split("?")[0]
        best[k] = min(best.get(k, (dt.datetime(2099, 1, 1), 0)), (at, i))
    found = links.dedupe_pages(pages, key).collect()
    assert {(r.url_key, r.page_id) for r in found} == {(k, v[1]) for k, v in best.items()}
    seen = spark.createDataFrame([("u0",)], "url_key string")
    assert {r.url_key for r in links.dedupe_pages(pages, key, seen).collect()} == {"u1", "u2"}
    assert links.dedupe_pages(pages, key, allow_dupes=True).count() == 35


def test_canonical(spark):
    base = "https://s.example/p/1"
    bodies = {
        1: f'<link rel="canonical" href="{base}">', 2: "<link href='/p/1' rel=canonical>", 3: "<html>", 4: '<link rel="canonical" href="/p/9?x=1">',
        5: '<link rel="stylesheet" href="/a.css"><link rel="canonical" href="https://t.example/z">', 6: None,
    }
    pages = spark.createDataFrame([(i, base, b, "ctx") for i, b in bodies.items()], "page_id int, url string, body string, category_name string")
    own, edges = links.resolve_canonical(pages, links.canonical_href(F.col("body")))
    assert {r.page_id for r in own.collect()} == {1, 2, 3, 6}
    assert {(r.page_id, r.to_url, r.category_name) for r in edges.collect()} == {
        (4, "https://s.example/p/9", "ctx"), (5, "https://t.example/z", "ctx"),
    }


def test_moments(spark):
    day = dt.datetime(2024, 1, 1)
    pairs = [(t, i) for t in (None, dt.datetime(1960, 1, 1), day, day + dt.timedelta(microseconds=1)) for i in (-(2**63), -5, 0, 7, 2**63 - 1)]
    df = spark.createDataFrame(pairs, "t timestamp, i bigint").withColumn("m", M.moment(F.col("t"), F.col("i")))
    rows = df.withColumn("back", M.id_of(F.col("m"))).collect()
    assert [(r.t, r.i) for r in sorted(rows, key=lambda r: r.m)] == pairs
    assert all(r.back == r.i for r in rows)


@pytest.mark.parametrize("n, seed, parts", [(1, 0, 4), (900, 2, 30), (900, 3, None)])
def test_previous_and_row_number_equal_brute_force(spark, n, seed, parts):
    rows = make_rows(n, seed)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("v", F.when(F.col("v") > 0, F.col("v")))
    before = {r.id: r.b for r in scans.previous(df, ["k"], "at", "id", F.col("v"), "b", parts).collect()}
    place = {r.id: r.n for r in scans.row_number(df, ["k"], "at", "id", "n", parts).collect()}
    wanted, places = {}, {}
    for _, group in in_order(rows):
        for i, row in enumerate(group):
            wanted[row[0]] = (group[i - 1][4] if group[i - 1][4] > 0 else None) if i else None
            places[row[0]] = i + 1
    assert before == wanted and place == places


def test_positions_need_no_window_over_the_rows(spark):
    placed = scans.row_number(spark.createDataFrame(make_rows(50, 1), SCHEMA), ["k"], "at", "id", "n")
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "Aggregate" in plan.split("Window [")[1]


def test_a_batch_reads_its_ranges_only(spark, tmp_path):
    rng = random.Random(5)
    data = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, *range(40)]), n) for n in range(600)]
    df = spark.createDataFrame(data, "k string, o int, tie long").repartition(7)
    stored = scans.SortedRows(spark, str(tmp_path / "sorted")).store(df, ["k"], "o", "tie", parts=8)
    for key in ("a", "b", None, "missing"):
        own = sorted((r for r in data if r[0] == key), key=lambda r: (r[1] is None, r[1] or 0, r[2]))
        for skip, take in ((0, 10), (37, 50), (0, 1000), (590, 30), (5, 0)):
            got = sorted((r.place, r.tie) for r in stored.batch(skip, take, k=key).collect())
            assert got == [(skip + n + 1, r[2]) for n, r in enumerate(own[skip : skip + take])]
    every = spark.read.parquet(str(tmp_path / "sorted" / "rows")).select("_chunk").distinct().count()
    plan = stored.batch(0, 10, k="a")._jdf.queryExecution().optimizedPlan().toString()
    assert every > 4 and "_chunk" in plan
    read = {r.f for r in stored.batch(0, 10, k="a").select(F.input_file_name().alias("f")).collect()}
    assert len(read) <= 2
    files = stored.batch(0, 10, k="a")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in files and "_chunk" in files.split("PartitionFilters: [")[1].split("]")[0]


def test_sorted_rows_without_keys_and_empty(spark, tmp_path):
    df = spark.range(100).select(F.col("id").alias("tie"), (F.col("id") % 7).alias("o"))
    stored = scans.SortedRows(spark, str(tmp_path / "all")).store(df, [], "o", "tie", parts=5)
    own = sorted(range(100), key=lambda n: (n % 7, n))
    assert sorted((r.place, r.tie) for r in stored.batch(20, 30).collect()) == [(n + 1, own[n]) for n in range(20, 50)]
    empty = scans.SortedRows(spark, str(tmp_path / "none")).store(df.limit(0), [], "o", "tie")
    assert empty.batch(0, 5).count() == 0
