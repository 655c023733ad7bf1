"""Registered queries: filters, joins, aggregates, windows, order and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemart import constants as K
from pagemart.functions import collections as C
from pagemart.functions import jsonx as J
from pagemart.functions import text as X
from pagemart.functions import urls as U
from pagemart.operators import filters, health, html_rules, joins, links, scans
from pagemart.operators.html_rules import Rule
from pagemart.operators.seen import SeenKeys
from pagemart.plans import catalog, menu, positions, reviews
from pagemart.registry import render as R
from pagemart.registry.base import query, table
from pagemart.registry.extract import COUNTRY_SQL, LISTING_SQL, MAKER_SQL, MENU_SQL, OFFSET_SQL
from pagemart.registry.sources_links import COPIES_SQL, LINK_SQL, _with_copies, quoted_pages
from pagemart.registry.sql import JUDGED, PROD, SITE, STATES, origin, text_of
from pagemart.session import scratch_path
from pagemart.sources import readers


def judged(spark, sf, policy=health.is_ban):
    return health.outcomes(R.fetch_log(spark, sf), policy)


def states(spark, sf):
    """(states at the log's newest moment, that moment); waits are long, so that some are still dead."""
    log = R.fetch_log(spark, sf)
    now = log.agg(F.max("ts")).scalar()
    return health.endpoint_state(health.outcomes(log), now, base=7200, cap=172800), now


# ---------------------------------------------------------------- filters


@query(
    "flt1_skip_details",
    f"""WITH {PROD}{OFFSET_SQL}, feed AS (
      SELECT 'running' AS method, price AS wb_price, place AS wb_category_position, {LISTING_SQL} FROM prod
      UNION ALL SELECT 'offset', full_price, CAST((page_no - 1) * cards + position AS INTEGER), {LISTING_SQL}
      FROM prod JOIN firsts USING (p_type))
    SELECT method, wb_id, product_name, wb_price, wb_category_position, product_url FROM feed""",
)
def _(spark, sf):
    feed = catalog.wb_listing(R.listing_html(spark, sf), R.listing_json(spark, sf))
    return feed.select(
        "method", "wb_id", "product_name", F.col("wb_price").cast("double").alias("wb_price"), "wb_category_position", "product_url"
    )


@query(
    "flt2_skip_images",
    "SELECT p_partkey AS wb_id, p_name AS product_name FROM part WHERE p_partkey % 9 <> 4",
)
def _(spark, sf):
    records = catalog.wb_product_page(R.product_pages(spark, sf), skip_images=True)
    assert "image_urls" not in records.columns
    return filters.skip_images(records, True).select("wb_id", "product_name")


@query("flt3_skip_variants", "SELECT p_partkey AS wb_id FROM part WHERE p_partkey % 9 <> 4 AND NOT (p_partkey % 5 IN (1, 2) AND (p_partkey - p_partkey % 5) % 9 <> 4)")
def _(spark, sf):
    key = F.col("p_partkey")
    parent = F.when((key % 5).isin(1, 2) & ((key - key % 5) % 9 != 4), key - key % 5)
    records = table(spark, sf, "part", "p_partkey").where(key % 9 != 4).select(
        key.alias("wb_id"), parent.alias("wb_parent_id")
    )
    return filters.skip_variants(records, True).select("wb_id")


@query(
    "flt4_only_region",
    """SELECT s_suppkey, CASE WHEN r_name = 'ASIA' THEN 'https://x.example/producers/asia-2/catalog-' || n_nationkey
      ELSE 'https://x.example/producers/asia-2/catalog-' || n_nationkey END AS url, r_name = 'ASIA' AS in_region
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def _(spark, sf):
    rows = R.suppliers(spark, sf).withColumn("region", F.col("r_name"))
    inside = filters.only_region(rows, "ASIA").select("s_suppkey", F.lit(True).alias("in_region"))
    url = F.when(
        F.col("r_name") == "ASIA", R.fill("https://x.example/producers/asia-2/catalog-{}", "n_nationkey")
    ).otherwise(R.fill("https://x.example/producers/catalog-{}", "n_nationkey"))
    limited = rows.select("s_suppkey", U.limit_to_region(url, R.REGION_SLUG).alias("url"))
    return limited.join(inside, "s_suppkey", "left").withColumn("in_region", F.coalesce("in_region", F.lit(False)))


@query(
    "flt5_drop_banners",
    f"""WITH {MENU_SQL} SELECT block, '' || n_regionkey AS menu_id, count(*) AS columns_kept, min(level_2) AS first_title
    FROM carried WHERE kind <> 2 GROUP BY block, n_regionkey""",
)
def _(spark, sf):
    columns = menu.carry_titles(menu.drop_banner_menus(menu.menu_columns(R.menu_pages(spark, sf), menu.COLUMN_RULES)))
    return menu.drop_banners(columns).groupBy(F.col("page_id").alias("block"), "menu_id").agg(
        F.count("*").alias("columns_kept"), F.min("level_2").alias("first_title")
    )


@query("flt6_drop_all_link", LINK_SQL + " WHERE text IS DISTINCT FROM 'the'")
def _(spark, sf):
    found = links.extract_links(quoted_pages(spark, sf), ("page_id",), "html")
    return catalog.drop_all_link(found, "text", "the")


@query(
    "flt7_only_url",
    "SELECT page_id, url FROM pages WHERE split_part(url, '?', 1) IN (SELECT split_part(url, '?', 1) FROM pages WHERE page_id % 10 = 3)",
)
def _(spark, sf):
    pages = table(spark, sf, "pages", "page_id", "url")
    key = U.strip_query(F.col("url"))
    wanted = pages.where("page_id % 10 = 3").select(key.alias("url_key")).distinct()
    return readers.only_urls(pages, wanted, key).select("page_id", "url")


@query(
    "flt8_key_contains",
    f"WITH {PROD} SELECT page_id, min(page_no) % 7 <> 0 AS has_widget FROM prod GROUP BY page_id",
)
def _(spark, sf):
    page = J.widget_page(F.col("body"))
    return R.widget_pages(spark, sf).select(
        "page_id", C.key_containing(page["widgetStates"], K.OZON_WIDGET_KEY).isNotNull().alias("has_widget")
    )


@query("flt9_is_ban", f"WITH {JUDGED} SELECT request_id, ban FROM judged")
def _(spark, sf):
    return judged(spark, sf).select("request_id", "ban")


@query("flt10_available_endpoints", f"WITH {STATES} SELECT proxy, state FROM states WHERE state IN ('good', 'unchecked')")
def _(spark, sf):
    return health.available(states(spark, sf)[0]).select("proxy", "state")


@query(
    "flt11_due_for_recheck",
    f"WITH {STATES} SELECT proxy, {text_of('next_check')} AS next_check FROM states, newest WHERE failed_attempts > 0 AND next_check <= now",
)
def _(spark, sf):
    found, now = states(spark, sf)
    return health.due_for_recheck(found, now).select("proxy", X.iso_text(F.col("next_check")).alias("next_check"))


# ---------------------------------------------------------------- joins


@query(
    "j1_category_context",
    """SELECT l_orderkey, l_linenumber, l_partkey, p_type AS category_name
    FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_partkey % 10 <> 0) ON l_partkey = p_partkey""",
)
def _(spark, sf):
    seen = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    context = table(spark, sf, "part", "p_partkey", "p_type").where("p_partkey % 10 <> 0").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("category_name")
    )
    return joins.salted_lookup(seen, context, "l_partkey", F.struct("l_orderkey", "l_linenumber"))


@query(
    "j1_first_listing",
    """SELECT p_partkey, l_orderkey AS first_order, l_linenumber AS position FROM part LEFT JOIN (
      SELECT l_partkey, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_partkey ORDER BY l_linenumber, l_orderkey) AS n
      FROM lineitem) ON l_partkey = p_partkey AND n = 1""",
)
def _(spark, sf):
    edges = table(spark, sf, "lineitem", "l_partkey", "l_orderkey", "l_linenumber").select(
        F.col("l_partkey").alias("p_partkey"), F.col("l_linenumber").alias("position"), F.col("l_orderkey").alias("from_page")
    )
    found = joins.category_context(table(spark, sf, "part", "p_partkey"), edges, "p_partkey", "from_page", "position")
    return found.withColumnRenamed("from_page", "first_order")


@query(
    "j2_variant_parent",
    """SELECT p_partkey AS wb_id, CASE WHEN p_partkey % 5 IN (1, 2) AND (p_partkey - p_partkey % 5) % 9 <> 4
      THEN p_partkey - p_partkey % 5 END AS wb_parent_id FROM part""",
)
def _(spark, sf):
    key = F.col("p_partkey")
    rows = table(spark, sf, "part", "p_partkey")
    products = rows.select(
        key.alias("wb_id"), R.fill(SITE + "/catalog/{}/detail.aspx", key).alias("product_url"),
        F.when((key % 5).isin(1, 2), "variant").otherwise("product").alias("kind"),
    )
    parents = rows.where((key % 5 == 0) & (key % 9 != 4))
    edges = parents.select(
        key.alias("from_page"), key.alias("parent_id"), F.explode(F.array(key + 1, key + 2)).alias("to")
    ).withColumn("to_url", R.fill(SITE + "/catalog/{}/detail.aspx", "to"))
    return catalog.with_parent(products, edges).select("wb_id", "wb_parent_id")


@query(
    "j3_attach_first_review",
    """SELECT c_custkey, strftime(min(o_orderdate), '%Y-%m-%d') AS first_review_date
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""",
)
def _(spark, sf):
    dated = table(spark, sf, "orders", "o_custkey", "o_orderdate").withColumnRenamed("o_custkey", "c_custkey")
    found = joins.attach_first(table(spark, sf, "customer", "c_custkey"), dated, "c_custkey", "o_orderdate", "first")
    return found.select("c_custkey", F.date_format("first", "yyyy-MM-dd").alias("first_review_date"))


@query(
    "j4_purchases_lookup",
    """SELECT p_partkey, n AS wb_purchases_count FROM part LEFT JOIN (
      SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey) ON l_partkey = p_partkey""",
)
def _(spark, sf):
    bought = table(spark, sf, "lineitem", "l_partkey", "l_returnflag").where("l_returnflag = 'R'").select(
        F.col("l_partkey").alias("p_partkey")
    )
    return joins.attach_count(table(spark, sf, "part", "p_partkey"), bought, "p_partkey", "wb_purchases_count")


@query(
    "j5_menu_lookup",
    """SELECT n_name, r_name AS top_menu, TRUE AS known FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_regionkey < 4
    UNION ALL SELECT n_name, NULL, FALSE FROM nation WHERE n_regionkey >= 4""",
)
def _(spark, sf):
    tops = table(spark, sf, "region").where("r_regionkey < 4").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("top_menu")
    )
    known, unknown = joins.menu_lookup(table(spark, sf, "nation"), tops, "n_regionkey")
    return known.select("n_name", "top_menu", F.lit(True).alias("known")).unionByName(
        unknown.select("n_name", F.lit(None).cast("string").alias("top_menu"), F.lit(False).alias("known"))
    )


@query(
    "j6_endpoint_by_hostport",
    f"""WITH p AS (SELECT page_id, url, regexp_replace({origin('url')}, '^[a-z]+://', '') AS host_port FROM pages),
    known AS (SELECT host_port, max_by('http://u' || page_id || ':p@' || host_port, page_id) AS endpoint
      FROM p WHERE page_id % 3 = 0 GROUP BY host_port)
    SELECT p.page_id, p.host_port, known.endpoint FROM p LEFT JOIN known USING (host_port)""",
)
def _(spark, sf):
    pages = table(spark, sf, "pages", "page_id", "url")
    host = U.host_port(F.col("url"))
    listed = pages.where("page_id % 3 = 0").select(
        F.col("page_id").alias("position"), R.fill("http://u{}:p@{}", "page_id", host).alias("endpoint")
    )
    return health.by_host_port(pages, listed, "url", F.col("page_id")).select("page_id", "host_port", "endpoint")


@query(
    "j7_not_seen_before",
    f"""WITH {COPIES_SQL}, seen AS (SELECT DISTINCT split_part(url, '?', 1) AS k FROM pages WHERE page_id % 4 = 1)
    SELECT page_id FROM (SELECT page_id, split_part(url, '?', 1) AS k,
      row_number() OVER (PARTITION BY split_part(url, '?', 1) ORDER BY fetched_at, page_id) AS n FROM copies)
    WHERE n = 1 AND k NOT IN (SELECT k FROM seen)""",
)
def _(spark, sf):
    key = U.strip_query(F.col("url"))
    seen = table(spark, sf, "pages", "page_id", "url").where("page_id % 4 = 1").select(key.alias("url_key"))
    return links.dedupe_pages(_with_copies(spark, sf), key, seen).select("page_id")


@query(
    "j8_seeded_only",
    f"""WITH {COPIES_SQL} SELECT page_id FROM copies WHERE split_part(url, '?', 1) IN (
      SELECT split_part(url, '?', 1) FROM pages WHERE page_id % 6 = 0)""",
)
def _(spark, sf):
    key = U.strip_query(F.col("url"))
    seeds = table(spark, sf, "pages", "page_id", "url").where("page_id % 6 = 0").select(key.alias("url_key"))
    return readers.only_urls(_with_copies(spark, sf), seeds, key).select("page_id")


# ---------------------------------------------------------------- aggregates


@query(
    "agg1_bans_by_status",
    f"WITH {JUDGED} SELECT status, count(*) AS bans FROM judged WHERE ban AND status IS NOT NULL GROUP BY status",
)
def _(spark, sf):
    return health.bans_by_status(judged(spark, sf))


@query(
    "agg2_bans_empty",
    f"WITH {JUDGED} SELECT count(*) AS bans_empty FROM judged WHERE ban AND status IS NOT NULL AND coalesce(body_len, 0) = 0",
)
def _(spark, sf):
    return health.bans_empty(judged(spark, sf))


@query(
    "agg3_bans_by_exception",
    f"WITH {JUDGED} SELECT exception, count(*) AS bans FROM judged WHERE ban AND exception IS NOT NULL GROUP BY exception",
)
def _(spark, sf):
    return health.bans_by_exception(judged(spark, sf))


@query(
    "agg4_endpoint_state_counts",
    f"""WITH {STATES} SELECT count(*) FILTER (WHERE state = 'good') AS good, count(*) FILTER (WHERE state = 'dead') AS dead,
      count(*) FILTER (WHERE state = 'unchecked' AND failed_attempts = 0) AS unchecked,
      count(*) FILTER (WHERE state = 'unchecked' AND failed_attempts > 0) AS reanimated FROM states""",
)
def _(spark, sf):
    return health.state_counts(states(spark, sf)[0])


@query("agg5_mean_backoff", f"WITH {STATES} SELECT coalesce(avg(backoff) FILTER (WHERE state = 'dead'), 0.0) AS mean_backoff FROM states")
def _(spark, sf):
    return health.mean_backoff(states(spark, sf)[0])


@query("agg6_cards_per_page", f"WITH {PROD} SELECT page_id, CAST(count(*) AS INTEGER) AS cards FROM prod GROUP BY page_id")
def _(spark, sf):
    rules = [Rule("cards", "::self(class)", each=".j-card-item")]
    read = html_rules.extract_rules(R.listing_html(spark, sf), rules, keep=("page_id",))
    return read.select("page_id", F.size("cards").alias("cards"))


@query(
    "agg7_take_first",
    r"""SELECT doc_id, list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda x: x <> '')[1] AS first_word FROM documents""",
)
def _(spark, sf):
    words = F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")
    return table(spark, sf, "documents", "doc_id", "text").select("doc_id", C.take_first(words).alias("first_word"))


@query(
    "agg8_collect_features",
    f"""WITH f AS (SELECT p_partkey AS page_id, 'Страна бренда' AS name, {COUNTRY_SQL} AS value FROM part
      UNION ALL SELECT p_partkey, 'Страна производитель', {MAKER_SQL} FROM part WHERE p_partkey % 8 <> 0
      UNION ALL SELECT p_partkey, 'no value', NULL FROM part WHERE p_partkey % 10 = 0)
    SELECT * FROM f""",
)
def _(spark, sf):
    rules = [r for r in catalog.PRODUCT_RULES if r.name in ("params", "param_values")]
    read = html_rules.extract_rules(R.product_pages(spark, sf), rules, keep=("page_id",))
    return read.select("page_id", F.explode(catalog.features_of("params", "param_values")).alias("name", "value"))


@query("agg9_first_match", "SELECT p_partkey AS page_id, CASE WHEN p_partkey % 10 <> 9 THEN p_name END AS product_name FROM part")
def _(spark, sf):
    return R.ld_pages(spark, sf).select("page_id", J.ld_product(F.col("body"))["name"].alias("product_name"))


# ---------------------------------------------------------------- windows and order


@query("w1_position_on_page", f"WITH {PROD} SELECT page_id, p_partkey AS wb_id, position FROM prod")
def _(spark, sf):
    return catalog.wb_listing_json(R.listing_json(spark, sf)).select("page_id", "wb_id", "position")


@query(
    "w2_position_by_offset",
    f"""WITH {PROD}{OFFSET_SQL} SELECT p_partkey AS wb_id, CAST((page_no - 1) * cards + position AS INTEGER) AS wb_category_position,
      'offset' AS method FROM prod JOIN firsts USING (p_type)""",
)
def _(spark, sf):
    cards = catalog.wb_listing_json(R.listing_json(spark, sf))
    return positions.by_offset(cards).select("wb_id", "wb_category_position", "method")


@query("w3_position_running", f"WITH {PROD} SELECT p_partkey AS wb_id, place AS wb_category_position, 'running' AS method FROM prod")
def _(spark, sf):
    cards = catalog.wb_listing_json(R.listing_json(spark, sf))
    return positions.running(cards).select("wb_id", "wb_category_position", "method")


@query(
    "w4_attempt_no",
    f"""WITH {JUDGED}, g AS (SELECT *, count(*) FILTER (WHERE NOT ban) OVER w AS request FROM judged
      WINDOW w AS (PARTITION BY url ORDER BY ts, request_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    n AS (SELECT request_id, url, (row_number() OVER (PARTITION BY url, request ORDER BY ts, request_id) - 1) % 6 + 1 AS n FROM g WHERE ban)
    SELECT request_id, url, n AS attempt_no, n <= 5 AS retry FROM n""",
)
def _(spark, sf):
    return health.attempts(judged(spark, sf)).select("request_id", "url", "attempt_no", "retry")


@query(
    "w5_carry_section_title",
    f"""WITH {MENU_SQL} SELECT block, '' || n_regionkey AS menu_id, level_2, count(*) AS columns FROM carried GROUP BY ALL""",
)
def _(spark, sf):
    columns = menu.menu_columns(R.menu_pages(spark, sf), menu.COLUMN_RULES)
    carried = menu.carry_titles(menu.drop_banner_menus(columns))
    return carried.groupBy(F.col("page_id").alias("block"), "menu_id", "level_2").agg(F.count("*").alias("columns"))


@query(
    "w5_carry_last_value",
    """SELECT l_orderkey, l_linenumber, coalesce(last_value(CASE WHEN l_linenumber % 3 = 0 THEN l_partkey END IGNORE NULLS) OVER (
      PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey * 8 + l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1)
      AS carried FROM lineitem""",
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate").withColumn(
        "row_id", F.col("l_orderkey") * 8 + F.col("l_linenumber")
    )
    own = F.when(F.col("l_linenumber") % 3 == 0, F.col("l_partkey"))
    found = scans.running(rows, ["l_suppkey"], "l_shipdate", "row_id", last=("last", own))
    return found.select("l_orderkey", "l_linenumber", F.coalesce("last", F.lit(-1)).alias("carried"))


@query(
    "w6_failures_in_a_row",
    f"""WITH {JUDGED}, g AS (SELECT *, count(*) FILTER (WHERE NOT ban) OVER w AS run FROM judged
      WINDOW w AS (PARTITION BY proxy ORDER BY ts, request_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT request_id, proxy, CAST(count(*) FILTER (WHERE ban) OVER (PARTITION BY proxy, run ORDER BY ts, request_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS failures FROM g""",
)
def _(spark, sf):
    return health.failures_in_a_row(judged(spark, sf)).select("request_id", "proxy", "failures")


@query(
    "ord1_reviews_by_date",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS created_at,
      row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS place FROM orders""",
)
def _(spark, sf):
    rows = table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    placed = scans.row_number(rows, [], "o_orderdate", "o_orderkey", "place")
    return placed.orderBy("o_orderdate", "o_orderkey").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("created_at"), "place"
    )


@query(
    "ord2_skip_take",
    """SELECT conv_id, turn, row_number() OVER (PARTITION BY role ORDER BY turn, conv_id) AS place,
      (row_number() OVER (PARTITION BY role ORDER BY turn, conv_id) - 1) // 100 AS batch FROM conversations""",
)
def _(spark, sf):
    rows = table(spark, sf, "conversations", "conv_id", "turn", "role")
    return reviews.batch_numbers(rows, ["role"], "turn", "conv_id", 100).select("conv_id", "turn", "place", "batch")


@query(
    "ord2_one_batch",
    """SELECT conv_id, turn, place FROM (
      SELECT conv_id, turn, row_number() OVER (ORDER BY turn, conv_id) AS place FROM conversations WHERE role = 'user')
    WHERE place > 100 AND place <= 150""",
)
def _(spark, sf):
    rows = table(spark, sf, "conversations", "conv_id", "turn", "role")
    stored = scans.SortedRows(spark, scratch_path(spark, "sorted")).store(rows, ["role"], "turn", "conv_id")
    return stored.batch(100, 50, role="user").select("conv_id", "turn", "place")


@query(
    "ord3_first_of_sorted",
    "SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_review FROM orders GROUP BY o_custkey",
)
def _(spark, sf):
    return table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate").groupBy("o_custkey").agg(
        F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("first_review")
    )


@query(
    "j7_across_runs",
    """SELECT 'https://shop.example/i/' || p_partkey AS url_key FROM part
    WHERE p_partkey NOT IN (SELECT s_suppkey FROM supplier) AND p_partkey NOT IN (SELECT c_custkey FROM customer)""",
)
def _(spark, sf):
    addresses = lambda name, key: table(spark, sf, name, key).select(R.fill("https://shop.example/i/{}", key).alias("url_key"))
    seen = SeenKeys(spark, scratch_path(spark, "seen"), buckets=16)
    seen.add(addresses("supplier", "s_suppkey"), "url_key", "first")
    seen.add(addresses("customer", "c_custkey"), "url_key", "second")
    return seen.unseen(addresses("part", "p_partkey"), "url_key")


# ---------------------------------------------------------------- sets


@query(
    "set1_union_outputs",
    """SELECT 'wildberries' AS marketplace, p_name AS product_name, NULL AS producer_name FROM part
    UNION ALL SELECT 'productcenter', NULL, s_name FROM supplier""",
)
def _(spark, sf):
    goods = table(spark, sf, "part", "p_name").select(F.lit(K.WB).alias("marketplace"), F.col("p_name").alias("product_name"))
    makers = table(spark, sf, "supplier", "s_name").select(
        F.lit("productcenter").alias("marketplace"), F.col("s_name").alias("producer_name")
    )
    return filters.union_feeds(goods, makers)


@query(
    "set2_union_states",
    f"WITH {STATES} SELECT proxy FROM states WHERE state = 'unchecked' UNION SELECT proxy FROM states WHERE state = 'good'",
)
def _(spark, sf):
    return health.available(states(spark, sf)[0]).select("proxy").distinct()
