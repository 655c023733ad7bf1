"""Registered queries: sources, sinks, links and frontier."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemart import session
from pagemart.functions import text as X
from pagemart.functions import urls as U
from pagemart.operators import frontier, html_rules, links
from pagemart.operators.html_rules import Rule
from pagemart.plans import catalog, shops
from pagemart.registry import render as R
from pagemart.registry.base import query, table
from pagemart.registry.sql import LOG, PROD, SITE, origin, stamp, text_of
from pagemart.session import scratch_path
from pagemart.sources import readers, sinks


@query("src1_captured_pages", "SELECT page_id, url, CAST(length(html) AS INTEGER) AS n_chars FROM pages")
def _(spark, sf):
    pages = readers.captured_pages(spark, f"{sf}/pages.parquet", "page_id", "url", "html")
    return pages.select("page_id", "url", F.length("html").alias("n_chars"))


@query(
    "src2_seed_urls",
    """WITH o AS (SELECT url, page_id % 5 AS k FROM pages)
    SELECT 'category' AS kind, unnest([url, url || '&n=2']) AS url FROM o WHERE k = 0
    UNION ALL SELECT 'product', url FROM o WHERE k IN (1, 2)
    UNION ALL SELECT 'sitemap', url || '/sitemap' FROM o WHERE k = 3
    UNION ALL SELECT 'menu', url || '/menu' FROM o WHERE k = 4""",
)
def _(spark, sf):
    k, url = F.col("page_id") % 5, F.col("url")
    options = table(spark, sf, "pages", "page_id", "url").select(
        F.when(k == 0, F.concat(url, F.lit(","), url, F.lit("&n=2"))).alias("category_url"),
        F.when(k <= 2, url).alias("good_url"),
        F.when(k == 3, F.lit(True)).alias("use_sitemap"),
        F.concat(url, F.lit("/sitemap")).alias("sitemap_url"),
        F.concat(url, F.lit("/menu")).alias("menu_url"),
    )
    return readers.seed_urls(options)


@query(
    "src3_endpoint_list",
    f"""WITH p AS (SELECT page_id % 5 AS k, {origin('url')} AS o FROM pages)
    SELECT DISTINCT endpoint FROM (
      SELECT 'http://' || regexp_replace(o, '^[a-z]+://', '') AS endpoint FROM p WHERE k = 1
      UNION ALL SELECT unnest([o, o || ':8080']) FROM p WHERE k >= 3)""",
)
def _(spark, sf):
    k, host = F.col("page_id") % 5, U.origin(F.col("url"))
    lines = table(spark, sf, "pages", "page_id", "url").select(
        F.when(k == 0, F.concat(F.lit("# "), host))
        .when(k == 1, F.concat(F.lit("  "), F.regexp_replace(host, "^[a-z]+://", "")))
        .when(k == 2, F.lit(" "))
        .otherwise(F.concat(host, F.lit(" , "), host, F.lit(":8080,")))
        .alias("value")
    )
    return readers.endpoint_list(lines)


@query(
    "src4_fetch_log",
    f"WITH {LOG} SELECT request_id, url, proxy, {text_of('ts')} AS ts, status, body_len, exception FROM log",
)
def _(spark, sf):
    return R.fetch_log(spark, sf).withColumn("ts", X.iso_text(F.col("ts")))


@query(
    "snk1_write_json",
    f"""WITH {PROD} SELECT p_partkey AS wb_id, p_name AS product_name, full_price AS wb_price,
    {stamp('page_id')} AS parse_date FROM prod""",
)
def _(spark, sf):
    records = catalog.wb_listing_json(R.listing_json(spark, sf)).select(
        "wb_id", "product_name", F.col("wb_price").cast("double").alias("wb_price"), "parse_date"
    )
    path = session.scratch_path(spark, "feed")
    sinks.write_json(sinks.feed_view(records, "parse_date"), path)
    return spark.read.schema("wb_id bigint, product_name string, wb_price double, parse_date string").json(path)


@query(
    "snk2_write_csv",
    "SELECT p_type AS level_1, p_brand AS level_2, p_name AS level_3, '/p/' || p_partkey || ';x' AS link FROM part",
)
def _(spark, sf):
    rows = table(spark, sf, "part").select(
        F.col("p_type").alias("level_1"), F.col("p_brand").alias("level_2"), F.col("p_name").alias("level_3"),
        R.fill("/p/{};x", "p_partkey").alias("link"),
    )
    path = session.scratch_path(spark, "levels")
    sinks.write_csv(rows, path)
    schema = "level_1 string, level_2 string, level_3 string, link string"
    return spark.read.schema(schema).option("sep", ";").option("header", True).csv(path)


@query(
    "snk_feed_of_batches",
    """SELECT 'supplier' AS kind, s_suppkey AS id, s_name AS name FROM supplier
    UNION ALL SELECT 'part', p_partkey, p_name FROM part""",
)
def _(spark, sf):
    path, schema = scratch_path(spark, "feed"), "kind string, id bigint, name string"
    rows = lambda kind, key, name: table(spark, sf, kind, key, name).select(F.lit(kind).alias("kind"), F.col(key).alias("id"), F.col(name).alias("name"))
    sinks.write_feed(rows("customer", "c_custkey", "c_name"), path)
    sinks.write_feed(rows("supplier", "s_suppkey", "s_name"), path)  # replaces the first
    sinks.write_feed(rows("part", "p_partkey", "p_name"), path, append=True)
    return sinks.read_feed(spark, path, schema)


@query(
    "snk3_run_summary",
    """SELECT event_type AS run, count(*) AS records, '0' AS job_id, event_type AS shop,
    CAST(count(*) + 1 AS VARCHAR) AS batch FROM events GROUP BY event_type""",
)
def _(spark, sf):
    counts = table(spark, sf, "events", "event_type").groupBy(F.col("event_type").alias("run")).agg(
        F.count("*").alias("records")
    )
    given = R.fill("shop={}&batch={}&batch={}", "run", "records", F.col("records") + 1)
    path = session.scratch_path(spark, "summary")
    sinks.write_json(sinks.run_summary(counts, given), path)
    stored = spark.read.schema("run string, records bigint, params map<string,string>").json(path)
    return stored.select(
        "run", "records", F.col("params.job_id").alias("job_id"), F.col("params.shop").alias("shop"),
        F.col("params.batch").alias("batch"),
    )


LINK_SQL = r"""WITH l AS (
    SELECT page_id, generate_subscripts(x, 1) AS ord, unnest(x) AS link FROM (
      SELECT page_id, regexp_extract_all(html, '(?s)<a\s[^>]*?href="[^"]*"[^>]*>.*?</a>') AS x FROM pages))
    SELECT page_id, CAST(ord AS INTEGER) AS ord, regexp_extract(link, 'href="([^"]*)"', 1) AS href,
      nullif(regexp_replace(regexp_extract(link, '(?s)^<a\s[^>]*>(.*)</a>$', 1), '<[^>]*>', '', 'g'), '') AS text
    FROM l"""


def quoted_pages(spark, sf):
    """The pages with their links written in each of the ways: double quotes, single quotes, bare after a data attribute."""
    html = F.col("html")
    single = F.regexp_replace(html, '<a href="([^"]*)"', "<a href='$1'")
    bare = F.regexp_replace(html, '<a href="([^" >]+)"', '<a data-href="/no" title="a > b" HREF = $1')
    written = F.when(F.col("page_id") % 3 == 1, single).when(F.col("page_id") % 3 == 2, bare).otherwise(html)
    return table(spark, sf, "pages", "page_id", "html").withColumn("html", written)


@query("lnk1_extract_links", LINK_SQL)
def _(spark, sf):
    return links.extract_links(quoted_pages(spark, sf), ("page_id",), "html")


@query(
    "lnk2_listing_pages_by_total",
    f"""WITH {PROD}, c AS (
      SELECT p_type, page_no AS block, category_url || '/b' || page_no AS category_url, count(*) AS cards,
        count(*) * (page_no % 4 + 1) - page_no % 2 AS total, min(p_partkey) AS from_page
      FROM prod WHERE length(p_type) % 2 = 0 GROUP BY p_type, prod.page_no, prod.category_url)
    SELECT from_page, 'https://wbxcatalog-ru.wildberries.ru/nm-2-card/catalog?kind=' || p_type || '-' || block || '&page=' || page AS to_url,
      page, (page - 1) * cards AS "offset", category_url, p_type AS category_name
    FROM (SELECT *, unnest(generate_series(1, CAST(ceil(total / cards) AS BIGINT))) AS page FROM c WHERE cards > 0)""",
)
def _(spark, sf):
    return catalog.listing_edges(R.catalog_pages(spark, sf)).drop("kind")


@query(
    "lnk3_review_pages_by_total",
    """SELECT conv_id AS imt_id, unnest(generate_series(0, total - 1, 1000)) AS skip, 1000 AS take
    FROM (SELECT conv_id, count(*) * 900 AS total FROM conversations GROUP BY conv_id)""",
)
def _(spark, sf):
    totals = table(spark, sf, "conversations", "conv_id").groupBy(F.col("conv_id").alias("imt_id")).agg(
        (F.count("*") * 900).alias("total")
    )
    return links.review_pages_by_total(totals, F.col("total")).drop("total")


@query(
    "lnk4_next_page_edge",
    f"""WITH {PROD}, pg AS (SELECT DISTINCT page_id, category_url, page_no FROM prod)
    SELECT a.page_id AS from_page, a.category_url || '?page=' || (a.page_no + 1) AS to_url, b.page_id AS to_page
    FROM pg a LEFT JOIN pg b ON b.category_url = a.category_url AND b.page_no = a.page_no + 1""",
)
def _(spark, sf):
    pages = R.listing_html(spark, sf)
    found = html_rules.extract_rules(pages, [Rule("next", ".pager-bottom a.pagination-next::attr(href)")], keep=("page_id",))
    edges = found.select(F.col("page_id").alias("from_page"), F.explode("next").alias("to_url"))
    return links.follow(pages, edges).select("from_page", "to_url", "to_page")


@query(
    "lnk5_detail_edges",
    f"""WITH {PROD} SELECT page_id AS from_page, '{SITE}/catalog/' || p_partkey || '/detail.aspx' AS to_url, position,
    category_url, p_type AS category_name FROM prod""",
)
def _(spark, sf):
    cards = catalog.wb_listing_html(R.listing_html(spark, sf))
    return cards.select(
        F.col("page_id").alias("from_page"), F.col("product_url").alias("to_url"), "position",
        F.col("wb_category_url").alias("category_url"), F.col("wb_category_name").alias("category_name"),
    )


@query(
    "lnk6_variant_edges",
    f"""SELECT p_partkey AS from_page, '{SITE}/catalog/' || (p_partkey + d) || '/detail.aspx' AS to_url, p_partkey AS parent_id
    FROM part, (SELECT unnest([1, 2]) AS d) WHERE p_partkey % 5 = 0 AND p_partkey % 9 <> 4""",
)
def _(spark, sf):
    products = catalog.wb_product_page(R.product_pages(spark, sf), skip_images=True, keep=("kind",))
    return catalog.variant_edges(products)


@query(
    "lnk7_reachable_pages",
    """WITH RECURSIVE e AS (
      SELECT DISTINCT 'r' || n_regionkey AS src, 'n' || n_nationkey AS dst FROM nation
      UNION SELECT 'n' || s_nationkey, 's' || s_suppkey FROM supplier
      UNION SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier WHERE s_suppkey % 3 = 0
      UNION SELECT 's' || l_suppkey, 'p' || l_partkey FROM lineitem
    ), reach AS (
      SELECT 'r' || r_regionkey AS node FROM region WHERE r_regionkey < 2
      UNION SELECT e.dst FROM reach JOIN e ON e.src = reach.node)
    SELECT node FROM reach""",
)
def _(spark, sf):
    nation = table(spark, sf, "nation")
    supplier = table(spark, sf, "supplier", "s_suppkey", "s_nationkey")
    items = table(spark, sf, "lineitem", "l_suppkey", "l_partkey")
    edges = (
        nation.select(R.fill("r{}", "n_regionkey").alias("src"), R.fill("n{}", "n_nationkey").alias("dst"))
        .unionByName(supplier.select(R.fill("n{}", "s_nationkey").alias("src"), R.fill("s{}", "s_suppkey").alias("dst")))
        .unionByName(
            supplier.where("s_suppkey % 3 = 0").select(
                R.fill("s{}", "s_suppkey").alias("src"), R.fill("n{}", "s_nationkey").alias("dst")
            )
        )
        .unionByName(items.select(R.fill("s{}", "l_suppkey").alias("src"), R.fill("p{}", "l_partkey").alias("dst")))
    )
    seeds = table(spark, sf, "region").where("r_regionkey < 2").select(R.fill("r{}", "r_regionkey").alias("node"))
    return frontier.reachable_pages(seeds, edges).select("node")


@query(
    "lnk7_tree_edges",
    f"""WITH {PROD} SELECT page_id AS from_page, 'product' AS kind, position AS ord,
      'https://toys.example/products/' || p_partkey AS dst FROM prod
    UNION ALL SELECT DISTINCT page_id, 'next', 1, 'https://toys.example/c/' || p_type || '/' || (page_no + 1) FROM prod""",
)
def _(spark, sf):
    return shops.page_edges(R.tree_pages(spark, sf)).select("from_page", "kind", "ord", "dst")


def _with_copies(spark, sf):
    """``pages`` with two kinds of copies: every third page again later, every fourth earlier."""
    pages = table(spark, sf, "pages", "page_id", "url").withColumn("fetched_at", R.moment("page_id"))
    copy = pages.select(
        (F.col("page_id") + 1_000_000_000).alias("page_id"), F.concat("url", F.lit("?copy=1")).alias("url"),
        F.expr("fetched_at + (CASE WHEN page_id % 4 = 0 THEN -1 ELSE 1 END) * INTERVAL 1 DAY").alias("fetched_at"),
    )
    return pages.unionByName(copy.where("page_id % 3 = 0 OR page_id % 4 = 0"))


COPIES_SQL = """base AS (SELECT page_id, url, make_timestamp(CAST(1704067200 + page_id AS BIGINT) * 1000000) AS fetched_at FROM pages),
    copies AS (SELECT * FROM base UNION ALL
      SELECT page_id + 1000000000, url || '?copy=1', fetched_at + CASE WHEN page_id % 4 = 0 THEN -1 ELSE 1 END * INTERVAL 1 DAY
      FROM base WHERE (page_id + 1000000000) % 3 = 0 OR (page_id + 1000000000) % 4 = 0)"""


@query(
    "lnk8_dedupe_requests",
    f"""WITH {COPIES_SQL} SELECT page_id, url, url_key FROM (
      SELECT *, split_part(url, '?', 1) AS url_key,
        row_number() OVER (PARTITION BY split_part(url, '?', 1) ORDER BY fetched_at, page_id) AS n FROM copies) WHERE n = 1""",
)
def _(spark, sf):
    return links.dedupe_pages(_with_copies(spark, sf), U.strip_query(F.col("url"))).select("page_id", "url", "url_key")


@query(
    "lnk9_resolve_canonical",
    f"""SELECT page_id, page_id % 4 <> 1 AS is_record,
      CASE WHEN page_id % 4 = 1 THEN {origin('url')} || '/main' ELSE url END AS target FROM pages""",
)
def _(spark, sf):
    k, url = F.col("page_id") % 4, F.col("url")
    canonical = (
        F.when(k == 0, url).when(k == 1, F.lit("/main?from=nav")).when(k == 2, F.lit(None).cast("string"))
        .otherwise(U.absolutize_keep_query(url, url))
    )
    tag = F.when(canonical.isNotNull(), R.fill('<link href="{}" rel="canonical">', canonical))
    pages = table(spark, sf, "pages").withColumn("body", R.fill("{}{}", tag, "html")).drop("html")
    own, edges = links.resolve_canonical(pages, links.canonical_href(F.col("body")))
    return own.select("page_id", F.lit(True).alias("is_record"), F.col("url").alias("target")).unionByName(
        edges.select("page_id", F.lit(False).alias("is_record"), F.col("to_url").alias("target"))
    )


@query(
    "lnk10_route_by_kind",
    """SELECT min(p_partkey) AS page_id, p_type AS category_name, CASE WHEN length(p_type) % 2 = 0 THEN 'json' ELSE 'html' END AS branch
    FROM part GROUP BY p_type, p_partkey // 240""",
)
def _(spark, sf):
    by_json, by_html = catalog.route(R.catalog_pages(spark, sf))
    return by_json.select("page_id", "category_name", F.lit("json").alias("branch")).unionByName(
        by_html.select("page_id", "category_name", F.lit("html").alias("branch"))
    )
