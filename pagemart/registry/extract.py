"""Registered queries: record extraction and the feeds built from it."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemart import constants as K
from pagemart.functions import text as X
from pagemart.operators import html_rules, joins
from pagemart.operators.html_rules import Rule
from pagemart.plans import catalog, flagship, menu, positions, producers, reviews, shops
from pagemart.registry import render as R
from pagemart.registry.base import query, spread_table, table
from pagemart.registry.sql import PROD, SITE, stamp

NAV_RULES = [Rule("heading", "article h1::text"), Rule("name", "nav li a::text"), Rule("href", "nav li > a::attr(href)")]


@query(
    "htm1_extract_rules",
    r"""WITH l AS (SELECT page_id, generate_subscripts(x, 1) AS ord, unnest(x) AS link FROM (
        SELECT page_id, regexp_extract_all(html, '<a\s[^>]*?href="[^"]*"[^>]*>.*?</a>') AS x FROM pages))
    SELECT page_id, 1 AS scope_no, 'heading' AS rule, 1 AS ord,
      replace(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '&amp;', '&') AS value FROM pages
    UNION ALL SELECT page_id, 1, 'href', CAST(ord AS INTEGER), regexp_extract(link, 'href="([^"]*)"', 1) FROM l
    UNION ALL SELECT page_id, 1, 'name', CAST(ord AS INTEGER), regexp_extract(link, '>([^<]*)</a>', 1) FROM l""",
)
def _(spark, sf):
    pages = spread_table(spark, sf, "pages", "page_id", "html")
    read = html_rules.extract_rules(pages, NAV_RULES, keep=("page_id",), body="html")
    return html_rules.rule_values(read, NAV_RULES, keep=("page_id",))


LISTING_SQL = f"""p_partkey AS wb_id, p_name AS product_name, reviews AS wb_reviews_count, {stamp('page_id')} AS parse_date,
    'wildberries' AS marketplace, '{SITE}/catalog/' || p_partkey || '/detail.aspx' AS product_url,
    category_url AS wb_category_url, p_type AS wb_category_name, brand AS wb_brand_name"""


def _listing(records):
    return records.select(
        "method", *catalog.LISTING_COLUMNS
    ).withColumns({"parse_date": X.iso_text(F.col("parse_date")), "wb_price": F.col("wb_price").cast("double")})


@query(
    "ext1_wb_listing_html",
    f"WITH {PROD} SELECT 'running' AS method, price AS wb_price, place AS wb_category_position, {LISTING_SQL} FROM prod",
)
def _(spark, sf):
    return _listing(positions.running(catalog.wb_listing_html(R.listing_html(spark, sf))))


OFFSET_SQL = """, firsts AS (SELECT p_type, count(*) FILTER (WHERE page_no = 1) AS cards FROM prod GROUP BY p_type)"""


@query(
    "ext2_wb_listing_json",
    f"""WITH {PROD}{OFFSET_SQL} SELECT 'offset' AS method, full_price AS wb_price,
    CAST((page_no - 1) * cards + position AS INTEGER) AS wb_category_position, {LISTING_SQL} FROM prod JOIN firsts USING (p_type)""",
)
def _(spark, sf):
    return _listing(positions.by_offset(catalog.wb_listing_json(R.listing_json(spark, sf))))


ORDERS_SQL = """CAST(CASE WHEN p_partkey % 2 = 0 THEN p_partkey % 50 WHEN p_partkey % 3 = 0 THEN p_partkey % 50 + 1000 END AS INTEGER)"""
COUNTRY_SQL = "CASE WHEN p_partkey % 6 = 0 THEN 'NATION_X' ELSE 'NATION_' || (p_partkey % 25) END"
MAKER_SQL = "CASE WHEN p_partkey % 8 <> 0 THEN 'NATION_' || (p_partkey * 3 % 25) END"


# Columns of a product record that its page gives, images and links aside.
PRODUCT_SQL = f"""{stamp('p_partkey')} AS parse_date, 'wildberries' AS marketplace,
      '{SITE}/catalog/' || p_partkey || '/detail.aspx' AS product_url, p_name AS product_name,
      p_partkey AS wb_id, reviews AS wb_reviews_count, {ORDERS_SQL} AS wb_purchases_count, price AS wb_price,
      (p_partkey % 50) / 10 AS wb_rating, brand AS wb_brand_name,
      '//img.example/' || (p_partkey % 25) || '.png' AS wb_brand_logo, '/brands/' || (p_partkey % 25) AS wb_brand_url,
      {COUNTRY_SQL} AS wb_brand_country, {MAKER_SQL} AS wb_manufacture_country,
      CASE WHEN p_partkey % 8 = 0 THEN 1 ELSE 2 END + CASE WHEN p_partkey % 10 = 0 THEN 1 ELSE 0 END AS n_features"""


@query(
    "ext3_wb_product_page",
    f"""WITH {PROD} SELECT {PRODUCT_SQL},
      '//img.example/big/new/' || p_partkey || '-1.jpg //img.example/big/new/' || p_partkey || '-2.jpg' AS image_urls,
      '{SITE}/catalog/' || p_partkey || '/otzyvy?field=Date&order=Asc&link=' || p_partkey AS reviews_url
    FROM prod WHERE p_partkey % 9 <> 4""",
)
def _(spark, sf):
    records = catalog.wb_product_page(R.product_pages(spark, sf))
    return records.withColumns(
        {
            "parse_date": X.iso_text(F.col("parse_date")), "image_urls": F.array_join("image_urls", " "),
            "wb_price": F.col("wb_price").cast("double"), "n_features": F.size("features"),
        }
    ).drop("page_id", "features", "wb_price_raw", "variant_urls")


@query(
    "ext4_wb_product_countries",
    f"""SELECT p_partkey AS wb_id, {COUNTRY_SQL} AS wb_brand_country, {MAKER_SQL} AS wb_manufacture_country
    FROM part WHERE p_partkey % 9 <> 4""",
)
def _(spark, sf):
    rules = [r for r in catalog.PRODUCT_RULES if r.name in ("article", "params", "param_values")]
    own, _ = catalog.links.resolve_canonical(
        R.product_pages(spark, sf), catalog.links.canonical_href(F.col("body"))
    )
    read = html_rules.extract_rules(own, rules).withColumn("features", catalog.features_of("params", "param_values"))
    return read.select(
        X.strip(html_rules.first_of("article")).cast("bigint").alias("wb_id"),
        F.try_element_at("features", F.lit(K.BRAND_COUNTRY)).alias("wb_brand_country"),
        F.try_element_at("features", F.lit(K.MAKER_COUNTRY)).alias("wb_manufacture_country"),
    )


@query(
    "ext5_ozon_listing",
    f"""WITH {PROD} SELECT {stamp('page_id')} AS parse_date, 'ozon' AS marketplace, p_name AS product_name,
      '/context/detail/id/' || p_partkey AS product_url, 'https://img.example/' || p_partkey || '.jpg' AS image_urls,
      CAST(p_partkey AS VARCHAR) AS ozon_id, CAST(p_partkey % 100 AS VARCHAR) AS ozon_seller_id,
      CAST(NULL AS VARCHAR) AS ozon_seller_name, CAST(p_partkey % 25 AS VARCHAR) AS ozon_brand_id,
      p_brand AS ozon_brand_name, CASE WHEN p_partkey % 2 = 0 THEN 'FBO' END AS ozon_delivery_schema,
      category_url AS ozon_category_url, p_type AS ozon_category_name,
      CAST(row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS INTEGER) AS ozon_category_position,
      CAST(NULL AS INTEGER) AS ozon_reviews_count, price AS ozon_price, CAST(NULL AS DOUBLE) AS ozon_rating,
      CAST(NULL AS VARCHAR) AS ozon_manufacture_country, CAST(NULL AS VARCHAR) AS ozon_first_review_date,
      CAST(NULL AS VARCHAR) AS ozon_last_review_date
    FROM prod WHERE page_no % 7 <> 0""",
)
def _(spark, sf):
    items = catalog.ozon_listing(R.widget_pages(spark, sf))
    placed = positions.running(items, "ozon_category_url", "ozon_category_position")
    return placed.withColumns(
        {
            "image_urls": F.array_join("image_urls", " "), "ozon_price": F.col("ozon_price").cast("double"),
            **{name: X.iso_text(F.col(name)) for name in ("parse_date", "ozon_first_review_date", "ozon_last_review_date")},
        }
    ).drop("page_id", "page_no", "position", "method")


# Columns of the product schema that a product page does not fill.
OZON_EMPTY = [
    "image_urls", "ozon_seller_id", "ozon_seller_name", "ozon_brand_id", "ozon_brand_name", "ozon_delivery_schema", "ozon_category_url",
    "ozon_category_name", "ozon_reviews_count", "ozon_manufacture_country", "ozon_first_review_date", "ozon_last_review_date",
]


@query(
    "ext6_ozon_product_page",
    f"""WITH {PROD} SELECT 'ozon' AS marketplace, p_name AS product_name, CAST(p_partkey AS VARCHAR) AS ozon_id,
      'https://www.ozon.ru/context/detail/id/' || p_partkey || '/' AS product_url, price AS ozon_price,
      (p_partkey % 50) / 10 AS ozon_rating, {", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in OZON_EMPTY)}
      FROM prod WHERE p_partkey % 10 <> 9""",
)
def _(spark, sf):
    records = catalog.ozon_product_page(R.ld_pages(spark, sf))
    records = records.withColumns({c: F.col(c).cast("string") for c in OZON_EMPTY})
    return records.withColumn("ozon_price", F.col("ozon_price").cast("double")).drop("page_id", "parse_date")


@query(
    "ext7_brand_directory",
    f"""SELECT 'wildberries' AS marketplace, p_brand AS brand_name, '{SITE}/brands/b' || p_partkey AS brand_url,
      CASE WHEN p_partkey % 2 = 0 THEN '//img.example/' || p_partkey || '.png' END AS image_url FROM part
    UNION ALL SELECT 'ozon', p_brand, 'https://www.ozon.ru/brand/b' || p_partkey || '/', NULL FROM part""",
)
def _(spark, sf):
    first = catalog.wb_brands(R.brand_pages(spark, sf))
    second = catalog.ozon_brands(R.brand_pages(spark, sf, second=True))
    return first.select(
        "marketplace", F.col("wb_brand_name").alias("brand_name"), F.col("wb_brand_url").alias("brand_url"),
        F.col("wb_image_url").alias("image_url"),
    ).unionByName(
        second.select(
            "marketplace", F.col("ozon_brand_name").alias("brand_name"), F.col("ozon_brand_url").alias("brand_url"),
            F.lit(None).cast("string").alias("image_url"),
        )
    )


@query(
    "ext8_menu_categories",
    r"""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '<a\s[^>]*?href="[^"]*"[^>]*>.*?</a>')) AS link FROM pages)
    SELECT page_id, 'wildberries' AS marketplace, regexp_extract(link, '>([^<]*)</a>', 1) AS wb_category_name,
      regexp_extract(link, 'href="([^"]*)"', 1) AS wb_category_url FROM l""",
)
def _(spark, sf):
    pages = spread_table(spark, sf, "pages", "page_id", "html").select("page_id", F.col("html").alias("body"), R.moment("page_id").alias("fetched_at"))
    return catalog.menu_categories(pages).drop("parse_date", "wb_category_level")


MENU_SQL = """cols AS (
      SELECT DISTINCT s_suppkey // 100 AS block, n_nationkey, n_name, n_regionkey, n_nationkey // 5 % 5 AS kind
      FROM supplier JOIN nation ON s_nationkey = n_nationkey
    ), titles AS (
      SELECT *, CASE kind WHEN 0 THEN n_name WHEN 2 THEN '' WHEN 4 THEN '' END AS mark FROM cols
    ), carried AS (
      SELECT t.*, r_name, coalesce(last_value(mark IGNORE NULLS) OVER (
        PARTITION BY block, n_regionkey ORDER BY n_nationkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS level_2
      FROM titles t JOIN region ON n_regionkey = r_regionkey)"""
TREE_SQL = f"""WITH {MENU_SQL}
    SELECT DISTINCT block, r_name AS level_1, NULL AS level_2, NULL AS level_3, '/r/' || n_regionkey AS link FROM carried
    UNION ALL SELECT block, r_name, n_name, NULL, '/n/' || n_nationkey FROM carried WHERE kind = 0
    UNION ALL SELECT c.block, r_name, level_2, s_name, '/s/' || s_suppkey FROM carried c
      JOIN supplier s ON s.s_nationkey = c.n_nationkey AND s.s_suppkey // 100 = c.block WHERE kind <> 2"""


@query("ext9_category_tree", TREE_SQL)
def _(spark, sf):
    return menu.category_rows(R.menu_pages(spark, sf)).drop("level", "known").withColumnRenamed("page_id", "block")


SUPP = """supp AS (SELECT *, s_suppkey // 50 AS block, CASE WHEN s_suppkey % 7 <> 0 THEN 'Street ' || (s_suppkey % 90) END AS street,
      printf('%d.%06d', s_suppkey % 60 + 1, s_suppkey * 7919 % 1000000) AS lat_text,
      printf('%d.%06d', s_suppkey % 120 + 2, s_suppkey * 104729 % 1000000) AS lon_text
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


@query(
    "ext10_producer_cards",
    f"""WITH {SUPP} SELECT min(s_suppkey) OVER (PARTITION BY r_name, block) AS from_page,
      CAST(row_number() OVER (PARTITION BY r_name, block ORDER BY s_suppkey) AS INTEGER) AS position,
      'https://productcenter.ru/producers/' || s_suppkey || '/maker' AS to_url,
      'https://productcenter.ru/producers/catalog-' || lower(r_name) AS category_url, r_name AS category_name,
      CAST(s_suppkey % 30 AS VARCHAR) AS goods_count FROM supp""",
)
def _(spark, sf):
    return producers.producer_cards(R.producer_category_pages(spark, sf))


# An office for the distance queries.
OFFICE = (48.137154, 11.576124)


def vincenty_sql(source: str, keys: str, rounds: int = 5) -> str:
    """Check SQL for the ellipsoid distance: CTEs that end in ``dist(keys, producer_distance)``."""
    f = "(1 / 298.257223563)"
    a, b = "6378.137", "6356.752314245"
    steps = [
        f"""v0 AS (SELECT {keys}, su1, cu1, sin(u2) AS su2, cos(u2) AS cu2, gap, gap AS lam FROM (
        SELECT *, sin(u1) AS su1, cos(u1) AS cu1 FROM (SELECT {keys}, atan((1 - {f}) * tan(radians({OFFICE[0]}))) AS u1,
          atan((1 - {f}) * tan(radians(lat))) AS u2, radians(lon) - radians({OFFICE[1]}) AS gap FROM {source})))"""
    ]
    sphere = """SELECT *, CASE WHEN c2 = 0 THEN 0 ELSE cs - 2 * su1 * su2 / c2 END AS mid FROM (
        SELECT *, 1 - sa * sa AS c2, atan2(ss, cs) AS sigma FROM (
          SELECT *, CASE WHEN ss = 0 THEN 0 ELSE cu1 * cu2 * sin(lam) / ss END AS sa FROM (
            SELECT *, sqrt(pow(cu2 * sin(lam), 2) + pow(cu1 * su2 - su1 * cu2 * cos(lam), 2)) AS ss,
              su1 * su2 + cu1 * cu2 * cos(lam) AS cs FROM {v})))"""
    for n in range(rounds):
        steps.append(
            f"""v{n + 1} AS (SELECT {keys}, su1, cu1, su2, cu2, gap,
          gap + (1 - k) * {f} * sa * (sigma + k * ss * (mid + k * cs * (2 * mid * mid - 1))) AS lam FROM (
          SELECT *, {f} / 16 * c2 * (4 + {f} * (4 - 3 * c2)) AS k FROM ({sphere.replace('{v}', f'v{n}')})))"""
        )
    steps.append(
        f"""dist AS (SELECT {keys}, round({b} * big * (sigma - small * ss * (mid + small / 4 * (cs * (2 * mid * mid - 1)
          - small / 6 * mid * (4 * ss * ss - 3) * (4 * mid * mid - 3)))), 2) AS producer_distance FROM (
        SELECT *, 1 + q / 16384 * (4096 + q * (-768 + q * (320 - 175 * q))) AS big,
          q / 1024 * (256 + q * (-128 + q * (74 - 47 * q))) AS small FROM (
          SELECT *, c2 * ({a} * {a} - {b} * {b}) / ({b} * {b}) AS q FROM ({sphere.replace('{v}', f'v{rounds}')}))))"""
    )
    return ", ".join(steps)


@query(
    "ext11_producer_page",
    f"""WITH {SUPP}, pt AS (SELECT s_suppkey, CAST(lat_text AS DOUBLE) AS lat, CAST(lon_text AS DOUBLE) AS lon FROM supp),
    {vincenty_sql('pt', 's_suppkey')}
    SELECT {stamp('s_suppkey')} AS parse_date, 'productcenter' AS marketplace,
      'https://productcenter.ru/producers/' || s_suppkey || '/maker' AS producer_url, s_name AS producer_name,
      '<div class="box_text"><p>About ' || s_name || '</p></div>' AS producer_about,
      concat_ws(' ', r_name, n_name, street) AS producer_address, lat_text || ', ' || lon_text AS producer_coords,
      producer_distance, '+7 ' || s_suppkey AS producer_phone,
      CASE WHEN s_suppkey % 3 = 0 THEN 'm' || s_suppkey || '@mail.example' END AS producer_email,
      'site' || s_suppkey || '.example' AS producer_website,
      'https://productcenter.ru/logo/' || s_suppkey || '.png' AS producer_logo, CAST(NULL AS VARCHAR) AS producer_rating,
      'https://productcenter.ru/files/' || s_suppkey || '.xls https://productcenter.ru/files/' || s_suppkey || '.pdf' AS producer_price_lists,
      'https://productcenter.ru/producers/catalog-' || lower(r_name) AS category_url, r_name AS category_name,
      CAST(s_suppkey % 30 AS VARCHAR) AS producer_goods_count
    FROM supp JOIN dist USING (s_suppkey) WHERE s_suppkey % 10 <> 3""",
)
def _(spark, sf):
    cards = producers.producer_cards(R.producer_category_pages(spark, sf))
    records = producers.producers(R.producer_pages(spark, sf), cards, OFFICE)
    return records.withColumns(
        {
            "parse_date": X.iso_text(F.col("parse_date")),
            "producer_price_lists": F.array_join("producer_price_lists", " "),
        }
    ).drop("page_id")


@query(
    "ext12_reviews",
    """SELECT conv_id AS imt_id, text, CAST(turn % 5 + 1 AS INTEGER) AS rating,
      strftime(DATE '2024-01-01' + CAST(turn % 1000 AS INTEGER), '%Y-%m-%d') || 'T00:00:00Z' AS created_at FROM conversations""",
)
def _(spark, sf):
    return reviews.reviews(R.review_batches(spark, sf), "imt_id").drop("page_id", "ord")


@query(
    "ext13_review_target",
    """SELECT p_partkey AS page_id, CASE WHEN p_partkey % 3 = 0 THEN p_partkey * 10 END AS imt_id,
      CAST(CASE WHEN p_partkey % 3 = 0 THEN p_partkey % 4000 ELSE 0 END AS INTEGER) AS feedbacks FROM part""",
)
def _(spark, sf):
    return reviews.review_targets(R.product_pages(spark, sf))


@query(
    "ext14_first_review_date",
    "SELECT o_custkey, strftime(min(o_orderdate), '%Y-%m-%d') AS wb_first_review_date FROM orders GROUP BY o_custkey",
)
def _(spark, sf):
    firsts = reviews.first_review_date(R.review_list_pages(spark, sf), "o_custkey")
    return firsts.groupBy("o_custkey").agg(F.min("wb_first_review_date").alias("wb_first_review_date"))


RAW_PRICE_SQL = """CASE WHEN p_partkey % 17 = 0 THEN NULL
      WHEN p_partkey % 3 = 0 THEN chr(160) || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) || chr(160) || chr(8381)
      WHEN p_partkey % 3 = 1 THEN CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) || ' ' || chr(8381)
      ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) END"""


@query(
    "ext15_shop_listing",
    f"""SELECT CAST(p_partkey AS VARCHAR) AS id, 'https://msk.shop.example/p/' || p_partkey AS url, p_type AS category_name,
      'https://msk.shop.example/catalog/' || lower(p_type) AS category_url, p_name AS name, {RAW_PRICE_SQL} AS price FROM part""",
)
def _(spark, sf):
    return shops.shop_listing(R.shop_listing_pages(spark, sf)).drop("page_id", "position")


@query(
    "ext16_shop_product",
    f"""SELECT {stamp('p_partkey')} AS parse_date, 'igrushki-optom' AS marketplace, CAST(p_partkey AS VARCHAR) AS id,
      'https://toys.example/products/' || p_partkey AS product_url, {RAW_PRICE_SQL} AS price,
      CASE WHEN p_partkey % 4 <> 0 THEN (p_partkey % 9) || 'x' || (p_partkey % 5) END AS dimensions,
      CAST(p_partkey % 100 AS VARCHAR) AS weight,
      '/pictures/big/' || p_partkey || '-1.jpg /pictures/big/' || p_partkey || '-2.jpg' AS pictures FROM part""",
)
def _(spark, sf):
    records = shops.shop_product(R.shop_product_pages(spark, sf))
    return records.withColumns(
        {"parse_date": X.iso_text(F.col("parse_date")), "pictures": F.array_join("pictures", " ")}
    ).drop("page_id")


@query(
    "ext17_shop_article",
    "SELECT p_partkey AS page_id, CAST(p_partkey AS VARCHAR) AS article, p_name AS vendor_code FROM part",
)
def _(spark, sf):
    return shops.shop_article(R.article_pages(spark, sf))


@query(
    "ext_rejected_pages",
    "SELECT 'product' AS job, count(*) AS rejected FROM part WHERE p_partkey % 9 = 4 "
    "UNION ALL SELECT 'data_block', count(*) FROM part WHERE p_partkey % 10 = 9",
)
def _(spark, sf):
    jobs = {
        "product": (R.product_pages(spark, sf), catalog.wb_product_page),
        "data_block": (R.ld_pages(spark, sf), catalog.ozon_product_page),
    }
    counts = [
        catalog.rejected(pages, job(pages)).agg(F.count("*").alias("rejected")).select(F.lit(name).alias("job"), "rejected")
        for name, (pages, job) in jobs.items()
    ]
    return counts[0].unionByName(counts[1])


@query(
    "feed_wb_products",
    f"""WITH {PROD}, rev AS (SELECT o_custkey AS k, min(o_orderdate) AS d1, max(o_orderdate) AS d2 FROM orders GROUP BY 1),
    found AS (SELECT p_partkey - CASE WHEN p_partkey % 9 = 4 THEN 1 ELSE 0 END AS own, p_type AS kind, position AS spot, page_id AS origin FROM prod),
    ctx AS (SELECT own, arg_min(kind, (spot, origin)) AS kind, min(spot) AS spot FROM found GROUP BY own)
    SELECT {PRODUCT_SQL}, CASE WHEN p_partkey % 5 IN (1, 2) AND (p_partkey - p_partkey % 5) % 9 <> 4
        THEN p_partkey - p_partkey % 5 END AS wb_parent_id, kind AS wb_category_name,
      '{SITE}/catalog/' || lower(kind) AS wb_category_url, spot AS wb_category_position, strftime(d1, '%Y-%m-%d') AS wb_first_review_date,
      strftime(d2, '%Y-%m-%d') AS wb_last_review_date
    FROM prod JOIN ctx ON own = p_partkey LEFT JOIN rev ON k = p_partkey WHERE p_partkey % 9 <> 4""",
)
def _(spark, sf):
    cards = catalog.wb_listing_html(R.listing_html(spark, sf))
    edges = cards.select(
        F.col("product_url").alias("to_url"), F.col("page_id").alias("from_page"), "position",
        F.col("wb_category_url").alias("category_url"), F.col("wb_category_name").alias("category_name"),
    )
    dated = table(spark, sf, "orders", "o_custkey", "o_orderdate").select(
        R.fill(SITE + "/catalog/{}/detail.aspx", "o_custkey").alias("product_url"), F.col("o_orderdate").alias("created_at")
    )
    feed = catalog.wb_products(R.product_pages(spark, sf), edges, dated, skip_images=True)
    return feed.withColumns(
        {
            "parse_date": X.iso_text(F.col("parse_date")), "wb_price": F.col("wb_price").cast("double"), "n_features": F.size("features"),
            **{c: F.date_format(c, "yyyy-MM-dd") for c in ("wb_first_review_date", "wb_last_review_date")},
        }
    ).drop("page_id", "kind", "features", "wb_price_raw")


@query(
    "flagship_best_placed",
    f"""WITH {PROD}, firsts AS (SELECT p_type, count(*) FILTER (WHERE page_no = 1) AS cards FROM prod GROUP BY p_type),
    placed AS (SELECT p_brand, p_type, p_partkey, (page_no - 1) * cards + position AS spot, full_price,
        CASE WHEN p_partkey % 13 <> 0 THEN p_brand END AS b FROM prod JOIN firsts USING (p_type)),
    best AS (SELECT b AS brand, count(*) AS products, min(spot) AS best_position FROM placed WHERE b IS NOT NULL GROUP BY b)
    SELECT brand, products, CAST(best_position AS INTEGER) AS best_position, wb_id, first_review_date FROM (
      SELECT best.*, p_partkey AS wb_id,
        (SELECT strftime(min(o_orderdate), '%Y-%m-%d') FROM orders WHERE o_custkey = p_partkey) AS first_review_date,
        row_number() OVER (PARTITION BY brand ORDER BY spot, p_partkey) AS n
      FROM best JOIN placed ON b = brand AND spot = best_position) WHERE n = 1""",
)
def _(spark, sf):
    dated = table(spark, sf, "orders", "o_custkey", "o_orderdate").select(
        F.col("o_custkey").alias("wb_id"), F.col("o_orderdate").alias("created_at")
    )
    best = flagship.best_placed(R.listing_json(spark, sf), dated)
    return best.select(
        "brand", "products", "best_position", "wb_id", F.date_format("first_review_date", "yyyy-MM-dd").alias("first_review_date")
    )
