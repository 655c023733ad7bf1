"""Registered queries: column expressions and JSON, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemart import constants as K
from pagemart.functions import collections as C
from pagemart.functions import geo
from pagemart.functions import jsonx as J
from pagemart.functions import text as X
from pagemart.functions import urls as U
from pagemart.plans import catalog, reviews
from pagemart.registry import render as R
from pagemart.registry.base import query, table
from pagemart.registry.extract import OFFICE, ORDERS_SQL, RAW_PRICE_SQL, SUPP, vincenty_sql
from pagemart.registry.sql import PROD, SITE, origin, strip, text_of


def urls(spark, sf, *more):
    return table(spark, sf, "pages", "page_id", "url", *more)


def nav(spark, sf):
    """Page links with their page's address: hrefs as they stand, some with commas and accents."""
    found = R.table(spark, sf, "pages", "page_id", "url", "html")
    hrefs = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    return found.select("page_id", "url", F.posexplode(hrefs).alias("ord", "href"))


NAV = """nav AS (SELECT page_id, url, CAST(generate_subscripts(x, 1) - 1 AS INTEGER) AS ord, unnest(x) AS href
    FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS x FROM pages))"""


@query("url1_strip_query", "SELECT page_id, split_part(url, '?', 1) AS bare FROM pages")
def _(spark, sf):
    return urls(spark, sf).select("page_id", U.strip_query(F.col("url")).alias("bare"))


@query(
    "url2_absolutize_keep_query",
    f"""WITH {NAV} SELECT page_id, ord, CASE WHEN ord % 3 = 0 THEN 'https://other.example' || href
      WHEN ord % 3 = 1 THEN '//cdn.example' || href ELSE {origin('url')} || href || '?q=1' END AS full_url FROM nav""",
)
def _(spark, sf):
    k = F.col("ord") % 3
    href = (
        F.when(k == 0, F.concat(F.lit("https://other.example"), "href")).when(k == 1, F.concat(F.lit("//cdn.example"), "href"))
        .otherwise(F.concat("href", F.lit("?q=1")))
    )
    return nav(spark, sf).select("page_id", "ord", U.absolutize_keep_query(href, F.col("url")).alias("full_url"))


@query(
    "url3_absolutize_path_only",
    f"""WITH {NAV} SELECT page_id, ord, {origin('url')} || CASE WHEN ord % 4 = 3 THEN '/up' || href ELSE href END AS full_url FROM nav""",
)
def _(spark, sf):
    k = F.col("ord") % 4
    href = (
        F.when(k == 0, F.concat(F.lit("https://other.example"), "href", F.lit("?a=1#b")))
        .when(k == 1, F.substr("href", F.lit(2)))
        .when(k == 2, F.concat("href", F.lit(";p=1?x=/y")))
        .otherwise(F.concat(F.lit("/up/gone/.."), "href"))
    )
    return nav(spark, sf).select("page_id", "ord", U.absolutize_path_only(href, F.col("url")).alias("full_url"))


@query("url4_product_id_from_url", "SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_partkey AS VARCHAR) END AS wb_id FROM part")
def _(spark, sf):
    key = F.col("p_partkey")
    url = F.when(key % 4 == 0, R.fill("/brands/{}", key)).otherwise(R.fill("/catalog/{}/detail.aspx?x=1", key))
    return table(spark, sf, "part", "p_partkey").select("p_partkey", U.product_id_from_url(url).alias("wb_id"))


@query("url5_product_url", "SELECT p_partkey, 'https://www.wildberries.ru/catalog/' || p_partkey || '/detail.aspx' AS product_url FROM part")
def _(spark, sf):
    base = F.lit(K.WB_LISTING_API)
    return table(spark, sf, "part", "p_partkey").select("p_partkey", U.product_url(base, F.col("p_partkey")).alias("product_url"))


@query(
    "url6_reviews_url",
    f"""SELECT p_partkey, '{SITE}/catalog/' || p_partkey || '/otzyvy?field=Date&order=Asc&link=' ||
      CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'L' || p_partkey END AS reviews_url FROM part""",
)
def _(spark, sf):
    key = F.col("p_partkey")
    link = F.when(key % 3 != 0, R.fill("L{}", key))
    return table(spark, sf, "part", "p_partkey").select(
        key, U.reviews_url(R.fill(SITE + "/catalog/{}/detail.aspx?a=1", key), link).alias("reviews_url")
    )


@query(
    "url7_listing_api_url",
    """SELECT page_id, 'https://wbxcatalog-ru.wildberries.ru/nm-2-card/catalog?' || url || '&page=' || page_id AS listing,
      'https://www.ozon.ru/api/composer-api.bx/page/json/v2?url=' || replace(url_encode(
        url || ' ~*?layout_container=categorySearchMegapagination&layout_page_index=1&page=1'), '%2F', '/') AS wrapped FROM pages""",
)
def _(spark, sf):
    url = F.col("url")
    return urls(spark, sf).select(
        "page_id", U.listing_api_url(url, F.col("page_id")).alias("listing"),
        U.wrap_in_api(U.first_page_params(F.concat(url, F.lit(" ~*")))).alias("wrapped"),
    )


@query(
    "url8_host_port",
    f"""WITH p AS (SELECT page_id, regexp_replace({origin('url')}, '^[a-z]+://', '') AS h FROM pages)
    SELECT page_id, CASE page_id % 6 WHEN 0 THEN h WHEN 1 THEN h WHEN 2 THEN h || ':7070' WHEN 3 THEN h || ':9191' WHEN 4 THEN NULL
      ELSE split_part(h, '.', 1) || ':6262' END AS host_port FROM p""",
)
def _(spark, sf):
    k, url = F.col("page_id") % 6, F.col("url")
    host = F.regexp_replace(U.origin(url), "^[a-z]+://", "")
    address = (
        F.when(k == 0, url).when(k == 1, host).when(k == 2, F.concat(host, F.lit(":7070")))
        .when(k == 3, R.fill("http://ann:pw@{}:9191/x", host)).when(k == 4, R.fill("http:/{}", host))
        .otherwise(R.fill("{}:6262", F.substring_index(host, ".", 1)))
    )
    return urls(spark, sf).select("page_id", U.host_port(address).alias("host_port"))


@query("url9_host_slot", f"SELECT page_id, lower(regexp_replace({origin('url')}, '^[a-z]+://', '')) AS slot FROM pages")
def _(spark, sf):
    shouted = F.concat(F.lit("http://u:p@"), F.upper(F.regexp_replace(U.origin(F.col("url")), "^[a-z]+://", "")), F.lit(":80/x"))
    return urls(spark, sf).select("page_id", U.host_slot(shouted).alias("slot"))


@query("str1_strip", f"SELECT doc_id, md5({strip('chr(160) || text || chr(8195)')}) AS stripped FROM documents")
def _(spark, sf):
    padded = F.concat(F.lit("\u00a0"), "text", F.lit("\u2003"))
    return table(spark, sf, "documents", "doc_id", "text").select("doc_id", F.md5(X.strip(padded)).alias("stripped"))


@query("str2_clear_price", f"WITH {PROD} SELECT p_partkey, price FROM prod")
def _(spark, sf):
    return R.products(spark, sf).select("p_partkey", X.clear_price(F.col("price_raw")).cast("double").alias("price"))


@query("str3_clear_reviews_count", f"WITH {PROD} SELECT p_partkey, reviews FROM prod")
def _(spark, sf):
    return R.products(spark, sf).select("p_partkey", X.clear_reviews_count(F.col("reviews_raw")).alias("reviews"))


@query("str4_full_size_image", "SELECT p_partkey, '//img.example/big/new/atm-' || p_partkey || '.jpg' AS image FROM part")
def _(spark, sf):
    small = R.fill("//img.example/tm/new/atm-{}.jpg", "p_partkey")
    return table(spark, sf, "part", "p_partkey").select("p_partkey", X.full_size_image(small).alias("image"))


@query("str5_full_size_image2", "SELECT p_partkey, '/pictures/big/' || p_partkey || '_big.jpg' AS image FROM part")
def _(spark, sf):
    small = R.fill("/pictures/xsmall/{}_xsmall.jpg", "p_partkey")
    return table(spark, sf, "part", "p_partkey").select("p_partkey", X.full_size_image2(small).alias("image"))


@query(
    "str6_collapse_script",
    r"""SELECT page_id, md5(regexp_replace(replace(html || ' routes', chr(10), ''), '[\s]{2,}', '', 'g')) AS flat FROM pages""",
)
def _(spark, sf):
    flat = X.collapse_script(F.concat("html", F.lit(" routes: routes,\nroutesDictionary: routesDictionary,routes")))
    return table(spark, sf, "pages", "page_id", "html").select("page_id", F.md5(flat).alias("flat"))


@query("str7_script_argument", "SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0 THEN '{a: ' || p_partkey || '}' END AS argument FROM part")
def _(spark, sf):
    key = F.col("p_partkey")
    script = F.when(key % 5 == 0, R.fill("wbxspa.init({a: {}});", key)).otherwise(R.fill("x();wb.spa.init({a: {}});y({});", key, key))
    return table(spark, sf, "part", "p_partkey").select(key, X.script_argument(script, "wb.spa.init").alias("argument"))


@query("str8_join_address", f"WITH {SUPP} SELECT s_suppkey, concat_ws(' ', r_name, n_name, street) AS address FROM supp")
def _(spark, sf):
    return R.suppliers(spark, sf).select("s_suppkey", X.join_address(F.col("r_name"), F.col("n_name"), F.col("street")).alias("address"))


@query(
    "str9_coords_from_text",
    f"""WITH {SUPP} SELECT s_suppkey, CASE WHEN s_suppkey % 5 <> 0 THEN -CAST(lat_text AS DOUBLE) END AS lat,
      CASE WHEN s_suppkey % 5 <> 0 THEN CAST(lon_text AS DOUBLE) END AS lon FROM supp""",
)
def _(spark, sf):
    found = R.fill("init(coordinates: [-{}, {}])", "lat", "lon")
    body = F.when(F.col("s_suppkey") % 5 == 0, F.lit("coordinates: []")).otherwise(found)
    point = X.coords_struct(X.coords_text(body))
    return R.suppliers(spark, sf).select("s_suppkey", point["lat"].alias("lat"), point["lon"].alias("lon"))


@query("str10_clean_article", "SELECT p_partkey, p_partkey || '/' || p_brand AS article FROM part")
def _(spark, sf):
    block = R.fill('<div class="prod--art">\n Артикул<span class="space"> </span> {} / {} </div>', "p_partkey", "p_brand")
    return table(spark, sf, "part", "p_partkey", "p_brand").select("p_partkey", X.clean_article(block).alias("article"))


@query(
    "str11_parse_params",
    """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'own' ELSE '0' END AS job_id, event_type AS kind,
      'x=' || event_id AS expr, CASE WHEN event_id % 3 = 0 THEN CAST(event_id + 1 AS VARCHAR) ELSE CAST(user_id AS VARCHAR) END AS who
    FROM events""",
)
def _(spark, sf):
    event = F.col("event_id")
    text = F.concat_ws(
        "&", R.fill("kind={}&expr=x={}&who={}&flag", "event_type", event, "user_id"),
        F.when(event % 3 == 0, R.fill("who={}", event + 1)), F.when(event % 5 == 0, F.lit("job_id=own")),
    )
    params = C.parse_params(text, job_id=F.lit(0))
    return table(spark, sf, "events", "event_id", "event_type", "user_id").withColumn("p", params).select(
        "event_id", *[F.try_element_at("p", F.lit(k)).alias(k) for k in ("job_id", "kind", "expr", "who")]
    )


@query("dat1_now_iso", f"SELECT event_id, {text_of('ts')} AS parse_date FROM events")
def _(spark, sf):
    return table(spark, sf, "events", "event_id", "ts").select("event_id", X.iso_text(F.col("ts")).alias("parse_date"))


@query("num1_ceil_div", "SELECT p_type, CAST(ceil(count(*) / 60) AS BIGINT) AS pages, CAST(NULL AS BIGINT) AS none FROM part GROUP BY p_type")
def _(spark, sf):
    totals = table(spark, sf, "part", "p_type").groupBy("p_type").agg(F.count("*").alias("n"))
    return totals.select(
        "p_type", X.ceil_div(F.col("n"), F.lit(60)).alias("pages"), X.ceil_div(F.col("n"), F.lit(0)).alias("none")
    )


@query("num2_exp_backoff", "SELECT event_id, least(3600.0, 300.0 * pow(2.0, least(event_id % 100, 60))) AS seconds FROM events")
def _(spark, sf):
    return table(spark, sf, "events", "event_id").select("event_id", X.exp_backoff(F.col("event_id") % 100).cast("double").alias("seconds"))


@query(
    "num3_backoff_jitter",
    """SELECT event_id, least(3600.0, 300.0 * pow(2.0, event_id % 8))
      * (CAST('0x' || substr(md5(user_id || '|' || event_id % 8 || '|7'), 1, 7) AS BIGINT) / 268435456.0) AS seconds FROM events""",
)
def _(spark, sf):
    wait = X.backoff_jitter(F.col("user_id"), F.col("event_id") % 8, seed=7)
    return table(spark, sf, "events", "event_id", "user_id").select("event_id", wait.alias("seconds"))


@query(
    "geo1_distance_km",
    f"""WITH {SUPP}, pt AS (SELECT s_suppkey, CAST(lat_text AS DOUBLE) AS lat, CAST(lon_text AS DOUBLE) AS lon FROM supp),
    {vincenty_sql('pt', 's_suppkey')} SELECT s_suppkey, producer_distance FROM dist""",
)
def _(spark, sf):
    rows = R.suppliers(spark, sf).select("s_suppkey", F.col("lat").cast("double"), F.col("lon").cast("double"))
    office = (F.lit(OFFICE[0]), F.lit(OFFICE[1]))
    return geo.with_distance(rows, office, (F.col("lat"), F.col("lon")), "producer_distance").drop("lat", "lon")


@query(
    "arr1_image_list",
    """SELECT p_partkey, '//i/big/' || p_partkey || '.jpg //i/big/2.jpg' AS images FROM part""",
)
def _(spark, sf):
    found = F.array(R.fill(" //i/tm/{}.jpg ", "p_partkey"), F.lit(None).cast("string"), F.lit("//i/tm/2.jpg\n"))
    images = C.map_compose(found, X.strip, X.full_size_image)
    return table(spark, sf, "part", "p_partkey").select("p_partkey", F.array_join(images, " ").alias("images"))


@query("arr2_link_list", f"SELECT page_id, {origin('url')} || '/files/a.xls ' || {origin('url')} || '/b.pdf' AS lists FROM pages")
def _(spark, sf):
    found = F.array(F.lit("/files/a.xls?v=1"), F.lit("http://elsewhere.example/b.pdf#top"))
    return urls(spark, sf).select(
        "page_id", F.array_join(C.map_compose(found, lambda u: U.absolutize_path_only(u, F.col("url"))), " ").alias("lists")
    )


@query("arr3_concat_images", "SELECT p_partkey, '/big/1 /big/2 /big/' || p_partkey AS pictures FROM part")
def _(spark, sf):
    shown, lazy = F.array(F.lit("/xsmall/1"), F.lit(" /xsmall/2 ")), F.array(R.fill("/xsmall/{}", "p_partkey"))
    images = C.map_compose(F.concat(shown, lazy), X.strip, X.full_size_image2)
    return table(spark, sf, "part", "p_partkey").select("p_partkey", F.array_join(images, " ").alias("pictures"))


@query(
    "arr4_map_compose",
    """SELECT doc_id, len(w) AS words, md5(array_to_string(w, ' ')) AS joined FROM (
      SELECT doc_id, list_transform(list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda x: len(x) > 3),
        lambda x: replace(x, 'e', '_')) AS w FROM documents)""",
)
def _(spark, sf):
    words = F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")
    kept = C.map_compose(words, lambda w: F.when(F.length(w) > 3, w), lambda w: F.replace(w, F.lit("e"), F.lit("_")))
    return table(spark, sf, "documents", "doc_id", "text").select(
        "doc_id", F.size(kept).cast("bigint").alias("words"), F.md5(F.array_join(kept, " ")).alias("joined")
    )


@query(
    "map1_features_map",
    "SELECT p_partkey, p_name AS name, CASE WHEN p_partkey % 2 = 0 THEN 'last' ELSE p_brand END AS brand, CASE WHEN p_partkey % 2 = 0 THEN 2 ELSE 2 END AS n FROM part",
)
def _(spark, sf):
    even = F.col("p_partkey") % 2 == 0
    names = F.when(even, F.array(F.lit("brand "), F.lit("name"), F.lit("brand"))).otherwise(F.array(F.lit("brand"), F.lit(" name")))
    values = F.when(even, F.array("p_brand", "p_name", F.lit(" last"))).otherwise(F.array("p_brand", "p_name"))
    rows = table(spark, sf, "part", "p_partkey", "p_name", "p_brand").select("p_partkey", names.alias("k"), values.alias("v"))
    features = catalog.features_of("k", "v")
    return rows.withColumn("f", features).select("p_partkey", "f.name", "f.brand", F.size("f").alias("n"))


# ---------------------------------------------------------------- JSON


@query("jsn1_json_rows", f"WITH {PROD} SELECT page_id, position - 1 AS at, p_partkey AS id, p_name AS name, full_price AS price FROM prod")
def _(spark, sf):
    rows = R.listing_json(spark, sf).select("page_id", F.posexplode(J.products(F.col("body"))).alias("at", "p"))
    return rows.select("page_id", "at", "p.id", "p.name", F.col("p.salePrice").cast("double").alias("price"))


@query(
    "jsn2_widget_rows",
    f"WITH {PROD} SELECT page_id, p_name AS title, '/context/detail/id/' || p_partkey AS link FROM prod WHERE page_no % 7 <> 0",
)
def _(spark, sf):
    items = J.widget_items(J.widget_page(F.col("body")))
    return R.widget_pages(spark, sf).select("page_id", F.explode(items).alias("i")).select(
        "page_id", F.col("i.cellTrackingInfo.title").alias("title"), "i.link"
    )


@query(
    "jsn3_optional_field",
    f"""WITH {PROD} SELECT DISTINCT page_id AS from_page, 'https://www.ozon.ru/api/composer-api.bx/page/json/v2?url=/category/'
      || lower(p_type) || '/%3Fpage%3D' || (page_no + 1) AS to_url FROM prod WHERE page_no % 5 <> 0 AND page_no % 7 <> 0""",
)
def _(spark, sf):
    return catalog.ozon_next_pages(R.widget_pages(spark, sf)).select("from_page", "to_url")


@query(
    "jsn4_json_ld_product",
    f"""SELECT p_partkey AS page_id, p_name AS name, CAST(p_partkey AS VARCHAR) AS sku,
      {RAW_PRICE_SQL} AS price FROM part WHERE p_partkey % 10 <> 9""",
)
def _(spark, sf):
    rows = R.ld_pages(spark, sf).select("page_id", J.ld_product(F.col("body")).alias("p")).where("p IS NOT NULL")
    return rows.select("page_id", "p.name", "p.sku", F.col("p.offers.Price").alias("price"))


def _scripts(spark, sf):
    """Product page scripts; every fourth holds a bare name as a value, which is not plain data."""
    key = F.col("p_partkey")
    bad = F.when(key % 4 == 0, F.lit("user: currentUser, ")).otherwise(F.lit(""))
    script = F.when(
        key % 3 == 0,
        R.fill("wb.spa.init({ {}routes: routes,\n router: {ssrModel: {'product': {imtId: {}, feedbacks: {}}}}});", bad, key * 10, key % 4000),
    )
    return table(spark, sf, "part", "p_partkey").select(key.alias("page_id"), script.alias("script"))


@query(
    "jsn5_embedded_state",
    """SELECT p_partkey AS page_id, CASE WHEN p_partkey % 3 = 0 AND p_partkey % 4 <> 0 THEN p_partkey * 10 END AS imt_id,
      p_partkey % 3 = 0 AND p_partkey % 4 = 0 AS rejected FROM part""",
)
def _(spark, sf):
    scripts = _scripts(spark, sf)
    bad = reviews.rejected_states(scripts, "script").select("page_id", F.lit(True).alias("rejected"))
    read = scripts.select("page_id", reviews.review_target(F.col("script"))["imt_id"].alias("imt_id"))
    return read.join(bad, "page_id", "left").withColumn("rejected", F.coalesce("rejected", F.lit(False)))


@query("jsn6_orders_count", f"SELECT p_partkey, {ORDERS_SQL} AS wb_purchases_count FROM part WHERE p_partkey % 9 <> 4")
def _(spark, sf):
    found = catalog.wb_product_page(R.product_pages(spark, sf), skip_images=True)
    return found.select(F.col("wb_id").alias("p_partkey"), "wb_purchases_count")
