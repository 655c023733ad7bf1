"""Registered queries: endpoint state, retries, streams and user extension points."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemart.functions import text as X
from pagemart.functions import urls as U
from pagemart.operators import health, html_rules
from pagemart.operators.html_rules import Rule
from pagemart.plans import catalog, shops
from pagemart.registry import render as R
from pagemart.registry.base import query, spread_table, table
from pagemart.registry.filters_joins import judged, states
from pagemart.registry.sql import JUDGED, LOG, PROD, STATES, strip, text_of
from pagemart.session import scratch_path
from pagemart.streaming import jobs

ST1_COLUMNS = f"proxy, state, failed_attempts, backoff, {text_of('next_check')} AS next_check"


def _paths(spark, name):
    """A table and a checkpoint of their own for each run of a query."""
    return scratch_path(spark, name), scratch_path(spark, f"{name}-state")


def _shown(found):
    return found.withColumn("next_check", X.iso_text(F.col("next_check")))


@query("st1_endpoint_health", f"WITH {STATES} SELECT {ST1_COLUMNS} FROM states")
def _(spark, sf):
    return _shown(states(spark, sf)[0])


# The stream has seen all but the watermark's delay when it ends.
AS_OF_WATERMARK = STATES.replace("SELECT max(ts) AS now", "SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE AS now")


@query(
    "st2_endpoint_health_stream",
    f"WITH {AS_OF_WATERMARK} SELECT proxy, state, failed_attempts, {text_of('next_check')} AS next_check FROM states",
)
def _(spark, sf):
    # Several files in order of arrival, each with rows up to five minutes late.
    events = table(spark, sf, "events")
    arrival = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) + F.pmod(F.xxhash64("event_id"), F.lit(300_000_000))) / 1_000_000)
    parted = scratch_path(spark, "arrivals")
    events.repartitionByRange(4, arrival).write.parquet(parted)
    log = R.fetch_log_of(jobs.file_stream(spark, parted, 1))
    return _shown(jobs.final_health(log, *_paths(spark, "health"), base=7200, cap=172800))


@query(
    "st3_ban_counters_stream",
    f"""WITH {JUDGED} SELECT {text_of("time_bucket(INTERVAL 30 SECOND, ts, TIMESTAMP '2000-01-01')")} AS window_start, status,
      count(*) AS bans FROM judged WHERE ban AND status IS NOT NULL GROUP BY ALL""",
)
def _(spark, sf):
    log = R.fetch_log_of(jobs.file_stream(spark, f"{sf}/events.parquet"))
    return jobs.final_counters(log, *_paths(spark, "counters")).withColumn("window_start", X.iso_text(F.col("window_start")))


@query(
    "st4_incremental_items",
    r"""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '<a\s[^>]*?href="[^"]*"[^>]*>.*?</a>')) AS link FROM pages)
    SELECT page_id, regexp_extract(link, '>([^<]*)</a>', 1) AS wb_category_name, regexp_extract(link, 'href="([^"]*)"', 1) AS wb_category_url
    FROM l""",
)
def _(spark, sf):
    pages = jobs.file_stream(spark, f"{sf}/pages.parquet").select(
        "page_id", F.col("html").alias("body"), R.moment("page_id").alias("fetched_at")
    )
    return jobs.incremental_items(pages, catalog.menu_categories, *_paths(spark, "items")).select("page_id", "wb_category_name", "wb_category_url")


@query("st5_dedupe_stream", "SELECT DISTINCT split_part(url, '?', 1) AS url_key FROM pages")
def _(spark, sf):
    pages = jobs.file_stream(spark, f"{sf}/pages.parquet").select("page_id", "url", R.moment("page_id").alias("fetched_at"))
    copies = pages.select(
        F.explode(F.array("url", F.concat("url", F.lit("?copy=1")))).alias("url"), "fetched_at"
    )
    return jobs.unique_pages(copies, U.strip_query(F.col("url")), *_paths(spark, "unique"))


@query(
    "st6_reset_when_none_left",
    f"""WITH {STATES}, tagged AS (SELECT *, user_part % 2 AS grp FROM (SELECT *, CAST(split_part(split_part(proxy, '.', 4), ':', 1) AS INTEGER) AS user_part FROM states))
    SELECT proxy, 'all' AS scope, CASE WHEN (SELECT count(*) FROM tagged WHERE state <> 'dead') = 0 AND state = 'dead' THEN 'unchecked' ELSE state END AS state FROM tagged
    UNION ALL SELECT proxy, 'dead only', 'unchecked' FROM tagged WHERE state = 'dead'""",
)
def _(spark, sf):
    found = states(spark, sf)[0]
    whole = health.reset_when_none_left(found)
    dead = health.reset_when_none_left(found.where("state = 'dead'"))
    return whole.select("proxy", F.lit("all").alias("scope"), "state").unionByName(
        dead.select("proxy", F.lit("dead only").alias("scope"), "state")
    )


@query(
    "st7_retry_queue",
    f"""WITH {JUDGED}, ok AS (SELECT url, max((ts, request_id)) AS ok_at FROM judged WHERE NOT ban GROUP BY url),
    n AS (SELECT url, (count(*) - 1) % 6 + 1 AS n FROM judged LEFT JOIN ok USING (url) WHERE ban AND (ok_at IS NULL OR (ts, request_id) > ok_at) GROUP BY url)
    SELECT url, n AS attempt_no, n <= 5 AS retry FROM n""",
)
def _(spark, sf):
    return health.retry_queue(judged(spark, sf))


@query(
    "st7_request_limits",
    f"""WITH {JUDGED}, ok AS (SELECT url, max((ts, request_id)) AS ok_at FROM judged WHERE NOT ban GROUP BY url),
    n AS (SELECT url, CAST(right(url, 1) AS INTEGER) % 3 + 1 AS tries, count(*) AS bans FROM judged LEFT JOIN ok USING (url)
      WHERE ban AND (ok_at IS NULL OR (ts, request_id) > ok_at) GROUP BY url)
    SELECT url, (bans - 1) % (tries + 1) + 1 AS attempt_no, (bans - 1) % (tries + 1) + 1 <= tries AS retry FROM n""",
)
def _(spark, sf):
    tries = F.right("url", F.lit(1)).cast("int") % 3 + 1
    return health.retry_queue(judged(spark, sf), tries)


@query(
    "st6_stop_reason",
    f"""WITH {STATES}, scopes AS (SELECT 'all' AS scope, state FROM states UNION ALL SELECT 'dead only', state FROM states WHERE state = 'dead'
      UNION ALL SELECT 'none', state FROM states WHERE state = 'no such state'),
    counted AS (SELECT s.scope, count(*) FILTER (WHERE state = 'dead') AS dead, count(*) FILTER (WHERE state IN ('good', 'unchecked')) AS usable
      FROM (VALUES ('all'), ('dead only'), ('none')) s(scope) LEFT JOIN scopes USING (scope) GROUP BY s.scope)
    SELECT scope, true AS stop, CASE WHEN usable = 0 THEN 'no_proxies' END AS reason FROM counted
    UNION ALL SELECT scope, false, CASE WHEN usable + dead = 0 THEN 'no_proxies_after_reset' END FROM counted""",
)
def _(spark, sf):
    found = states(spark, sf)[0]
    scopes = {"all": found, "dead only": found.where("state = 'dead'"), "none": found.where("state = 'no such state'")}
    rows = [
        health.stop_reason(part, stop).select(F.lit(scope).alias("scope"), F.lit(stop).alias("stop"), "reason")
        for scope, part in scopes.items() for stop in (True, False)
    ]
    return reduce(DataFrame.unionByName, rows)


@query(
    "agg4_running_report",
    f"""WITH {JUDGED}, g AS (SELECT *, count(*) FILTER (WHERE NOT ban) OVER w AS run, lead(epoch_us(ts)) OVER w2 AS nxt FROM judged
      WINDOW w AS (PARTITION BY proxy ORDER BY ts, request_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             w2 AS (PARTITION BY proxy ORDER BY ts, request_id)),
    f AS (SELECT proxy, epoch_us(ts) AS us, nxt, count(*) FILTER (WHERE ban) OVER (PARTITION BY proxy, run ORDER BY ts, request_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS failed FROM g),
    d AS (SELECT *, CAST(least(172800.0, 7200.0 * pow(2.0, least(failed - 1, 60))) AS BIGINT) * 1000000 AS wait FROM f),
    spans AS (
      SELECT us AS a, nxt AS b, 1 AS good, 0 AS dead, 0 AS woken, 0 AS wait FROM d WHERE failed = 0
      UNION ALL SELECT us, least(us + wait, coalesce(nxt, us + wait)), 0, 1, 0, wait FROM d WHERE failed > 0
      UNION ALL SELECT us + wait, nxt, 0, 0, 1, 0 FROM d WHERE failed > 0 AND (nxt IS NULL OR us + wait < nxt)),
    steps AS (SELECT a AS us, good, dead, woken, wait FROM spans UNION ALL SELECT b, -good, -dead, -woken, -wait FROM spans WHERE b IS NOT NULL),
    ticks AS (SELECT (us + 899999999) // 900000000 * 900000000 AS tick, sum(good) AS good, sum(dead) AS dead, sum(woken) AS woken, sum(wait) AS wait
      FROM steps GROUP BY 1),
    sums AS (SELECT tick, good <> 0 OR dead <> 0 OR woken <> 0 OR wait <> 0 AS changed, sum(good) OVER o AS g, sum(dead) OVER o AS d,
      sum(woken) OVER o AS r, sum(wait) OVER o AS w FROM ticks WINDOW o AS (ORDER BY tick))
    SELECT {text_of('make_timestamp(CAST(tick AS BIGINT))')} AS at, CAST(g AS BIGINT) AS good, CAST(d AS BIGINT) AS dead, CAST(r AS BIGINT) AS reanimated,
      CAST((SELECT count(DISTINCT proxy) FROM judged) - g - d - r AS BIGINT) AS unchecked,
      CASE WHEN d > 0 THEN CAST(w AS DOUBLE) / CAST(d AS DOUBLE) / 1000000 ELSE 0.0 END AS mean_backoff FROM sums WHERE changed""",
)
def _(spark, sf):
    log = judged(spark, sf)
    report = health.state_report(log, 900, log.select("proxy"), base=7200, cap=172800)
    return report.withColumn("at", X.iso_text(F.col("at")))


# ---------------------------------------------------------------- user extension points


@query(
    "udf1_ban_policy",
    f"""WITH {LOG} SELECT request_id, status = 503 OR coalesce(body_len, 0) < 130 AS ban FROM log WHERE exception IS NULL""",
)
def _(spark, sf):
    def strict(status, body_len, exception):
        return F.when(exception.isNull(), (status == 503) | (F.coalesce(body_len, F.lit(0)) < 130))

    return judged(spark, sf, strict).select("request_id", "ban")


@query("udf2_field_processors", f"SELECT doc_id, md5(replace({strip('text')}, 'e', '3')) AS text, 'from ' || source AS source FROM documents")
def _(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text", "source")
    return catalog.cleaned(
        docs, {"text": lambda c: F.md5(F.replace(X.strip(c), F.lit("e"), F.lit("3"))), "source": lambda c: F.concat(F.lit("from "), c)}
    )


@query(
    "udf2_job_processors",
    f"""WITH {PROD} SELECT 'ozon_listing' AS job, 'nr ' || p_partkey AS id, upper(p_name) AS name FROM prod WHERE page_no % 7 <> 0
    UNION ALL SELECT 'shop_product', 'nr ' || p_partkey, md5(CAST(p_partkey % 100 AS VARCHAR)) FROM part
    UNION ALL SELECT 'shop_article', 'nr ' || p_partkey, reverse(p_name) FROM part""",
)
def _(spark, sf):
    def each(change):
        return lambda texts: F.transform(texts, change)

    items = catalog.ozon_listing(R.widget_pages(spark, sf), {"title": F.upper, "id": lambda c: F.concat(F.lit("nr "), c)})
    goods = shops.shop_product(
        R.shop_product_pages(spark, sf), processors={"sku": each(lambda t: F.concat(F.lit("nr "), X.strip(t))), "weight": each(F.md5)}
    )
    articles = shops.shop_article(R.article_pages(spark, sf), processors={"vendor": each(F.reverse)})
    return (
        items.select(F.lit("ozon_listing").alias("job"), F.col("ozon_id").alias("id"), F.col("product_name").alias("name"))
        .unionByName(goods.select(F.lit("shop_product").alias("job"), "id", F.col("weight").alias("name")))
        .unionByName(
            articles.select(F.lit("shop_article").alias("job"), F.concat(F.lit("nr "), "article").alias("id"), F.col("vendor_code").alias("name"))
        )
    )


@query(
    "udf3_site_rules",
    r"""SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
      regexp_extract(html, '<div class="ad">([^<]*)</div>', 1) AS ad,
      regexp_extract(html, '<li><a href="([^"]*)">[^<]*</a></li></ul></nav>', 1) AS last_link FROM pages""",
)
def _(spark, sf):
    site = [
        Rule("lang", "html::attr(lang)"), Rule("ad", "div.ad::text"), Rule("last_link", "nav > ul > li:last-child a::attr(href)"),
    ]
    read = html_rules.extract_rules(spread_table(spark, sf, "pages", "page_id", "html"), site, keep=("page_id",), body="html")
    return read.select("page_id", *[html_rules.first_of(r.name).alias(r.name) for r in site])
