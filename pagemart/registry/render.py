"""Pages, bodies and logs built from the given tables, for the registered queries and the tests.

A listing page holds the products of one category among ``BLOCK`` consecutive keys, so the rows
gathered for one page never exceed ``BLOCK``. Some keys get awkward values on purpose: no-break
spaces, the currency sign, missing fields, doubled parameters, foreign canonical links.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemart import constants as K
from pagemart.registry.base import spread_table, table

BLOCK = 240
SITE = "https://www.wildberries.ru"


def fill(template: str, *values: Column | str) -> Column:
    """The template with each ``{}`` replaced; NULL becomes ''."""
    pieces = template.split("{}")
    columns = [F.lit(pieces[0])]
    for value, piece in zip(values, pieces[1:], strict=True):
        value = F.col(value) if isinstance(value, str) else value
        columns += [F.coalesce(value.cast("string"), F.lit("")), F.lit(piece)]
    return F.concat(*columns)


def when_key(divisor: int, rest: int, then: Column, otherwise: Column | None = None, key: str = "p_partkey") -> Column:
    chosen = F.when(F.col(key) % divisor == rest, then)
    return chosen if otherwise is None else chosen.otherwise(otherwise)


def moment(key: str) -> Column:
    return F.timestamp_seconds(F.lit(1704067200) + F.col(key))


def products(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """``part`` with the raw texts a page would show; ``spread`` where each row becomes a page."""
    key = F.col("p_partkey")
    price = F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    gap = K.NO_BREAK_SPACE
    price_raw = (
        F.when(key % 17 == 0, F.lit(None).cast("string"))
        .when(key % 3 == 0, F.concat(F.lit(gap), price, F.lit(gap + K.ROUBLE)))
        .when(key % 3 == 1, F.concat(price, F.lit(" " + K.ROUBLE)))
        .otherwise(price)
    )
    word = F.when(key % 3 == 0, "отзыв").when(key % 3 == 1, "отзыва").otherwise("отзывов")
    columns = ["p_partkey", "p_name", "p_brand", "p_type", "p_retailprice"]
    part = spread_table(spark, sf_dir, "part", *columns, written=True) if spread else table(spark, sf_dir, "part", *columns)
    return part.withColumns(
        {
            "page_no": (F.floor(key / BLOCK) + 1).cast("int"),
            "price_raw": price_raw,
            "reviews": F.when(key % 11 != 0, (key % 7).cast("int")),
            "reviews_raw": F.when(key % 11 != 0, F.concat((key % 7).cast("string"), F.lit(gap), word)),
            "brand_raw": F.when(key % 13 != 0, F.concat(F.lit(f"{gap} "), F.col("p_brand"), F.lit(" "))),
            "category_url": F.concat(F.lit(f"{SITE}/catalog/"), F.lower("p_type")),
        }
    )


def gather(rows: DataFrame, keys: list[str], order: str, piece: Column, glue: str = "") -> DataFrame:
    """Pieces of one page joined in order, with their number; ``page_id`` is the lowest key.

    The number of partitions is set, as small pages would else be merged into one task, and parsing
    them is the costly part.
    """
    session = rows.sparkSession
    parts = max(session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
    pieces = F.array_sort(F.collect_list(F.struct(F.col(order).alias("k"), piece.alias("p"))))
    return rows.repartition(parts, *keys).groupBy(*keys).agg(
        F.min(order).alias("page_id"), F.count("*").alias("n"),
        F.array_join(F.transform(pieces, lambda x: x["p"]), glue).alias("pieces"),
    )


def captured(pages: DataFrame, url: Column, body: Column, kind: str | Column, *extra: str) -> DataFrame:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return pages.select(
        "page_id", url.alias("url"), F.lit(200).alias("status"), body.alias("body"),
        moment("page_id").alias("fetched_at"), kind.alias("kind"), *extra,
    )


def listing_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    card = fill(
        '<div class="dtList i-dtList j-card-item"><a class="ref_goods_n_p j-open" href="/catalog/{}/detail.aspx?targetUrl=GP">'
        '<strong class="brand-name c-text-sm">{}</strong><span class="goods-name c-text-sm">{}</span></a>'
        '<span class="price"><ins class="lower-price">{}</ins></span>{}</div>',
        "p_partkey", "brand_raw", "p_name", "price_raw",
        F.when(F.col("reviews_raw").isNotNull(), fill('<span class="dtList-comments-count">{}</span>', "reviews_raw")),
    )
    pages = gather(products(spark, sf_dir), ["p_type", "category_url", "page_no"], "p_partkey", card)
    body = fill(
        '<html><body><h1>{}</h1><div class="catalog-content">{}</div><p>end<p>of page<div class="pager-bottom">'
        '<a class="pagination-next" href="{}?page={}">next</a></div></body></html>',
        "p_type", "pieces", "category_url", F.col("page_no") + 1,
    )
    return captured(
        pages, fill("{}?page={}", "category_url", "page_no"), body, "category",
        "category_url", F.col("p_type").alias("category_name"), "page_no",
    )


def listing_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.to_json(
        F.struct(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.trim("brand_raw").alias("brand"),
            F.col("reviews").alias("feedbackCount"), F.col("p_retailprice").cast("decimal(12,2)").alias("salePrice"),
        )
    )
    pages = gather(products(spark, sf_dir), ["p_type", "category_url", "page_no"], "p_partkey", item, ",")
    body = fill('{"state":0,"data":{"products":[{}]}}', "pieces")
    url = fill(K.WB_LISTING_API + "kind={}&page={}", "p_type", "page_no")
    return captured(
        pages, url, body, "listing", "category_url", F.col("p_type").alias("category_name"), "page_no"
    )


def catalog_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First listing pages, one per kind and block of keys: every other kind fetches its listing as JSON and says its total."""
    rows = products(spark, sf_dir).withColumn("category_url", fill("{}/b{}", "category_url", "page_no"))
    whole = F.count("*") * (F.col("page_no") % 4 + 1) - F.col("page_no") % 2
    totals = rows.groupBy("p_type", "page_no").agg(whole.alias("total"))
    first = gather(rows, ["p_type", "page_no", "category_url"], "p_partkey", F.lit('<div class="j-card-item"></div>'))
    by_json = F.length("p_type") % 2 == 0
    head = F.when(
        by_json,
        fill('<div id="catalog" data-xcatalog-path="c" data-xcatalog-query="kind={}-{}" data-xcatalog-total="{}">', "p_type", "page_no", "total"),
    ).otherwise(F.lit("<div>"))
    pages = first.join(totals, ["p_type", "page_no"])
    return captured(
        pages, fill("{}?sort=popular", "category_url"), fill("<html><h1>{}</h1>{}{}</div></html>", "p_type", head, "pieces"),
        "category", "category_url", F.col("p_type").alias("category_name"),
    )


def product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    rows = products(spark, sf_dir, spread=True).withColumn("page_id", key)
    own = fill(SITE + "/catalog/{}/detail.aspx", key)
    canonical = (
        F.when(key % 9 == 4, fill(SITE + "/catalog/{}/detail.aspx?from=old", key - 1))
        .when(key % 9 == 6, fill("/catalog/{}/detail.aspx", key))
        .when(key % 9 != 5, own)
    )
    head = F.when(canonical.isNotNull(), fill('<link rel="canonical" href="{}">', canonical))
    pp = '<div class="pp"><span><b>{}</b></span><span>{}</span></div>'
    params = F.concat(
        fill(pp, F.lit(K.BRAND_COUNTRY), fill(" NATION_{} ", key % 25)),
        F.when(key % 8 == 0, F.lit("")).otherwise(fill(pp, F.lit(K.MAKER_COUNTRY), fill("NATION_{}", key * 3 % 25))),
        F.when(key % 6 == 0, fill(pp, F.lit(K.BRAND_COUNTRY), F.lit("NATION_X"))).otherwise(F.lit("")),
        F.when(key % 10 == 0, F.lit('<div class="pp"><span><b>no value</b></span></div>')).otherwise(F.lit("")),
    )
    slide = '<div class="swiper-slide"><img src=" //img.example/tm/new/{}-{}.jpg "></div>'
    variants = F.when(
        key % 5 == 0,
        fill('<ul><li><a href="/catalog/{}/detail.aspx?v=1">1</a><li><a href="/catalog/{}/detail.aspx?v=2">2</a></ul>', key + 1, key + 2),
    )
    v1 = F.when(
        key % 2 == 0,
        fill("<script>\n  wb.product.DomReady.init({data: {nomenclatures: {'{}': {'ordersCount': {}}, '1': {ordersCount: 5}}}});</script>", key, key % 50),
    )
    v2 = F.when(
        key % 3 == 0,
        fill(
            "<script>\n  wb.spa.init({ routes: routes,   routesDictionary: routesDictionary,\n router: {ssrModel: "
            "{selectedNomenclature: {ordersCount: {}}, product: {imtId: {}, feedbacks: {}}}}});</script>",
            key % 50 + 1000, key * 10, key % 4000,
        ),
    )
    body = fill(
        '<!DOCTYPE html><html><head>{}</head><body><div class="brand-and-name"><span class="brand">{}</span>'
        '<span class="name">\n {}&nbsp;</span></div><div class="article">id <span>{}</span></div>'
        '<div class="brand-logo"><a href="/brands/{}"><img src="//img.example/{}.png"></a></div>'
        '<span class="final-cost">{}</span><div class="product-rating"><span> {}</span></div>'
        '<a class="count-review"><i>{}</i></a><div class="params">{}</div><div class="pv-carousel">{}{}</div>'
        '<div class="options">{}</div><div id="Comments"><a class="show-more" data-link="{}">more</a></div>{}{}</body></html>',
        head, "brand_raw", "p_name", key, key % 25, key % 25, "price_raw", (key % 50) / 10, "reviews_raw", params,
        fill(slide, key, F.lit(1)), fill(slide, key, F.lit(2)), variants, key, v1, v2,
    )
    kind = F.when((key % 5).isin(1, 2), "variant").otherwise("product")
    return captured(rows, own, body, kind, "category_url", F.col("p_type").alias("category_name"))


def widget_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON pages whose product widget is JSON text inside; every seventh has none."""
    item = F.to_json(
        F.struct(
            F.concat(F.lit("/context/detail/id/"), F.col("p_partkey")).alias("link"),
            F.array(fill("https://img.example/{}.jpg", "p_partkey")).alias("images"),
            F.struct(
                F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("title"),
                (F.col("p_partkey") % 25).cast("string").alias("brandId"), F.col("p_brand").alias("brand"),
                F.col("p_type").alias("category"), (F.col("p_partkey") % 100).cast("string").alias("marketplaceSellerId"),
                F.when(F.col("p_partkey") % 2 == 0, "FBO").alias("deliverySchema"), F.col("price_raw").alias("finalPrice"),
            ).alias("cellTrackingInfo"),
        )
    )
    pages = gather(products(spark, sf_dir), ["p_type", "category_url", "page_no"], "p_partkey", item, ",")
    inner = fill('{"items":[{}]}', "pieces")
    other = F.struct(F.lit("menu-1-default"), F.lit('{"x":1}'))
    widget = F.struct(fill("searchResultsV2-{}-default-1", "page_id"), inner)
    states = F.map_from_entries(F.when(F.col("page_no") % 7 == 0, F.array(other)).otherwise(F.array(other, widget)))
    following = F.when(F.col("page_no") % 5 != 0, fill("/category/{}/?page={}", F.lower("p_type"), F.col("page_no") + 1))
    body = F.to_json(F.struct(states.alias("widgetStates"), following.alias("nextPage")))
    url = fill(K.OZON_PAGE_API + "/category/{}/?page={}", F.lower("p_type"), "page_no")
    return captured(pages, url, body, "category", "category_url", F.col("p_type").alias("category_name"), "page_no")


def ld_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product pages with data blocks: a crumb block first, every tenth page has no product block."""
    rows = products(spark, sf_dir, spread=True).withColumn("page_id", F.col("p_partkey"))
    block = F.to_json(
        F.struct(
            F.lit("Product").alias("@type"), F.col("p_name").alias("name"), F.col("p_partkey").cast("string").alias("sku"),
            F.struct(F.col("price_raw").alias("Price")).alias("offers"),
        )
    )
    script = '<script type="application/ld+json">{}</script>'
    crumb = fill(script, F.lit('{"@type":"BreadcrumbList","name":"crumbs"}'))
    body = fill(
        '<html><head>{}{}</head><body><div class="product-rating-simple" title="{}"></div></body></html>',
        crumb, F.when(F.col("p_partkey") % 10 != 9, fill(script, block)), (F.col("p_partkey") % 50) / 10,
    )
    return captured(rows, fill("https://www.ozon.ru/context/detail/id/{}/", "p_partkey"), body, "product")


def brand_pages(spark: SparkSession, sf_dir: str, second: bool = False) -> DataFrame:
    """Letter pages: the products' brands among a block of keys, relative links with a query."""
    rows = products(spark, sf_dir)
    if second:
        entry = fill('<a href="/brand/b{}/?miniapp=1"> {} </a>', "p_partkey", "p_brand")
        url, holder = "https://www.ozon.ru/brand/en--{}/", "b5x9"
    else:
        entry = fill(
            '<a href="/brands/b{}?x=1#t"><span>{}</span>{}</a>', "p_partkey", "p_brand",
            F.when(F.col("p_partkey") % 2 == 0, fill('<img src="//img.example/{}.png">', "p_partkey")),
        )
        url, holder = SITE + "/wildberries/brandlist.aspx?letter={}", "i-brand-list"
    pages = gather(rows, ["page_no"], "p_partkey", entry)
    return captured(pages, fill(url, "page_no"), fill(f'<div class="{holder}">{{}}</div>', "pieces"), "letter")


def menu_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Menu pages over region, nation and a block of 100 suppliers each.

    Regions are top menus and nations their columns: every fifth nation is a banner, every fifth
    brand letters, every fifth flat, every fifth has no title and continues the former column.
    """
    supplier = table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    link = fill("<li><a href='/s/{}'>{}</a></li>", "s_suppkey", "s_name")
    blocks = supplier.withColumn("block", F.floor(F.col("s_suppkey") / 100))
    links = gather(blocks, ["block", "s_nationkey"], "s_suppkey", link).drop("page_id", "n")
    # Nations go round the regions, so the place within the region decides the kind of column.
    place = F.floor(F.col("n_nationkey") / 5) % 5
    title = fill("<a href='/n/{}'>{}</a>", "n_nationkey", "n_name")
    column = (
        F.when(place == 0, fill("<li class='topmenus-column category'>{}<ul>{}</ul></li>", title, "pieces"))
        .when(place == 1, fill("<li class='topmenus-column category'><ul>{}</ul></li>", "pieces"))
        .when(place == 2, fill("<li class='topmenus-column menu-banner'><ul>{}</ul></li>", "pieces"))
        .when(place == 3, fill("<li class='topmenus-column category'><ul>{}</ul></li>", "pieces"))
        .otherwise(fill("<li class='topmenus-column categories'>{}</li>", F.regexp_replace("pieces", "</?li>", "")))
    )
    columns = links.join(nation, links.s_nationkey == nation.n_nationkey)
    menus = gather(columns, ["block", "n_regionkey"], "n_nationkey", column).drop("page_id", "n")
    both = menus.join(region, menus.n_regionkey == region.r_regionkey)
    top = fill("<li class='topmenus-item' data-menu-id='{}'><a href='/r/{}'>{}</a><i></i></li>", "r_regionkey", "r_regionkey", "r_name")
    sub = fill("<ul class='dropdown-item' data-menu-id='{}'>{}</ul>", "r_regionkey", "pieces")
    tops = gather(both, ["block"], "r_regionkey", top).withColumnRenamed("pieces", "tops").drop("page_id", "n")
    pages = gather(both, ["block"], "r_regionkey", sub).drop("page_id").join(tops, "block")
    pages = pages.withColumn("page_id", F.col("block"))
    body = fill(
        "<html><body><div id='top-menu'><ul class='topmenus'>{}</ul></div><div id=\"submenu\">{}"
        "<ul class='dropdown-item i-topmenus-banners' data-menu-id='0'><li class='category'><a href='/x'>x</a></li></ul>"
        "</div></body></html>",
        "tops", "pieces",
    )
    return captured(pages, fill(SITE + "/menu/{}", "block"), body, "menu")


REGION_SLUG = "asia-2"


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with region, town, street and coordinates; some parts are missing."""
    supplier = table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    key = F.col("s_suppkey")
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumns(
            {
                "street": F.when(key % 7 != 0, fill("Street {}", key % 90)),
                "lat": F.format_string("%d.%06d", key % 60 + 1, key * 7919 % 1000000),
                "lon": F.format_string("%d.%06d", key % 120 + 2, key * 104729 % 1000000),
            }
        )
    )


def producer_url(key: Column | str) -> Column:
    return fill("https://productcenter.ru/producers/{}/maker", key)


def producer_category_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suppliers(spark, sf_dir).withColumn("block", F.floor(F.col("s_suppkey") / 50))
    card = fill(
        '<div class="item"><a class="link" href="/producers/{}/maker">{}</a><a title="Все товары производителя">{}</a></div>',
        "s_suppkey", "s_name", F.col("s_suppkey") % 30,
    )
    pages = gather(rows, ["r_name", "block"], "s_suppkey", card)
    body = fill(
        '<html><h1>{}</h1><div id="content"><div class="items">{}</div></div><div class="page_links"><a href="/1">1</a>'
        '<a href="?page-{}">next</a></div></html>',
        "r_name", "pieces", F.col("block") + 1,
    )
    url = fill("https://productcenter.ru/producers/catalog-{}?page-{}", F.lower("r_name"), "block")
    return captured(
        pages, url, body, "category", F.lit(None).cast("string").alias("category_url"),
        F.lit(None).cast("string").alias("category_name"),
    )


def producer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    rows = suppliers(spark, sf_dir).withColumn("page_id", key)
    canonical = F.when(key % 10 == 3, producer_url(key - 1)).when(key % 10 != 4, producer_url(key))
    span = '<span itemprop="{}">{}</span>'
    body = fill(
        '<html><head>{}</head><body><h1 class="cfix">{}</h1><div id="box_description"><div class="box_text"><p>About {}</p></div></div>'
        '{}{}{}<span itemprop="telephone">+7 {}</span>{}<a id="producer_link">site{}.example</a>'
        '<a class="fancybox" data-fancybox-group="producer" href="/logo/{}.png?v=2">logo</a>'
        '<div id="box_files"><a href="/files/{}.xls">price</a><a href="files/{}.pdf#p">list</a></div>'
        "<script>init({coordinates: [{}, {}]});</script></body></html>",
        F.when(canonical.isNotNull(), fill('<link rel="canonical" href="{}">', canonical)), "s_name", "s_name",
        fill(span, F.lit("addressRegion"), "r_name"), fill(span, F.lit("addressLocality"), "n_name"),
        F.when(F.col("street").isNotNull(), fill(span, F.lit("streetAddress"), "street")), key,
        F.when(key % 3 == 0, fill(span, F.lit("email"), fill("m{}@mail.example", key))), key, key, key, key, "lat", "lon",
    )
    return captured(rows, producer_url(key), body, "producer")


def review_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review batches of up to 1000 turns of a conversation, and an end batch without a list."""
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "text").withColumns(
        {"batch": F.floor(F.col("turn") / K.REVIEW_BATCH), "day": F.date_add(F.lit("2024-01-01"), (F.col("turn") % 1000).cast("int"))}
    )
    item = F.to_json(
        F.struct(
            "text", (F.col("turn") % 5 + 1).cast("int").alias("productValuation"),
            F.date_format("day", "yyyy-MM-dd'T'00:00:00'Z'").alias("createdDate"),
        )
    )
    pages = gather(rows, ["conv_id", "batch"], "turn", item, ",").withColumn("page_id", F.col("conv_id") * 1000 + F.col("batch"))
    full = pages.select("page_id", F.col("conv_id").alias("imt_id"), fill('{"feedbacks":[{}]}', "pieces").alias("body"))
    end = pages.select(
        (F.col("page_id") + 500).alias("page_id"), F.col("conv_id").alias("imt_id"), F.lit('{"feedbacks":null}').alias("body")
    )
    return full.unionByName(end)


def review_list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ascending review pages of customers: their orders among a block of 100,000 order keys."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    rows = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate").select(
        "o_custkey", "o_orderkey", F.floor(F.col("o_orderkey") / 100_000).alias("block"),
        F.struct("o_orderdate", "o_orderkey").alias("at"),
        fill('<div class="comment"><span class="time" content="{}">{}</span></div>', day, day).alias("piece"),
    )
    pages = gather(rows, ["o_custkey", "block"], "at", F.col("piece"))
    return pages.select(F.col("page_id.o_orderkey").alias("page_id"), "o_custkey", fill("<div>{}</div>", "pieces").alias("body"))


def shop_listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    card = fill(
        '<div class="product"><div class="product__img" id="{}"><a class="product__a" href="/p/{}?c=1"><img></a></div>'
        '<div class="product__title"><a class="product__a" href="/p/{}">{}</a></div><span class="prices__actual">{}</span></div>',
        "p_partkey", "p_partkey", "p_partkey", "p_name", "price_raw",
    )
    pages = gather(products(spark, sf_dir), ["p_type", "page_no"], "p_partkey", card)
    nothing = F.lit(None).cast("string")
    return captured(
        pages, fill("https://msk.shop.example/catalog/{}?page={}", F.lower("p_type"), "page_no"),
        fill("<html><h1>{}</h1>{}<a class='pagination__a' href='?page=2'>2</a></html>", "p_type", "pieces"), "category",
        nothing.alias("category_url"), nothing.alias("category_name"),
    )


def shop_product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = products(spark, sf_dir, spread=True).withColumn("page_id", F.col("p_partkey"))
    key = F.col("p_partkey")
    size = F.when(
        key % 4 != 0,
        fill('<div class="details-dimensions"><div class="details-param-value"> {}x{} </div></div>', key % 9, key % 5),
    )
    photo = '<div class="details-carousel-item"><img class="gallery-photos-item-obj" {}="/pictures/xsmall/{}.jpg"></div>'
    body = fill(
        '<html><div class="details-sku"><span class="details-param-value"> {} </span></div><b class="price-number">{}</b>{}'
        '<div class="details-param-value-weight">{}</div>{}{}</html>',
        key, "price_raw", size, key % 100, fill(photo, F.lit("data-src"), fill("{}-2", key)), fill(photo, F.lit("src"), fill("{}-1", key)),
    )
    return captured(rows, fill("https://toys.example/products/{}", key), body, "product")


def article_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = products(spark, sf_dir, spread=True).withColumn("page_id", F.col("p_partkey"))
    body = fill(
        '<html><div class="prod--art">\n Артикул <span class="space"> </span>\n {} </div>'
        '<div class="prod--art">other</div><span itemprop="productID">{}</span></html>',
        "p_partkey", "p_name",
    )
    return captured(rows, fill("https://goods.example/{}", "p_partkey"), body, "product")


def tree_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shop's tree: category pages link to their products and to the next page."""
    link = fill('<div class="products-view-name"><a href="/products/{}">{}</a></div>', "p_partkey", "p_name")
    pages = gather(products(spark, sf_dir), ["p_type", "page_no"], "p_partkey", link)
    body = fill('<html>{}<a class="pagenumberer-next" href="/c/{}/{}">next</a></html>', "pieces", "p_type", F.col("page_no") + 1)
    return captured(pages, fill("https://toys.example/c/{}/{}", "p_type", "page_no"), body, "category")


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch_log_of(table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type"))


def fetch_log_of(events: DataFrame) -> DataFrame:
    """``events`` as a log: users are endpoints, errors are bans of four kinds."""
    event = F.col("event_id")
    error, kind = F.col("event_type") == "error", event % 4
    status = (
        F.when(error & (kind == 0), 403).when(error & (kind == 1), 503).when(error & (kind == 2), 200)
        .when(error, F.lit(None)).when(event % 7 == 0, 301).otherwise(200)
    )
    body_len = (
        F.when(error & (kind == 0), F.when(event % 8 == 0, 0).otherwise(120)).when(error & (kind == 1), 64)
        .when(error & (kind == 2), 0).when(error, F.lit(None)).when(event % 7 == 0, 0).otherwise(1000 + event % 977)
    )
    exception = F.when(
        error & (kind == 3),
        F.when(event % 3 == 0, K.IGNORED_EXCEPTION).when(event % 3 == 1, "core.TimeoutError").otherwise("core.ConnectionLost"),
    )
    user = F.col("user_id")
    return events.select(
        event.alias("request_id"),
        fill("https://shop.example/p/{}", user * 10 + event % 10).alias("url"),
        fill("http://u:p@10.0.{}.{}:8080", F.floor(user / 256), user % 256).alias("proxy"),
        F.col("ts").cast("timestamp").alias("ts"),
        status.cast("int").alias("status"),
        body_len.cast("int").alias("body_len"),
        exception.alias("exception"),
    )
