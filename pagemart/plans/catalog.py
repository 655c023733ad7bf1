"""Product, brand and category records from captured pages.

Every job takes captured pages and returns typed records that keep ``page_id``, so ``rejected``
tells which pages gave none. Selectors are arguments: they change with the shops' markup. So are ``processors``:
functions of the raw values by the name of the rule, or of the JSON field, applied before they are typed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemart import constants as K
from pagemart.functions import collections as C
from pagemart.functions import jsonx as J
from pagemart.functions import text as X
from pagemart.functions import urls as U
from pagemart.operators import html_rules, joins, links
from pagemart.operators.filters import Cleaners, cleaned
from pagemart.operators.html_rules import Rule, first_of
from pagemart.plans import positions
from pagemart.session import materialise

LISTING_COLUMNS = [
    "wb_id", "product_name", "wb_reviews_count", "wb_price", "parse_date", "marketplace", "product_url",
    "wb_category_url", "wb_category_name", "wb_category_position", "wb_brand_name",
]


def rejected(pages: DataFrame, records: DataFrame) -> DataFrame:
    """Pages that gave no record."""
    return pages.join(records.select("page_id"), "page_id", "left_anti")


def route(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(category pages whose listing is fetched as JSON, those whose cards are read from markup)."""
    marked = r"""<(?=[^>]*\sid=["']?catalog["'\s>])(?=[^>]*\sdata-xcatalog-path=)"""
    by_json = F.coalesce(F.col("body").rlike(marked), F.lit(False))
    return pages.where(by_json), pages.where(~by_json)


# Selectors equal to the pages' markup.
CATALOG_ATTRIBUTES = [
    Rule("path", "#catalog::attr(data-xcatalog-path)"),
    Rule("query", "#catalog::attr(data-xcatalog-query)"),
    Rule("total", "#catalog::attr(data-xcatalog-total)"),
    Rule("cards", "::self(class)", each=".j-card-item"),
    Rule("heading", "h1::text"),
]


def listing_edges(pages: DataFrame) -> DataFrame:
    """Edges to every page of a category's JSON listing, with the position its cards start after."""
    read = html_rules.extract_rules(pages, CATALOG_ATTRIBUTES, keep=("page_id", "url"))
    sized = read.select(
        F.col("page_id").alias("from_page"),
        U.strip_query(F.col("url")).alias("category_url"),
        first_of("heading").alias("category_name"),
        first_of("query").alias("query"),
        first_of("total").try_cast("long").alias("total"),
        F.size("cards").alias("cards"),
    ).where(first_of("path").isNotNull())
    spread = links.listing_pages_by_total(sized, F.col("total"), F.col("cards"))
    return spread.select(
        "from_page", U.listing_api_url(F.col("query"), F.col("page")).alias("to_url"), F.lit("listing").alias("kind"),
        "page", "offset", "category_url", "category_name",
    )


# Selectors equal to the pages' markup.
CARD_RULES = [
    Rule("heading", "h1::text", at="page"),
    Rule("href", "a.ref_goods_n_p::attr(href)"),
    Rule("name", ".goods-name::text"),
    Rule("reviews", ".dtList-comments-count::text"),
    Rule("price", ".lower-price::text"),
    Rule("brand", ".brand-name::text"),
]


def wb_listing_html(
    pages: DataFrame, rules: list[Rule] = CARD_RULES, card: str = ".catalog-content .j-card-item", processors: Cleaners | None = None
) -> DataFrame:
    """Cards of listing pages, with their position on the page."""
    cards = html_rules.extract_rules(pages, rules, card, keep=("page_id", "page_no", "url", "fetched_at"))
    cards = cleaned(cards, processors)
    link = U.absolutize_keep_query(U.strip_query(first_of("href")), F.col("url"))
    return cards.select(
        "page_id",
        "page_no",
        F.col("scope_no").alias("position"),
        U.product_id_from_url(link).try_cast("long").alias("wb_id"),
        X.strip(first_of("name")).alias("product_name"),
        X.clear_reviews_count(first_of("reviews")).alias("wb_reviews_count"),
        X.clear_price(first_of("price")).alias("wb_price"),
        first_of("price").alias("wb_price_raw"),
        F.col("fetched_at").alias("parse_date"),
        F.lit(K.WB).alias("marketplace"),
        link.alias("product_url"),
        U.strip_query(F.col("url")).alias("wb_category_url"),
        first_of("heading").alias("wb_category_name"),
        F.nullif(X.strip(first_of("brand")), F.lit("")).alias("wb_brand_name"),
    )


def wb_listing_json(pages: DataFrame, edges: DataFrame | None = None, processors: Cleaners | None = None) -> DataFrame:
    """Products of JSON listing pages, with their position on the page.

    With the ``listing_edges`` that led to the pages, ``offset`` is the number of cards before the page.
    """
    known = []
    if edges is not None:
        offsets = edges.groupBy(F.col("to_url").alias("url")).agg(F.min("offset").alias("offset"))
        pages, known = pages.join(offsets, "url", "left"), ["offset"]
    rows = pages.select(
        "page_id", "page_no", "url", "fetched_at", "category_url", "category_name", *known,
        F.posexplode(J.products(F.col("body"))).alias("_at", "p"),
    )
    raw = cleaned(rows.select("*", "p.*"), processors)
    return raw.select(
        "page_id",
        "page_no",
        *known,
        (F.col("_at") + 1).alias("position"),
        F.col("id").alias("wb_id"),
        X.strip(F.col("name")).alias("product_name"),
        F.col("feedbackCount").alias("wb_reviews_count"),
        F.col("salePrice").alias("wb_price"),
        F.col("fetched_at").alias("parse_date"),
        F.lit(K.WB).alias("marketplace"),
        U.product_url(F.col("url"), F.col("id")).alias("product_url"),
        F.col("category_url").alias("wb_category_url"),
        F.col("category_name").alias("wb_category_name"),
        F.nullif(X.strip(F.col("brand")), F.lit("")).alias("wb_brand_name"),
    )


def wb_listing(html_pages: DataFrame, json_pages: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """The short feed: listing columns only, from both kinds of page; ``edges`` led to the JSON pages."""
    by_html = positions.running(wb_listing_html(html_pages))
    by_json = positions.by_offset(wb_listing_json(json_pages, edges))
    return by_html.select("page_id", "method", *LISTING_COLUMNS).unionByName(
        by_json.select("page_id", "method", *LISTING_COLUMNS)
    )


# Selectors equal to the pages' markup.
PRODUCT_RULES = [
    Rule("name", ".brand-and-name .name::text"),
    Rule("brand", ".brand-and-name .brand::text"),
    Rule("reviews", ".count-review i::text"),
    Rule("price", ".final-cost::text"),
    Rule("rating", ".product-rating span::text"),
    Rule("article", "div.article span::text"),
    Rule("brand_url", ".brand-logo a::attr(href)"),
    Rule("brand_logo", ".brand-logo img::attr(src)"),
    Rule("params", "span:nth-of-type(1) b::text", each=".params .pp"),
    Rule("param_values", "span:nth-of-type(2)::text", each=".params .pp"),
    Rule("variants", ".options ul li a::attr(href)"),
    Rule("review_link", "#Comments a.show-more::attr(data-link)"),
    Rule("state_v1", 'script:contains("wb.product.DomReady.init")::text'),
    Rule("state_v2", 'script:contains("wb.spa.init")::text'),
]
IMAGE_RULE = Rule("images", ".pv-carousel .swiper-slide img::attr(src)")


def features_of(names: str, values: str) -> Column:
    """Parameter map; names and values trimmed, of equal names the last wins."""
    pairs = C.pairs(F.transform(names, X.strip), F.transform(values, X.strip))
    return C.last_wins_map(F.filter(pairs, lambda p: p["k"] != ""))


def wb_product_page(
    pages: DataFrame, skip_images: bool = False, rules: list[Rule] = PRODUCT_RULES, keep: tuple[str, ...] = (),
    processors: Cleaners | None = None,
) -> DataFrame:
    """Product records of detail pages, with the page's variant and review links.

    ``processors`` change the list of texts a rule found, by the rule's name, before it is typed.
    """
    own, _ = links.resolve_canonical(pages, links.canonical_href(F.col("body")))
    wanted = rules if skip_images else [*rules, IMAGE_RULE]
    read = cleaned(html_rules.extract_rules(own, wanted, keep=("page_id", "url", "fetched_at", *keep)), processors)
    read = read.withColumns(
        {
            "features": features_of("params", "param_values"),
            "wb_id": C.take_first(C.map_compose(F.col("article"), X.strip)),
            "_v1": J.state_v1(first_of("state_v1")),
            "_v2": J.state_v2(first_of("state_v2")),
        }
    )
    images = [] if skip_images else [
        C.map_compose(F.col("images"), X.strip, X.full_size_image).alias("image_urls")
    ]

    def field(rule: str) -> Column:
        return C.take_first(C.map_compose(F.col(rule), X.strip))

    return read.select(
        "page_id",
        *keep,
        F.col("fetched_at").alias("parse_date"),
        F.lit(K.WB).alias("marketplace"),
        F.col("url").alias("product_url"),
        field("name").alias("product_name"),
        *images,
        "features",
        F.col("wb_id").try_cast("long").alias("wb_id"),
        X.clear_reviews_count(field("reviews")).alias("wb_reviews_count"),
        J.orders_count(F.col("_v1"), F.col("_v2"), F.col("wb_id")).alias("wb_purchases_count"),
        X.clear_price(field("price")).alias("wb_price"),
        field("price").alias("wb_price_raw"),
        field("rating").try_cast("double").alias("wb_rating"),
        field("brand").alias("wb_brand_name"),
        field("brand_logo").alias("wb_brand_logo"),
        first_of("brand_url").alias("wb_brand_url"),
        F.try_element_at("features", F.lit(K.BRAND_COUNTRY)).alias("wb_brand_country"),
        F.try_element_at("features", F.lit(K.MAKER_COUNTRY)).alias("wb_manufacture_country"),
        C.map_compose(
            F.col("variants"), lambda v: U.absolutize_keep_query(U.strip_query(v), F.col("url"))
        ).alias("variant_urls"),
        U.reviews_url(F.col("url"), first_of("review_link")).alias("reviews_url"),
    )


def variant_edges(products: DataFrame) -> DataFrame:
    """(from_page, to_url, parent_id) edges from products to their variants.

    Pages that were themselves reached as a variant (``kind``) give none.
    """
    return products.where(~F.col("kind").eqNullSafe("variant")).select(
        F.col("page_id").alias("from_page"), F.explode("variant_urls").alias("to_url"), F.col("wb_id").alias("parent_id")
    )


def with_parent(products: DataFrame, edges: DataFrame) -> DataFrame:
    """Products with the id of the product that lists them as a variant, of several the lowest page's."""
    parents = edges.groupBy(F.col("to_url").alias("product_url")).agg(
        F.min_by("parent_id", F.struct("from_page", "parent_id")).alias("_parent")
    )
    parent = F.when(F.col("kind") == "variant", F.col("_parent"))
    return products.join(parents, "product_url", "left").withColumn("wb_parent_id", parent).drop("_parent")


def redirected(edges: DataFrame, moved: DataFrame) -> DataFrame:
    """Edges to the page that stands for their target: ``moved`` are canonical edges (url, to_url)."""
    targets = moved.groupBy(F.col("url").alias("to_url")).agg(F.min("to_url").alias("_own"))
    return edges.join(targets, "to_url", "left").withColumn("to_url", F.coalesce("_own", "to_url")).drop("_own")


def wb_products(
    pages: DataFrame, edges: DataFrame, reviews: DataFrame,
    skip_images: bool = False, skip_variants: bool = False, processors: Cleaners | None = None,
) -> DataFrame:
    """The full feed: product pages with category context, parent id and review dates.

    ``edges`` are listing edges (to_url, position, from_page, category_url, category_name),
    ``reviews`` dated rows (product_url, created_at). Pages have the kind product or variant. An edge to a page
    that names another as canonical hands its context, and its parent, to that one.
    """
    moved = links.resolve_canonical(pages, links.canonical_href(F.col("body")))[1].select("url", "to_url")
    wanted = pages.where(~F.col("kind").eqNullSafe("variant")) if skip_variants else pages
    products = wb_product_page(wanted, skip_images, keep=("kind",), processors=processors)
    if skip_variants:
        products = products.withColumn("wb_parent_id", F.lit(None).cast("bigint"))
    else:
        products = materialise(products, "products")
        products = with_parent(products, redirected(variant_edges(products), moved))
    listed = redirected(edges, moved).select(
        F.col("to_url").alias("product_url"), "from_page", "position",
        F.col("category_url").alias("wb_category_url"), F.col("category_name").alias("wb_category_name"),
        F.col("position").alias("wb_category_position"),
    )
    context = joins.category_context(
        products, listed, "product_url", "wb_category_url", "wb_category_name", "wb_category_position"
    )
    dates = reviews.groupBy("product_url").agg(
        F.min("created_at").alias("wb_first_review_date"), F.max("created_at").alias("wb_last_review_date")
    )
    return context.join(dates, "product_url", "left").drop("variant_urls", "reviews_url")


def ozon_listing(pages: DataFrame, processors: Cleaners | None = None) -> DataFrame:
    """Items of the product widget, 20 fields; pages without the widget give no rows."""
    parsed = pages.withColumn("_page", J.widget_page(F.col("body")))
    rows = parsed.select(
        "page_id", "page_no", "category_url", "fetched_at", F.posexplode(J.widget_items(F.col("_page"))).alias("_at", "i")
    )
    raw = cleaned(rows.select("*", "i.link", "i.images", "i.cellTrackingInfo.*"), processors)
    cell, nothing = {name: F.col(name) for name in raw.columns}, F.lit(None)
    return raw.select(
        "page_id",
        "page_no",
        (F.col("_at") + 1).alias("position"),
        F.col("fetched_at").alias("parse_date"),
        F.lit(K.OZON).alias("marketplace"),
        X.strip(cell["title"]).alias("product_name"),
        cell["link"].alias("product_url"),
        cell["images"].alias("image_urls"),
        cell["id"].alias("ozon_id"),
        cell["marketplaceSellerId"].alias("ozon_seller_id"),
        nothing.cast("string").alias("ozon_seller_name"),
        cell["brandId"].alias("ozon_brand_id"),
        cell["brand"].alias("ozon_brand_name"),
        cell["deliverySchema"].alias("ozon_delivery_schema"),
        F.col("category_url").alias("ozon_category_url"),
        cell["category"].alias("ozon_category_name"),
        nothing.cast("int").alias("ozon_reviews_count"),
        X.clear_price(cell["finalPrice"]).alias("ozon_price"),
        nothing.cast("double").alias("ozon_rating"),
        nothing.cast("string").alias("ozon_manufacture_country"),
        nothing.cast("timestamp").alias("ozon_first_review_date"),
        nothing.cast("timestamp").alias("ozon_last_review_date"),
    )


def ozon_next_pages(pages: DataFrame) -> DataFrame:
    """Edges to the next listing page; a page without the product widget has none."""
    parsed = pages.withColumn("_page", J.widget_page(F.col("body")))
    has_widget = C.key_containing(F.col("_page.widgetStates"), K.OZON_WIDGET_KEY).isNotNull()
    return parsed.where(has_widget & F.col("_page.nextPage").isNotNull()).select(
        F.col("page_id").alias("from_page"), U.wrap_in_api(F.col("_page.nextPage")).alias("to_url"),
        F.lit("category").alias("kind"), "category_url",
    )


def ozon_product_page(pages: DataFrame, processors: Cleaners | None = None) -> DataFrame:
    """Records from a page's Product data block, with the rating from the markup; same columns as a listing's."""
    rating = [Rule("rating", "div.product-rating-simple::attr(title)")]
    blocks = pages.withColumn("_ld", J.ld_product(F.col("body"))).where(F.col("_ld").isNotNull())
    read = html_rules.extract_rules(blocks, rating, keep=("page_id", "url", "fetched_at", "_ld"))
    read = read.withColumns({"name": F.col("_ld.name"), "sku": F.col("_ld.sku"), "price": F.col("_ld.offers.Price")})
    read = cleaned(read, processors)
    none = F.lit(None).cast("string")
    return read.select(
        "page_id",
        F.col("fetched_at").alias("parse_date"),
        F.lit(K.OZON).alias("marketplace"),
        X.strip(F.col("name")).alias("product_name"),
        F.col("url").alias("product_url"),
        F.lit(None).cast("array<string>").alias("image_urls"),
        X.strip(F.col("sku")).alias("ozon_id"),
        *[none.alias(f"ozon_{name}") for name in ("seller_id", "seller_name", "brand_id", "brand_name", "delivery_schema", "category_url", "category_name")],
        F.lit(None).cast("int").alias("ozon_reviews_count"),
        X.clear_price(F.col("price")).alias("ozon_price"),
        X.strip(first_of("rating")).try_cast("double").alias("ozon_rating"),
        none.alias("ozon_manufacture_country"),
        F.lit(None).cast("timestamp").alias("ozon_first_review_date"),
        F.lit(None).cast("timestamp").alias("ozon_last_review_date"),
    )


def brand_directory(
    pages: DataFrame, marketplace: str, entry: str, name: str = "span::text", image: str | None = "img::attr(src)",
    processors: Cleaners | None = None,
) -> DataFrame:
    """Brands of a letter page."""
    rules = [Rule("href", "::self(href)"), Rule("name", name)] + ([Rule("image", image)] if image else [])
    read = cleaned(html_rules.extract_rules(pages, rules, entry, keep=("page_id", "url", "fetched_at")), processors)
    return read.select(
        "page_id",
        F.col("fetched_at").alias("parse_date"),
        F.lit(marketplace).alias("marketplace"),
        X.strip(first_of("name")).alias("brand_name"),
        U.absolutize_path_only(first_of("href"), F.col("url")).alias("brand_url"),
        (first_of("image") if image else F.lit(None).cast("string")).alias("image_url"),
    )


def wb_brands(pages: DataFrame, processors: Cleaners | None = None) -> DataFrame:
    found = brand_directory(pages, K.WB, ".i-brand-list a", processors=processors)
    return found.select(
        "page_id", "parse_date", "marketplace", F.col("brand_name").alias("wb_brand_name"),
        F.col("brand_url").alias("wb_brand_url"), F.col("image_url").alias("wb_image_url"),
    )


def ozon_brands(pages: DataFrame, processors: Cleaners | None = None) -> DataFrame:
    found = brand_directory(pages, K.OZON, ".b5x9 a", "::text", None, processors)
    return found.select(
        "page_id", "parse_date", "marketplace", F.col("brand_name").alias("ozon_brand_name"),
        F.col("brand_url").alias("ozon_brand_url"),
    )


def letter_links(pages: DataFrame, index: str) -> DataFrame:
    """Links from a brand index to its letters, the "all" link left out; unnamed links stay."""
    read = html_rules.extract_rules(
        pages, [Rule("href", "::self(href)"), Rule("name", "::text")], f"{index} a", keep=("page_id", "url")
    )
    named = read.select("page_id", "url", first_of("href").alias("href"), first_of("name").alias("name"))
    return drop_all_link(named, "name")


def drop_all_link(found: DataFrame, text: str, label: str = K.ALL_LABEL) -> DataFrame:
    return found.where(~F.col(text).eqNullSafe(F.lit(label)))


def menu_categories(pages: DataFrame, scope: str = "a", processors: Cleaners | None = None) -> DataFrame:
    """Name and address of every menu link, as they stand."""
    rules = [Rule("href", "::self(href)"), Rule("name", "::text")]
    read = cleaned(html_rules.extract_rules(pages, rules, scope, keep=("page_id", "fetched_at")), processors)
    return read.select(
        "page_id",
        F.col("fetched_at").alias("parse_date"),
        F.lit(K.WB).alias("marketplace"),
        first_of("name").alias("wb_category_name"),
        first_of("href").alias("wb_category_url"),
        F.lit(None).cast("int").alias("wb_category_level"),
    )
