"""Producer records with address, coordinates and distance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemart import constants as K
from pagemart.functions import collections as C
from pagemart.functions import geo
from pagemart.functions import text as X
from pagemart.functions import urls as U
from pagemart.operators import html_rules, joins, links
from pagemart.operators.filters import Cleaners, cleaned
from pagemart.operators.html_rules import Rule, first_of

# Selectors equal to the pages' markup.
CARD_RULES = [
    Rule("heading", "h1::text", at="page"),
    Rule("href", "a.link:nth-of-type(1)::attr(href)"),
    Rule("goods", 'a[title="Все товары производителя"]::text'),
]


def producer_cards(
    pages: DataFrame, card: str = "#content .items .item", processors: Cleaners | None = None
) -> DataFrame:
    """Edges from category pages to producers, with the goods count and the category."""
    read = html_rules.extract_rules(
        pages, CARD_RULES, card, keep=("page_id", "url", "category_url", "category_name")
    )
    read = cleaned(read, processors)
    return read.select(
        F.col("page_id").alias("from_page"),
        F.col("scope_no").alias("position"),
        U.absolutize_keep_query(first_of("href"), F.col("url")).alias("to_url"),
        F.coalesce("category_url", U.strip_query(F.col("url"))).alias("category_url"),
        F.coalesce("category_name", first_of("heading")).alias("category_name"),
        first_of("goods").alias("goods_count"),
    )


# Selectors equal to the pages' markup.
PRODUCER_RULES = [
    Rule("name", "h1.cfix::text"),
    Rule("about", "#box_description .box_text"),
    Rule("phone", 'span[itemprop="telephone"]::text'),
    Rule("email", 'span[itemprop="email"]::text'),
    Rule("website", "#producer_link::text"),
    Rule("region", 'span[itemprop="addressRegion"]::text'),
    Rule("town", 'span[itemprop="addressLocality"]::text'),
    Rule("street", 'span[itemprop="streetAddress"]::text'),
    Rule("logo", 'a.fancybox[data-fancybox-group="producer"]::attr(href)'),
    Rule("price_lists", "#box_files a::attr(href)"),
]


def producer_page(
    pages: DataFrame, office: tuple[float, float] | None = None, rules: list[Rule] = PRODUCER_RULES, processors: Cleaners | None = None
) -> DataFrame:
    """Producer records; with an office point also the distance to it in km."""
    own, _ = links.resolve_canonical(pages, links.canonical_href(F.col("body")))
    placed = own.withColumn("_coords", X.coords_text(F.col("body")))
    read = cleaned(html_rules.extract_rules(placed, rules, keep=("page_id", "url", "fetched_at", "_coords")), processors)
    records = read.select(
        "page_id",
        F.col("fetched_at").alias("parse_date"),
        F.lit(K.PRODUCTCENTER).alias("marketplace"),
        F.col("url").alias("producer_url"),
        C.take_first(F.col("name")).alias("producer_name"),
        C.take_first(F.col("about")).alias("producer_about"),
        X.join_address(first_of("region"), first_of("town"), first_of("street")).alias("producer_address"),
        F.col("_coords").alias("producer_coords"),
        C.take_first(F.col("phone")).alias("producer_phone"),
        C.take_first(F.col("email")).alias("producer_email"),
        C.take_first(F.col("website")).alias("producer_website"),
        U.absolutize_path_only(first_of("logo"), F.col("url")).alias("producer_logo"),
        F.lit(None).cast("string").alias("producer_rating"),
        C.map_compose(F.col("price_lists"), lambda u: U.absolutize_path_only(u, F.col("url"))).alias("producer_price_lists"),
    )
    if office is None:
        return records.withColumn("producer_distance", F.lit(None).cast("double"))
    point = X.coords_struct(F.col("producer_coords"))
    here = (F.lit(float(office[0])), F.lit(float(office[1])))
    return geo.with_distance(records, here, (point["lat"], point["lon"]), "producer_distance")


def producers(
    pages: DataFrame, cards: DataFrame, office: tuple[float, float] | None = None, processors: Cleaners | None = None
) -> DataFrame:
    """The full feed: producer pages with the category and goods count of their first card."""
    records = producer_page(pages, office, processors=processors)
    listed = cards.withColumnRenamed("to_url", "producer_url")
    context = joins.category_context(records, listed, "producer_url", "category_url", "category_name", "goods_count")
    return context.withColumnRenamed("goods_count", "producer_goods_count")


def menu_edges(pages: DataFrame, region: str | None = None) -> DataFrame:
    """Categories of a front page's menu, limited to a region if one is given."""
    rules = [Rule("href", "a:nth-of-type(1)::attr(href)"), Rule("name", "a:nth-of-type(1)::text")]
    read = html_rules.extract_rules(pages, rules, ".hcm_producers li ul li", keep=("page_id", "url"))
    href = first_of("href") if region is None else U.limit_to_region(first_of("href"), region)
    return read.select(
        F.col("page_id").alias("from_page"),
        U.absolutize_path_only(href, F.col("url")).alias("to_url"),
        first_of("name").alias("category_name"),
    )
