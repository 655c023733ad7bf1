"""Smaller shops: card lists, detail pages and article pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemart import constants as K
from pagemart.functions import collections as C
from pagemart.functions import text as X
from pagemart.functions import urls as U
from pagemart.operators import html_rules
from pagemart.operators.filters import Cleaners, cleaned
from pagemart.operators.html_rules import Rule, first_of

# Selectors equal to the pages' markup.
CARD_RULES = [
    Rule("heading", "h1::text", at="page"),
    Rule("id", ".product__img::attr(id)"),
    Rule("href", ".product__img a.product__a::attr(href)"),
    Rule("name", ".product__title a.product__a::text"),
    Rule("price", ".prices__actual::text"),
]


def shop_listing(
    pages: DataFrame, card: str = ".product", rules: list[Rule] = CARD_RULES, processors: Cleaners | None = None
) -> DataFrame:
    read = html_rules.extract_rules(pages, rules, card, keep=("page_id", "url", "category_url", "category_name"))
    read = cleaned(read, processors)
    category = F.coalesce("category_url", U.strip_query(F.col("url")))
    return read.select(
        "page_id",
        F.col("scope_no").alias("position"),
        first_of("id").alias("id"),
        U.absolutize_path_only(first_of("href"), F.col("url")).alias("url"),
        F.coalesce("category_name", first_of("heading")).alias("category_name"),
        U.absolutize_path_only(category, F.col("url")).alias("category_url"),
        first_of("name").alias("name"),
        first_of("price").alias("price"),
    )


_PHOTO = ".details-carousel-item .gallery-photos-item-obj"
# Selectors equal to the pages' markup.
DETAIL_RULES = [
    Rule("sku", ".details-sku .details-param-value::text"),
    Rule("price", ".price-number::text"),
    Rule("dimensions", ".details-dimensions .details-param-value::text"),
    Rule("weight", ".details-param-value-weight::text"),
    Rule("shown", f"{_PHOTO}::attr(src)"),
    Rule("lazy", f"{_PHOTO}::attr(data-src)"),
]


def shop_product(pages: DataFrame, rules: list[Rule] = DETAIL_RULES, processors: Cleaners | None = None) -> DataFrame:
    read = cleaned(html_rules.extract_rules(pages, rules, keep=("page_id", "url", "fetched_at")), processors)
    return read.select(
        "page_id",
        F.col("fetched_at").alias("parse_date"),
        F.lit(K.TOYS).alias("marketplace"),
        X.strip(first_of("sku")).alias("id"),
        F.col("url").alias("product_url"),
        first_of("price").alias("price"),
        X.strip(first_of("dimensions")).alias("dimensions"),
        first_of("weight").alias("weight"),
        C.map_compose(F.concat("shown", "lazy"), X.strip, X.full_size_image2).alias("pictures"),
    )


# Selectors equal to the pages' markup.
ARTICLE_RULES = [
    Rule("block", "div.prod--art:first-of-type"),
    Rule("vendor", "span[itemprop=productID]::text"),
]


def shop_article(pages: DataFrame, rules: list[Rule] = ARTICLE_RULES, processors: Cleaners | None = None) -> DataFrame:
    read = cleaned(html_rules.extract_rules(pages, rules, keep=("page_id",)), processors)
    return read.select(
        "page_id", X.clean_article(first_of("block")).alias("article"), first_of("vendor").alias("vendor_code")
    )


# Selectors equal to the pages' markup.
TREE_EDGES = {
    "menu": "a.menu-dropdown-link",
    "category": ".product-categories a",
    "product": ".products-view-name a",
    "next": ".pagenumberer-next",
}


def page_edges(pages: DataFrame, kinds: dict[str, str] = TREE_EDGES) -> DataFrame:
    """(from_page, src, dst, kind) links of the given kinds, absolute."""
    rules = [Rule(kind, f"{selector}::attr(href)") for kind, selector in kinds.items()]
    read = html_rules.extract_rules(pages, rules, keep=("page_id", "url"))
    long = html_rules.rule_values(read, rules, keep=("page_id", "url"))
    return long.select(
        F.col("page_id").alias("from_page"), F.col("url").alias("src"),
        U.absolutize_keep_query(F.col("value"), F.col("url")).alias("dst"), F.col("rule").alias("kind"), "ord",
    )
