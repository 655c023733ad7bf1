"""The category tree of a menu page as three tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagemart import constants as K
from pagemart.functions import collections as C
from pagemart.functions import text as X
from pagemart.operators import html_rules
from pagemart.operators.html_rules import Rule, first_of

# Selectors equal to the pages' markup.
TOP = "#top-menu > ul > li"
TOP_RULES = [
    Rule("top_ids", "::self(data-menu-id)", each=TOP, at="page"),
    Rule("top_names", "a::text", each=TOP, at="page"),
    Rule("top_links", "a::attr(href)", each=TOP, at="page"),
]
# Selectors equal to the pages' markup.
COLUMN_RULES = [
    Rule("menu_id", "::self(data-menu-id)", at="parent"),
    Rule("menu_class", "::self(class)", at="parent"),
    Rule("own_class", "::self(class)"),
    Rule("title", "::text", each="> a"),
    Rule("title_href", "::self(href)", each="> a"),
    Rule("names", "::text", each="ul li a"),
    Rule("hrefs", "::self(href)", each="ul li a"),
    Rule("flat_names", "::text", each="li a"),
    Rule("flat_hrefs", "::self(href)", each="li a"),
]


def classes(rule: str) -> Column:
    return F.split(X.strip(F.coalesce(first_of(rule), F.lit(""))), r"\s+")


def menu_columns(pages: DataFrame, rules: list[Rule] = COLUMN_RULES + TOP_RULES) -> DataFrame:
    """One row per submenu column: menu, number within the page, classes, titles, links and the
    page's top menus. A page is parsed once for all of it."""
    read = html_rules.extract_rules(pages, rules, "#submenu > ul > *", keep=("page_id",))
    return read.select(
        "page_id",
        first_of("menu_id").alias("menu_id"),
        classes("menu_class").alias("menu_classes"),
        F.col("scope_no").alias("column_no"),
        classes("own_class").alias("classes"),
        first_of("title").alias("own_title"),
        first_of("title_href").alias("own_href"),
        *(r.name for r in rules if r.name in ("names", "hrefs", "flat_names", "flat_hrefs")),
        *(r.name for r in rules if r in TOP_RULES),
    )


def has_class(column: str, *wanted: str) -> Column:
    return F.arrays_overlap(F.col(column), F.array(*[F.lit(w) for w in wanted]))


def drop_banner_menus(columns: DataFrame) -> DataFrame:
    return columns.where(~has_class("menu_classes", K.BANNER_MENU))


def drop_banners(columns: DataFrame) -> DataFrame:
    """Leave out banner, brand-letter and brand-page columns."""
    return drop_banner_menus(columns).where(~has_class("classes", *K.SKIPPED_COLUMNS))


def carry_titles(columns: DataFrame) -> DataFrame:
    """Give columns without a title of their own the former one in the same menu.

    Skipped and flat columns reset the title to ''. A menu's columns all come from one page, so the
    window never holds more than a page does.
    """
    reset = has_class("classes", *K.SKIPPED_COLUMNS, K.FLAT_COLUMN)
    titled = ~reset & has_class("classes", K.TITLED_COLUMN) & F.col("own_title").isNotNull()
    mark = F.when(reset, F.lit("")).when(titled, F.col("own_title"))
    order = Window.partitionBy("page_id", "menu_id").orderBy("column_no")
    first = F.row_number().over(order) == 1
    return columns.withColumns(
        {"level_2": F.coalesce(F.last(mark, ignorenulls=True).over(order), F.lit("")), "titled": titled, "first_column": first}
    )


def with_top_menu(columns: DataFrame) -> DataFrame:
    """Columns with their top menu's name and link, looked up by menu id in the page's own list.

    Of equal ids the last counts; ``level_1`` is NULL where the id is unknown.
    """
    tops = C.pairs("top_ids", F.arrays_zip(F.col("top_names").alias("name"), F.col("top_links").alias("link")))
    found = F.try_element_at(C.last_wins_map(tops), F.col("menu_id"))
    return columns.withColumn("_top", found).withColumns(
        {"level_1": F.col("_top.name"), "top_link": F.col("_top.link"), "known": F.col("_top").isNotNull()}
    ).drop("_top", "top_ids", "top_names", "top_links")


def category_rows(pages: DataFrame) -> DataFrame:
    """(page_id, level, level_1, level_2, level_3, link, known) of all three levels in one pass.

    Columns whose menu id is unknown have ``known`` false.
    """
    columns = carry_titles(drop_banner_menus(with_top_menu(menu_columns(pages))))
    kept = ~has_class("classes", *K.SKIPPED_COLUMNS)
    flat = has_class("classes", K.FLAT_COLUMN)
    names = F.when(flat, F.col("flat_names")).otherwise(F.col("names"))
    hrefs = F.when(flat, F.col("flat_hrefs")).otherwise(F.col("hrefs"))

    def row(level: int, second: Column, third: Column, link: Column) -> Column:
        return F.struct(
            F.lit(level).alias("level"), second.alias("level_2"), third.alias("level_3"), link.alias("link")
        )

    none = F.lit(None).cast("string")
    nothing = F.array().cast("array<struct<level:int,level_2:string,level_3:string,link:string>>")
    rows = F.concat(
        F.when(F.col("first_column"), F.array(row(1, none, none, F.col("top_link")))).otherwise(nothing),
        F.when(kept & F.col("titled"), F.array(row(2, F.col("own_title"), none, F.col("own_href")))).otherwise(nothing),
        F.when(
            kept, F.zip_with(names, hrefs, lambda name, link: row(3, F.col("level_2"), name, link))
        ).otherwise(nothing),
    )
    return columns.select("page_id", "level_1", "known", F.explode(rows).alias("r")).select(
        "page_id", "r.level", "level_1", "r.level_2", "r.level_3", "r.link", "known"
    )


def category_tree(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables as they are written: (L1, link), (L1, L2, link), (L1, L2, L3, link)."""
    known = rows.where("known")
    return (
        known.where("level = 1").select("level_1", "link"),
        known.where("level = 2").select("level_1", "level_2", "link"),
        known.where("level = 3").select("level_1", "level_2", "level_3", "link"),
    )


def category_records(rows: DataFrame) -> DataFrame:
    """Category records with the level that the shop's own record leaves empty."""
    name = F.when(F.col("level") == 1, F.col("level_1")).when(F.col("level") == 2, F.col("level_2")).otherwise(F.col("level_3"))
    return rows.where("known").select(
        "page_id", F.lit(K.WB).alias("marketplace"), name.alias("wb_category_name"),
        F.col("link").alias("wb_category_url"), F.col("level").alias("wb_category_level"),
    )
