"""Positions of cards within their category.

Two methods give different numbers when pages differ in size, so records carry a ``method`` tag.
Both read the cards twice, so the cards are written once first: parsing page bodies is the costly
part, and the cards are small next to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemart.operators import joins, scans
from pagemart.session import materialise


def by_offset(cards: DataFrame, category: str = "wb_category_url", out: str = "wb_category_position") -> DataFrame:
    """Cards before the page + position on the page.

    The page's own ``offset`` counts where it is known, the one its listing edge was made with. Else it is
    (page - 1) x the cards of the category's first page, or of its fullest page if the first was not captured.
    """
    cards = materialise(cards, "cards")
    own = F.col("offset") if "offset" in cards.columns else F.lit(None).cast("long")
    first = F.max(F.when(F.col("page_no") == 1, F.col("position")))
    size = cards.groupBy(category).agg(F.coalesce(first, F.max("position")).alias("_first"))
    placed = joins.salted_lookup(cards, size, category, F.col("page_id"))
    before = F.coalesce(own, (F.col("page_no") - 1) * F.col("_first"))
    return placed.withColumns({out: (before + F.col("position")).cast("int"), "method": F.lit("offset")}).drop("_first", "offset")


def running(cards: DataFrame, category: str = "wb_category_url", out: str = "wb_category_position") -> DataFrame:
    """Cards of all earlier pages of the category + position on the page."""
    cards = materialise(cards, "cards")
    pages = cards.groupBy(category, "page_id").agg(F.min("page_no").alias("page_no"), F.count("*").alias("_n"))
    before = scans.running(pages, [category], "page_no", "page_id", _upto=("sum", F.col("_n"))).select(
        "page_id", (F.col("_upto") - F.col("_n")).alias("_before")
    )
    return (
        cards.join(before, "page_id")
        .withColumns({out: (F.col("_before") + F.col("position")).cast("int"), "method": F.lit("running")})
        .drop("_before")
    )
