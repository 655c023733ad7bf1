"""The best-placed product of each brand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemart.operators import joins
from pagemart.plans import catalog, positions


def best_placed(json_pages: DataFrame, dated_reviews: DataFrame) -> DataFrame:
    """(brand, products, best_position, wb_id, first_review_date) from all JSON listings.

    The best product is found by an aggregate that combines before its shuffle; only one row per
    brand is then joined to the review dates.
    """
    cards = positions.by_offset(catalog.wb_listing_json(json_pages))
    best = (
        cards.where(F.col("wb_brand_name").isNotNull())
        .groupBy(F.col("wb_brand_name").alias("brand"))
        .agg(F.count("*").alias("products"), F.min(F.struct("wb_category_position", "wb_id")).alias("b"))
        .select("brand", "products", F.col("b.wb_category_position").alias("best_position"), F.col("b.wb_id").alias("wb_id"))
    )
    return joins.attach_first(best, dated_reviews, "wb_id", "created_at", "first_review_date")
