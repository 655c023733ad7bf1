"""Review records, batches and dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemart import constants as K
from pagemart.functions import jsonx as J
from pagemart.operators import html_rules, links, scans
from pagemart.operators.html_rules import Rule, first_of


def reviews(batches: DataFrame, *keep: str) -> DataFrame:
    """Reviews of JSON batches; a NULL list, the mark of the end, gives no rows."""
    rows = batches.select("page_id", *keep, F.posexplode(J.feedbacks(F.col("body"))).alias("ord", "f"))
    return rows.select(
        "page_id", *keep, "ord", F.col("f.text").alias("text"), F.col("f.productValuation").alias("rating"),
        F.col("f.createdDate").alias("created_at"),
    )


def review_target(script: Column) -> Column:
    """(imt_id, feedbacks) of a product page's state; (NULL, 0) where it is absent."""
    product = J.state_v2(script)["router"]["ssrModel"]["product"]
    return F.struct(product["imtId"].alias("imt_id"), F.coalesce(product["feedbacks"], F.lit(0)).alias("feedbacks"))


def review_targets(pages: DataFrame) -> DataFrame:
    rule = [Rule("script", 'script:contains("wb.spa.init")::text')]
    read = html_rules.extract_rules(pages, rule, keep=("page_id",))
    return read.select("page_id", review_target(first_of("script")).alias("t")).select("page_id", "t.*")


def rejected_states(scripts: DataFrame, script: str) -> DataFrame:
    """Pages whose script holds an init call that cannot be read as plain data."""
    argument = J.state_text(F.col(script), "wb.spa.init")
    parsed = J.state_v2(F.col(script))["router"]
    return scripts.where(F.col(script).contains("wb.spa.init") & (argument.isNull() | parsed.isNull()))


def review_requests(targets: DataFrame) -> DataFrame:
    """One row per batch of reviews to ask for."""
    return links.review_pages_by_total(targets, F.col("feedbacks")).withColumn("order", F.lit("dateAsc"))


def first_review_date(pages: DataFrame, *keep: str) -> DataFrame:
    """Date of the first comment of an ascending review page; NULL for a comment without one."""
    rule = [Rule("dates", ".time::attr(content)", each=".comment")]
    read = html_rules.extract_rules(pages, rule, keep=("page_id", *keep))
    return read.select("page_id", *keep, first_of("dates").alias("wb_first_review_date")).where(F.size("dates") > 0)


def batch_numbers(rows: DataFrame, keys: list[str], order: str, tie: str, take: int = K.REVIEW_BATCH) -> DataFrame:
    """Rows with their place along (order, tie) within the keys and the batch that place falls in."""
    placed = scans.row_number(rows, keys, order, tie, "place")
    return placed.withColumn("batch", F.floor((F.col("place") - 1) / take))
