"""Inputs: captured pages, seeds, endpoint lists and fetch logs."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemart.functions import text as X
from pagemart.functions import urls as U


def captured_pages(spark: SparkSession, source: str, *columns: str) -> DataFrame:
    """Stored pages, from a path or from a table of the catalog; name the columns used so that only they are read.

    A table written by ``sinks.write_pages`` keeps its buckets only when it is read by its name: joins and
    de-duplication by page id then move no bodies.
    """
    by_name = re.fullmatch(r"\w+(\.\w+){0,2}", source) and spark.catalog.tableExists(source)
    pages = spark.table(source) if by_name else spark.read.parquet(source)
    return pages.select(*columns) if columns else pages


def fetch_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def seed_urls(options: DataFrame) -> DataFrame:
    """(kind, url) seeds from rows of options, several URLs per option parted by commas.

    Per row the category option goes before the product option, and that before the menu.
    """
    chosen = (
        F.when(F.col("category_url").isNotNull(), F.struct(F.lit("category").alias("kind"), F.col("category_url").alias("v")))
        .when(F.col("good_url").isNotNull(), F.struct(F.lit("product").alias("kind"), F.col("good_url").alias("v")))
        .otherwise(
            F.struct(
                F.when(F.coalesce("use_sitemap", F.lit(False)), F.lit("sitemap")).otherwise("menu").alias("kind"),
                F.when(F.coalesce("use_sitemap", F.lit(False)), F.col("sitemap_url")).otherwise(F.col("menu_url")).alias("v"),
            )
        )
    )
    return (
        options.select(chosen.alias("s"))
        .select("s.kind", F.explode(F.split("s.v", ",")).alias("url"))
        .where(X.strip(F.col("url")) != "")
    )


def endpoint_list(lines: DataFrame, column: str = "value") -> DataFrame:
    """Distinct endpoints from lines that may hold comma lists, blanks and ``#`` remarks."""
    entry = X.strip(F.col("entry"))
    return (
        lines.select(F.explode(F.split(column, ",")).alias("entry"))
        .select(entry.alias("entry"))
        .where((F.col("entry") != "") & ~F.col("entry").startswith("#"))
        .select(U.with_scheme(F.col("entry")).alias("endpoint"))
        .distinct()
    )


def endpoint_file(spark: SparkSession, path: str) -> DataFrame:
    return endpoint_list(spark.read.text(path))


def require_seeds(seeds: DataFrame) -> DataFrame:
    if seeds.isEmpty():
        raise ValueError("no seeds: give a category, a product or a start page")
    return seeds


def only_urls(pages: DataFrame, wanted: DataFrame, key: Column) -> DataFrame:
    """Pages whose key is among the wanted ``url_key`` values."""
    return pages.withColumn("url_key", key).join(wanted.select("url_key"), "url_key", "left_semi")
