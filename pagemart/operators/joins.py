"""Joins that hand context from one page to another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pieces that one partition's share of the rows is cut into; many small pieces even out where they land.
PIECES = 16


def salts_of(counts: DataFrame, key: str, parts: int, pieces: int = PIECES) -> DataFrame:
    """(key, salts) of the keys that hold over a quarter of one partition's share of all rows.

    The salts grow with the key's count, so each piece of it is about share / ``pieces`` rows. There are fewer than
    4 * ``parts`` such keys and about ``pieces`` * ``parts`` salts of them all, whatever the rows. ``counts`` has (key, count).
    """
    share = counts.agg(F.sum("count")).scalar() / parts
    hot = (F.col("count") * 4 > share) & F.col(key).isNotNull()
    return counts.where(hot).select(key, F.ceil(F.col("count") * pieces / share).cast("int").alias("salts"))


def salted_lookup(
    rows: DataFrame, lookup: DataFrame, key: str, spread: Column, how: str = "left",
    parts: int | None = None, salts: int = PIECES, counts: DataFrame | None = None,
) -> DataFrame:
    """Join rows to a lookup with one row per key, when a key may hold a large part of the rows.

    Keys with a large part of one partition's share of the rows are found by an aggregate that combines before
    it shuffles, or given as ``counts`` (key, count) if the caller has them. Their rows are dealt over salts
    in proportion to their number (``salts_of``; ``salts`` is the pieces of a share) and their lookup row is copied
    once per salt. Rows without a key are dealt out, too; other keys are joined as they are. ``parts`` is the
    number of partitions reckoned with, by default those of shuffles.
    """
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.groupBy(key).count() if counts is None else counts
    hot = salts_of(counts, key, parts, salts).withColumnRenamed("salts", "_salts")
    dealt = rows.join(hot, key, "left").withColumn("_salts", F.when(F.col(key).isNull(), parts * salts).otherwise(F.col("_salts")))
    dealt = dealt.withColumn("_salt", F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64(spread), "_salts")).otherwise(0).cast("int"))
    copies = F.when(F.col("_salts").isNotNull(), F.sequence(F.lit(0), F.col("_salts") - 1)).otherwise(F.array(F.lit(0)))
    copied = lookup.join(hot, key, "left").withColumn("_salt", F.explode(copies))
    return dealt.drop("_salts").join(copied.drop("_salts"), [key, "_salt"], how).drop("_salt")


def first_edges(edges: DataFrame, key: str, *context: str) -> DataFrame:
    """One edge per target: the one found first by (position, from_page)."""
    order = F.struct("position", "from_page")
    return edges.groupBy(key).agg(F.min_by(F.struct(*context), order).alias("e")).select(key, "e.*")


def category_context(pages: DataFrame, edges: DataFrame, key: str, *context: str) -> DataFrame:
    """Detail pages with the context of the listing that led to them; NULL where none did."""
    return pages.join(first_edges(edges, key, *context), key, "left")


def attach_first(records: DataFrame, dated: DataFrame, key: str, moment: str, out: str) -> DataFrame:
    """Records with the earliest date of their dated rows; records without any are kept."""
    first = dated.groupBy(key).agg(F.min(moment).alias(out))
    return records.join(first, key, "left")


def attach_count(records: DataFrame, rows: DataFrame, key: str, out: str) -> DataFrame:
    """Records with the number of their rows, NULL without any; counted before the join."""
    return records.join(rows.groupBy(key).agg(F.count("*").alias(out)), key, "left")


def menu_lookup(items: DataFrame, tops: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(items with their top menu, items whose menu id is unknown).

    No broadcast is forced: Spark broadcasts the menu when its measured size allows it.
    """
    return items.join(tops, key), items.join(tops.select(key), key, "left_anti")
