"""Filters and projections the jobs' options stand for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Cleaners = dict[str, Callable[[Column], Column]]


def cleaned(records: DataFrame, cleaners: Cleaners | None) -> DataFrame:
    """Apply the user's per-field functions; a name that is no field is an error, not passed over."""
    unknown = sorted(set(cleaners or {}) - set(records.columns))
    if unknown:
        raise ValueError(f"no such field: {', '.join(unknown)}; there are {', '.join(records.columns)}")
    return records.withColumns({name: clean(F.col(name)) for name, clean in cleaners.items()}) if cleaners else records


def skip_images(records: DataFrame, skip: bool) -> DataFrame:
    """Without the image column. A plain boolean: any text would count as true otherwise."""
    return records.drop("image_urls") if skip else records


def skip_variants(records: DataFrame, skip: bool) -> DataFrame:
    return records.where(F.col("wb_parent_id").isNull()) if skip else records


def only_region(producers: DataFrame, region: str) -> DataFrame:
    """Producers of one region, by the stored region column: reaches a partitioned source."""
    return producers.where(F.col("region") == region)


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Records of several jobs in one feed; columns a job lacks are NULL."""
    whole = feeds[0]
    for feed in feeds[1:]:
        whole = whole.unionByName(feed, allowMissingColumns=True)
    return whole
