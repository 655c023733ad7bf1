"""Ordered scans that stay spread over the cluster when one key holds a large part of the rows.

A plain window sends all rows of a key to one task. Here the rows are dealt by ranges of (keys, order,
tie), on the columns as they are typed, so a large key or a single large order value falls into as many
ranges as it fills. They are written once with the number of their range, the chunk: range bounds are
sampled, and both reads must see the same ones. The window runs inside (key, chunk), and one summary row
per key and chunk carries the result over to later chunks. There is one path for all sizes.

The functions write to the shared folder when they are called (``session.materialise``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pagemart.session import materialise

CHUNK = "_chunk"


def _plain_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """Copies of the keys that are never NULL, with a flag each, so that plain equality on them is
    NULL-safe and the windows, the summaries and the join share one partitioning."""
    added = {}
    for i, name in enumerate(keys):
        kind, column = df.schema[name].dataType, F.col(name)
        if isinstance(kind, T.StringType):
            blank = F.lit("")
        elif isinstance(kind, (T.NumericType, T.BooleanType)):
            blank = F.lit(0).cast(kind)
        else:
            added[f"_k{i}"] = F.struct(column)
            continue
        added[f"_k{i}"], added[f"_n{i}"] = F.coalesce(column, blank), column.isNull()
    return (df.withColumns(added) if added else df), list(added)


def _dealt(df: DataFrame, keys: list[str], order: str, tie: str, parts: int | None, place: str | None) -> DataFrame:
    ranges = [*keys, F.col(order).asc_nulls_last(), F.col(tie).asc_nulls_first()]
    dealt = df.repartitionByRange(parts, *ranges) if parts else df.repartitionByRange(*ranges)
    if place:
        dealt = dealt.sortWithinPartitions(*ranges).withColumn(place, F.monotonically_increasing_id())
    return dealt.withColumn(CHUNK, F.spark_partition_id())


def chunked(df: DataFrame, keys: list[str], order: str, tie: str, parts: int | None = None, place: str | None = None) -> DataFrame:
    """The rows, written, with ``_chunk``: a number that never falls along (order, tie) within a key.

    NULL orders come last, NULL ties first. ``parts`` is the number of ranges, by default that of shuffles. With ``place``
    the ranges are sorted, and that column numbers the rows: those of a key follow each other without a gap.
    """
    return materialise(_dealt(df, keys, order, tie, parts, place), "scan")


class _Layout:
    """The written rows, and windows inside and across the chunks of a key."""

    def __init__(self, df: DataFrame, keys: list[str], order: str, tie: str, parts: int | None, place: str | None = None):
        plain_df, self.plain = _plain_keys(df, keys)
        self.rows = chunked(plain_df, self.plain, order, tie, parts, place)
        # A hash in front makes the sort compare numbers first, not long common prefixes.
        self.group = ["_h", *self.plain, CHUNK]
        self.rows = self.rows.withColumn("_h", F.xxhash64(*self.plain, CHUNK))
        sequence = [F.col(order).asc_nulls_last(), F.col(tie).asc_nulls_first()]
        self.within = Window.partitionBy(*self.group).orderBy(*sequence).rowsBetween(Window.unboundedPreceding, 0)
        # A key has at most one row per chunk here.
        chunks = Window.partitionBy(*self.plain).orderBy(CHUNK)
        self.earlier = chunks.rowsBetween(Window.unboundedPreceding, -1)
        self.upto_here = chunks.rowsBetween(Window.unboundedPreceding, 0)

    def carried(self, totals: DataFrame, *values: Column) -> DataFrame:
        """What earlier chunks hand to each later one; most keys have one chunk and no row here."""
        has_earlier = F.count(F.lit(1)).over(self.earlier).alias("_any")
        return totals.select(*self.group, has_earlier, *values).where("_any > 0").drop("_any")


_CARRY = {
    "sum": lambda before, here: F.coalesce(before, F.lit(0)) + F.coalesce(here, F.lit(0)),
    "max": lambda before, here: F.greatest(before, here),
    "last": lambda before, here: F.coalesce(here, before),
}


def running(
    df: DataFrame, keys: list[str], order: str, tie: str, *, parts: int | None = None, **outs: tuple[str, Column]
) -> DataFrame:
    """Add running values along (order, tie) within the keys, the own row included.

    Each output is named and given as ``("sum" | "max" | "last", column)``; "last" is the latest
    value that is not NULL. ``tie`` must be unique within the keys.
    """
    valued = df.withColumns({f"_v_{o}": v for o, (_, v) in outs.items()})
    layout = _Layout(valued, keys, order, tie, parts)

    def fold(kind: str, value: Column) -> Column:
        return {"sum": F.sum, "max": F.max, "last": lambda v: F.last(v, ignorenulls=True)}[kind](value)

    def summary(kind: str, value: Column) -> Column:
        if kind == "last":
            position = F.struct(F.col(order).isNull(), F.col(order), F.col(tie))
            return F.max_by(value, F.when(value.isNotNull(), position))
        return fold(kind, value)

    local = layout.rows.withColumns({f"_l_{o}": fold(k, F.col(f"_v_{o}")).over(layout.within) for o, (k, _) in outs.items()})
    totals = layout.rows.groupBy(*layout.group).agg(*[summary(k, F.col(f"_v_{o}")).alias(f"_t_{o}") for o, (k, _) in outs.items()])
    before = layout.carried(
        totals, *[fold(k, F.col(f"_t_{o}")).over(layout.earlier).alias(f"_b_{o}") for o, (k, _) in outs.items()]
    )
    return local.join(before, layout.group, "left").select(
        *df.columns, *[_CARRY[k](F.col(f"_b_{o}"), F.col(f"_l_{o}")).alias(o) for o, (k, _) in outs.items()]
    )


def row_number(df: DataFrame, keys: list[str], order: str, tie: str, out: str, parts: int | None = None) -> DataFrame:
    """1-based position along (order, tie) within the keys.

    The written ranges are sorted and numbered, so a position is the distance to the start of the key's run in the
    chunk, and rows need no window: one row per key and chunk says where the run starts.
    """
    layout = _Layout(df, keys, order, tie, parts, "_at")
    runs = layout.rows.groupBy(*layout.group).agg(F.count(F.lit(1)).alias("_all"), F.min("_at").alias("_from"))
    earlier = F.coalesce(F.sum("_all").over(layout.earlier), F.lit(0))
    starts = runs.select(*layout.group, (F.col("_from") - 1 - earlier).alias("_start"))
    return layout.rows.join(starts, layout.group).select(*df.columns, (F.col("_at") - F.col("_start")).alias(out))


def previous(df: DataFrame, keys: list[str], order: str, tie: str, value: Column, out: str, parts: int | None = None) -> DataFrame:
    """The value of the row before along (order, tie) within the keys; NULL for the first."""
    layout = _Layout(df.withColumn("_v", F.struct(value.alias("v"))), keys, order, tie, parts)
    steps = Window.partitionBy(*layout.group).orderBy(F.col(order).asc_nulls_last(), F.col(tie).asc_nulls_first())
    last = layout.rows.groupBy(*layout.group).agg(F.max_by("_v", F.struct(F.col(order).isNull(), F.col(order), F.col(tie))).alias("_last"))
    before = layout.carried(last, F.last("_last").over(layout.earlier).alias("_before"))
    local = layout.rows.withColumn("_lag", F.lag("_v").over(steps))
    return local.join(before, layout.group, "left").select(*df.columns, F.coalesce("_lag", "_before")["v"].alias(out))


def streak(df: DataFrame, keys: list[str], order: str, tie: str, hit: Column, out: str, parts: int | None = None) -> DataFrame:
    """Hits since the last row that was not a hit, the own row included.

    The written ranges are sorted and numbered, so the rows of a key in a chunk are a run of numbers, and a streak
    is the distance to the last row that was not a hit, or to the run's start. A chunk's value is (its rows, the hits at
    its end, whether all are hits): plain aggregates, which combine from chunk to chunk; no window is needed for them.
    """
    layout = _Layout(df.withColumn("_hit", hit), keys, order, tie, parts, "_at")
    miss = F.when(~F.col("_hit"), F.col("_at"))
    ends = layout.rows.groupBy(*layout.group).agg(
        F.count(F.lit(1)).alias("_all"), F.min("_at").alias("_from"), F.max("_at").alias("_to"), F.max(miss).alias("_miss")
    )
    # Rows counted over the chunks of a key; the last miss on that count is where the streak starts.
    summed = ends.withColumn("_sum", F.sum("_all").over(layout.upto_here)).withColumn(
        "_reset", F.col("_sum") - (F.col("_to") - F.col("_miss"))
    )
    carried = F.max("_sum").over(layout.earlier) - F.coalesce(F.max("_reset").over(layout.earlier), F.lit(0))
    before = layout.carried(summed, carried.alias("_carried"))
    local = layout.rows.withColumns({"_base": F.max(miss).over(layout.within), "_from": F.min("_at").over(layout.within)})
    since = F.col("_at") - F.coalesce(F.col("_base"), F.col("_from") - 1 - F.coalesce("_carried", F.lit(0)))
    return local.join(before, layout.group, "left").select(*df.columns, since.alias(out))


class SortedRows:
    """Rows sorted once and stored by range, with an index of the rows of a key before each range.

    A batch (skip some, take some) looks up its ranges in the index, which has one row per key and range, and reads the
    files of these ranges only. The folder holds ``rows``, one folder per range, ``index`` and ``schema``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def store(self, df: DataFrame, keys: list[str], order: str, tie: str, parts: int | None = None) -> SortedRows:
        """Sort and write the rows. NULL keys are a key like others; ``tie`` must be unique within the keys."""
        plain_df, plain = _plain_keys(df, keys)
        dealt = _dealt(plain_df, plain, order, tie, parts, "_at").drop(*plain)
        dealt.limit(0).write.parquet(f"{self.path}/schema")  # an empty table has no files of rows
        dealt.write.partitionBy(CHUNK).parquet(f"{self.path}/rows")
        rows, plain = _plain_keys(self._rows(), keys)
        runs = rows.groupBy(*plain, CHUNK).agg(
            *[F.first(k).alias(k) for k in keys], F.count(F.lit(1)).alias("_all"), F.min("_at").alias("_from")
        )
        earlier = Window.partitionBy(*plain).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        index = runs.withColumn("_before", F.coalesce(F.sum("_all").over(earlier), F.lit(0)))
        index.select(*keys, CHUNK, "_all", "_from", "_before").write.parquet(f"{self.path}/index")
        return self

    def _rows(self) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.path}/schema").schema
        return self.spark.read.schema(schema).parquet(f"{self.path}/rows")

    def batch(self, skip: int, take: int, out: str = "place", **key) -> DataFrame:
        """The rows of a key at the places ``skip + 1`` to ``skip + take``, with their place; none beyond the last."""
        same = F.lit(True)
        for name, value in key.items():
            same &= F.col(name).eqNullSafe(F.lit(value))
        reached = (F.col("_before") < skip + take) & (F.col("_before") + F.col("_all") > skip)
        # Each of these ranges holds a row of the batch, so there are at most as many as rows taken.
        ranges = self.spark.read.parquet(f"{self.path}/index").where(same & reached).select(CHUNK, "_from", "_before").collect()
        rows = self._rows().where(same & F.col(CHUNK).isin([r[CHUNK] for r in ranges]))
        starts = F.create_map(*[F.lit(v) for r in ranges for v in (r[CHUNK], r["_from"] - r["_before"] - 1)]) if ranges else None
        placed = rows.withColumn(out, F.col("_at") - starts[F.col(CHUNK)] if ranges else F.lit(None).cast("long"))
        return placed.where((F.col(out) > skip) & (F.col(out) <= skip + take)).drop("_at", CHUNK)
