"""The list of registered queries with their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagemart.session import materialise

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    source = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return source.select(*columns) if columns else source


def spread_table(spark: SparkSession, sf_dir: str, name: str, key: str, *columns: str, written: bool = False) -> DataFrame:
    """A table whose rows become pages to parse; dealt over all cores if it would be read in fewer tasks.

    Parsing a page costs far more than moving it, and one small file would be one task. With ``written`` the dealt rows
    are written to the shared folder: a filter on what is made of them would else move below the dealing, where the
    bodies it reads would be made in the few tasks that read the table.
    """
    rows, cores = table(spark, sf_dir, name, key, *columns), spark.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() >= cores:
        return rows
    dealt = rows.repartition(cores, key)
    return materialise(dealt, "dealt") if written else dealt
