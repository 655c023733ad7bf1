"""The jobs as streams: endpoint health, ban counters, records as pages arrive, duplicates.

Each stream takes the path of its table and that of its checkpoint. A run reads all that is there and
ends; a later run with the same paths goes on where the last one stopped. Each micro-batch writes its own
partition, replacing what an earlier try of the same batch left there, so no row is lost or doubled.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pagemart import constants as K
from pagemart.operators import health
from pagemart.session import delete_path, exists

# The state processor goes to the workers with the job, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
NEVER = (-(2**63), -(2**63))


def file_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """A table's files as a stream; the files per batch bound what one batch holds.

    The path is given as a pattern that only matches itself: a stream takes a plain path for a
    folder, and a table may also be a single file.
    """
    schema = spark.read.parquet(path).schema
    pattern = f"{path[:-1]}[{path[-1]}]"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(pattern)


@contextmanager
def large_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB: on disk, by key, with only changes sent to the checkpoint."""
    settings = {_PROVIDER: _ROCKSDB, _CHANGELOG: "true"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def run_to_table(
    stream: DataFrame, table: str, checkpoint: str, mode: str = "append", per_batch: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    ends: Callable[[DataFrame, int], bool] | None = None,
) -> DataFrame:
    """Run a stream over all that is new and return all rows of its table, with their ``batch_id``.

    ``per_batch`` is applied to the rows of each micro-batch before they are written. ``ends`` is asked with the
    written rows of each batch and its number; once it holds, that batch is the last of the run. The next one is refused
    before it writes, so a later run takes it up.
    """
    spark = stream.sparkSession
    schema = per_batch(spark.createDataFrame([], stream.schema)).schema
    ended: list[int] = []

    def store(rows: DataFrame, batch_id: int) -> None:
        if ended:
            raise RuntimeError(f"the run ended with batch {ended[0]}")
        path = f"{table}/batch_id={batch_id}"
        per_batch(rows).write.mode("overwrite").parquet(path)
        if ends is not None and ends(spark.read.schema(schema).parquet(path), batch_id):
            ended.append(batch_id)

    query = (
        stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(store)
    ).start()
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if not ended:
            raise
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    if not exists(spark, table):
        return spark.createDataFrame([], f"{fields}, batch_id bigint")
    return spark.read.schema(f"{fields}, batch_id bigint").parquet(table)


class EndpointHealth(StatefulProcessor):
    """State of one endpoint: failures since the last success and the time of its next check.

    Kept are the (time, id) of the last success and of the newest outcome, and the bans since that success.
    A success may still come in late, but not older than the watermark: it then ends all bans before it. So bans
    older than the watermark are only counted, and the newer ones are listed. A timer at the next check
    moves a dead endpoint back to unchecked; its failures stay counted until a success.
    """

    def __init__(self, base: float, cap: float):
        self.base, self.cap = base, cap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(
            "health", "ok_us bigint, ok_id bigint, new_us bigint, new_id bigint, counted bigint, failed bigint, next_us bigint"
        )
        self.bans = handle.getListState("bans", "ts_us bigint, request_id bigint")

    def _emit(self, key: Any, state: str, failed: int, next_us: int | None, at_us: int) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "proxy": [key[0]], "state": [state], "failed_attempts": [failed],
                "next_check": pd.to_datetime(pd.Series([next_us], dtype="Int64"), unit="us"),
                "changed_at": pd.to_datetime(pd.Series([at_us], dtype="Int64"), unit="us"),
            }
        )

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        ok, newest, counted = NEVER, NEVER, 0
        if self.state.exists():
            ok_us, ok_id, new_us, new_id, counted, _, _ = self.state.get()
            ok, newest = (ok_us, ok_id), (new_us, new_id)
        held = list(self.bans.get()) if self.bans.exists() else []
        bans = np.array(held, np.int64).reshape(-1, 2)
        before = ok
        for part in rows:
            at = np.column_stack([part["ts_us"].to_numpy(np.int64), part["request_id"].to_numpy(np.int64)])
            at, ban = at[in_time := np.lexsort((at[:, 1], at[:, 0]))], part["ban"].to_numpy(bool)[in_time]
            newest = max(tuple(at[-1].tolist()), newest)
            if not ban.all():
                ok = max(tuple(at[~ban][-1].tolist()), ok)
            bans = np.concatenate([bans, at[ban]])
            bans = bans[(bans[:, 0] > ok[0]) | ((bans[:, 0] == ok[0]) & (bans[:, 1] > ok[1]))]
        if ok != before:
            counted = 0  # those were older than the watermark, and a success that comes in is not
        old = bans[:, 0] < timerValues.getCurrentWatermarkInMs() * 1000
        counted, bans = int(counted) + int(old.sum()), bans[~old]
        failed = counted + len(bans)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        next_us = None
        if failed:
            wait = min(self.cap, self.base * 2.0 ** min(failed - 1, 60))
            next_us = newest[0] + int(round(wait * 1_000_000))
            self.handle.registerTimer(-(-next_us // 1000))
        self.state.update((*ok, *newest, counted, failed, next_us))
        if len(bans):
            self.bans.put([tuple(b) for b in bans.tolist()])
        else:
            self.bans.clear()
        yield self._emit(key, "dead" if failed else "good", failed, next_us, newest[0])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        *_, failed, next_us = self.state.get()
        yield self._emit(key, "unchecked", int(failed), int(next_us), int(next_us))

    def close(self) -> None:
        pass


def endpoint_health(
    log: DataFrame, policy: health.Policy = health.is_ban, delay: str = "10 minutes",
    base: float = K.BACKOFF_BASE, cap: float = K.BACKOFF_CAP,
) -> DataFrame:
    """The changes of state of every endpoint in a streamed fetch log, in event time."""
    judged = (
        health.outcomes(log, policy)
        .withWatermark("ts", delay)
        .select("proxy", "request_id", "ts", F.unix_micros("ts").alias("ts_us"), "ban")
    )
    return judged.groupBy("proxy").transformWithStateInPandas(
        statefulProcessor=EndpointHealth(base, cap),
        outputStructType="proxy string, state string, failed_attempts bigint, next_check timestamp, changed_at timestamp",
        outputMode="Update",
        timeMode="EventTime",
    )


def _last_states(changes: DataFrame) -> DataFrame:
    """The newest change of each endpoint."""
    whole = F.struct("state", "failed_attempts", "next_check", "changed_at", "batch_id")
    return changes.groupBy("proxy").agg(F.max_by(whole, F.struct("changed_at", "batch_id")).alias("s")).select("proxy", "s.*")


def _reason_path(table: str) -> str:
    return f"{table.rstrip('/')}-ended"


def stopped_for(spark: SparkSession, table: str) -> DataFrame:
    """(batch_id, reason) of the last run's end, as ``final_health`` with ``stop_when_none_left`` stored it; empty if it read all."""
    path = _reason_path(table)
    return spark.read.schema("batch_id bigint, reason string").json(path) if exists(spark, path) else spark.createDataFrame([], "batch_id bigint, reason string")


def final_health(
    log: DataFrame, table: str, checkpoint: str, reset_when_none_left: bool = False,
    stop_when_none_left: bool = False, endpoints: DataFrame | None = None, **options: Any
) -> DataFrame:
    """Run the health stream over all that is new; one row per endpoint, its last state so far.

    With ``reset_when_none_left``, dead endpoints are unchecked if no other is left. With ``stop_when_none_left`` the run
    ends after the first batch that leaves no endpoint good or unchecked, and stores why (``stopped_for``); batches
    after it are read by the next run. Listed ``endpoints`` (proxy) that were never tried count as left. To tell, each
    batch writes the last states, a row per endpoint, made from those of the batch before and its own changes.
    """
    spark = log.sparkSession
    latest = f"{table.rstrip('/')}-latest"

    def none_left(changes: DataFrame, batch_id: int) -> bool:
        rows = changes.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        before = f"{latest}/{batch_id - 1}"
        if exists(spark, before):
            rows = spark.read.parquet(before).unionByName(rows)
        elif batch_id:  # earlier runs did not ask
            earlier = spark.read.schema(rows.schema).parquet(table)
            rows = earlier.where(F.col("batch_id") < batch_id).unionByName(rows)
        _last_states(rows).write.mode("overwrite").parquet(f"{latest}/{batch_id}")
        if batch_id > 1:
            delete_path(spark, f"{latest}/{batch_id - 2}")
        states = spark.read.parquet(f"{latest}/{batch_id}").select("proxy", "state")
        if endpoints is not None:
            listed = endpoints.select("proxy").distinct().join(states, "proxy", "left_anti")
            states = states.unionByName(listed.withColumn("state", F.lit("unchecked")))
        reason = health.stop_reason(states, stop=True).where("reason IS NOT NULL")
        if reason.isEmpty():
            return False
        reason.select(F.lit(batch_id).cast("bigint").alias("batch_id"), "reason").coalesce(1).write.mode("overwrite").json(_reason_path(table))
        return True

    if stop_when_none_left and exists(spark, _reason_path(table)):
        delete_path(spark, _reason_path(table))
    with large_state(spark):
        changes = run_to_table(
            endpoint_health(log, **options), table, checkpoint, "update", ends=none_left if stop_when_none_left else None
        )
    last = _last_states(changes).drop("changed_at", "batch_id")
    return health.reset_when_none_left(last) if reset_when_none_left else last


def ban_counters(bans: DataFrame) -> DataFrame:
    """Bans per status in windows of the reporting interval, from (ts, status); a batch, or one micro-batch."""
    counted = bans.groupBy(F.window("ts", K.STATS_INTERVAL), "status").agg(F.count(F.lit(1)).alias("bans"))
    return counted.select(F.col("window.start").alias("window_start"), "status", "bans")


def final_counters(log: DataFrame, table: str, checkpoint: str, policy: health.Policy = health.is_ban) -> DataFrame:
    """Run the counters over all that is new; bans per window and status over all that was ever read.

    Each micro-batch stores the counts of its own rows, and reading adds them up. No state is held between
    batches and no watermark passes, so a row counts however late, and in whatever order of files, it comes in.
    """
    bans = health.outcomes(log, policy).where(F.col("ban") & F.col("status").isNotNull()).select("ts", "status")
    counts = run_to_table(bans, table, checkpoint, per_batch=ban_counters)
    return counts.groupBy("window_start", "status").agg(F.sum("bans").alias("bans"))


def incremental_items(pages: DataFrame, job: Callable[[DataFrame], DataFrame], table: str, checkpoint: str) -> DataFrame:
    """Run an extraction job on pages that are new; rows go to the table as the pages arrive."""
    return run_to_table(job(pages), table, checkpoint).drop("batch_id")


def dedupe_stream(pages: DataFrame, key: Column, moment: str | None = None, delay: str | None = None) -> DataFrame:
    """Streamed pages, each key once; with a ``delay``, once among pages less than that apart by ``moment``.

    Without a delay the key is kept for good, so run it with ``large_state``, as ``unique_pages`` does.
    """
    keyed = pages.withColumn("url_key", key)
    return keyed.dropDuplicates(["url_key"]) if delay is None else keyed.withWatermark(moment, delay).dropDuplicatesWithinWatermark(["url_key"])


def unique_pages(pages: DataFrame, key: Column, table: str, checkpoint: str, *columns: str) -> DataFrame:
    """Run the dedupe over all that is new: each key once over all runs with this checkpoint, in whatever order pages come.

    The keys seen are the stream's state, one row a key, split by the key's hash; a batch reads and writes the state of
    its own keys only. ``columns`` are those to keep beside ``url_key``; the page of a key that came first is taken.
    """
    with large_state(pages.sparkSession):
        return run_to_table(dedupe_stream(pages, key).select("url_key", *columns), table, checkpoint).drop("batch_id")
