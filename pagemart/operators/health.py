"""Ban rules, retries and the state of endpoints after a fetch log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemart import constants as K
from pagemart.functions import moments as M
from pagemart.functions import text as X
from pagemart.functions import urls as U
from pagemart.operators import joins, scans
from pagemart.session import materialise

Policy = Callable[..., Column]

def is_ban(status: Column, body_len: Column, exception: Column) -> Column:
    """The default rule: any exception but the ignored one, a status outside the good ones, or an
    empty page with status 200."""
    by_page = ~status.isin(K.NOT_BAN_STATUSES) | ((status == 200) & (F.coalesce(body_len, F.lit(0)) == 0))
    return F.when(exception.isNotNull(), exception != K.IGNORED_EXCEPTION).otherwise(by_page)


def outcomes(log: DataFrame, policy: Policy = is_ban, *more: str) -> DataFrame:
    """The log with ``ban``; rows the policy leaves unknown (NULL) change nothing and are dropped.

    The policy gets status, body length and exception, and the columns named in ``more``, such as the body.
    """
    ban = policy(F.col("status"), F.col("body_len"), F.col("exception"), *map(F.col, more))
    return log.withColumn("ban", ban).where(F.col("ban").isNotNull())


def bans_by_status(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("ban") & F.col("status").isNotNull()).groupBy("status").agg(F.count("*").alias("bans"))


def bans_empty(judged: DataFrame) -> DataFrame:
    empty = F.col("ban") & F.col("status").isNotNull() & (F.coalesce("body_len", F.lit(0)) == 0)
    return judged.agg(F.count_if(empty).alias("bans_empty"))


def bans_by_exception(judged: DataFrame) -> DataFrame:
    return (
        judged.where(F.col("ban") & F.col("exception").isNotNull()).groupBy("exception").agg(F.count("*").alias("bans"))
    )


def attempts(judged: DataFrame, limit: Column | int = K.MAX_RETRIES) -> DataFrame:
    """Bans with their number per request and whether the request is tried again.

    A request of a ``url`` ends with a success, and when it is given up after more bans than its limit; the
    next ban of that url is number 1 again. A limit given as a column must not change within a request.
    """
    limit = F.lit(limit) if isinstance(limit, int) else limit
    counted = scans.streak(judged.withColumn("_limit", limit), ["url"], "ts", "request_id", F.col("ban"), "attempt_no")
    numbered = counted.where("ban").withColumn("attempt_no", _of_request(F.col("attempt_no"), F.col("_limit")))
    return numbered.withColumn("retry", F.col("attempt_no") <= F.col("_limit")).drop("_limit")


def _of_request(bans: Column, limit: Column) -> Column:
    """Number of a ban within its request, from its number since the last success."""
    return F.pmod(bans - 1, limit + 1) + 1


def since_success(judged: DataFrame, key: str, newest: Column | None = None) -> DataFrame:
    """(key, _seen, failed): last time and bans after the last success, by aggregates alone; with ``newest`` its last value, too.

    The first aggregate, a row per key, is written now: it is the lookup and the source of the hot keys, too.
    """
    at = M.moment(F.col("ts"), F.col("request_id"))
    first = judged.groupBy(key).agg(
        F.max(F.when(~F.col("ban"), at)).alias("_ok"), F.max("ts").alias("_seen"), F.count_if("ban").alias("count"),
        *([] if newest is None else [F.max_by(newest, at).alias("_newest")]),
    )
    first = materialise(first, "last-success")
    bans = judged.where("ban").select(key, "request_id", at.alias("_at"))
    failed = (
        joins.salted_lookup(bans, first.select(key, "_ok"), key, F.col("request_id"), "inner", counts=first.select(key, "count"))
        .where(F.col("_ok").isNull() | (F.col("_at") > F.col("_ok")))
        .groupBy(key).agg(F.count("*").alias("failed"))
    )
    return first.drop("_ok", "count").join(failed, key, "left").withColumn("failed", F.coalesce("failed", F.lit(0)))


def retry_queue(judged: DataFrame, limit: Column | int = K.MAX_RETRIES) -> DataFrame:
    """Per url whose last outcome is a ban: the bans of that request so far, and whether it is tried again or given up.

    A limit given as a column is that of the request, which its last outcome carries; NULL stands for the usual limit.
    """
    given = F.coalesce(limit, F.lit(K.MAX_RETRIES)) if isinstance(limit, Column) else F.lit(limit)
    still_open = since_success(judged, "url", given).where("failed > 0")
    number = _of_request(F.col("failed"), F.col("_newest"))
    return still_open.select("url", number.alias("attempt_no"), (number <= F.col("_newest")).alias("retry"))


def failures_in_a_row(judged: DataFrame, key: str = "proxy") -> DataFrame:
    """Each outcome with the endpoint's failures since its last success."""
    return scans.streak(judged, [key], "ts", "request_id", F.col("ban"), "failures")


def endpoint_state(
    judged: DataFrame, as_of: Column, endpoints: DataFrame | None = None, key: str = "proxy",
    base: float = K.BACKOFF_BASE, cap: float = K.BACKOFF_CAP, wait: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """One row per endpoint: state, failed attempts, back-off seconds and next check at ``as_of``.

    Only aggregates are needed, not an ordered window (``since_success``). ``wait(endpoint, earlier failures)``
    replaces the plain back-off, for instance by a jittered one.
    """
    last = since_success(judged, key)
    known = last if endpoints is None else endpoints.select(key).distinct().join(last, key, "left")
    state = known.withColumn("failed_attempts", F.coalesce("failed", F.lit(0)))
    before = F.col("failed_attempts") - 1
    seconds = wait(F.col(key), before) if wait else X.exp_backoff(before, base, cap)
    is_down = F.col("failed_attempts") > 0
    state = state.withColumn("backoff", F.when(is_down, seconds)).withColumn(
        "next_check", F.when(is_down, F.timestamp_micros(F.unix_micros("_seen") + F.round(F.col("backoff") * 1e6).cast("long")))
    )
    return state.select(
        key,
        F.when(F.col("_seen").isNull(), "unchecked")
        .when(~is_down, "good")
        .when(F.col("next_check") <= as_of, "unchecked")
        .otherwise("dead")
        .alias("state"),
        "failed_attempts",
        "backoff",
        "next_check",
    )


def due_for_recheck(states: DataFrame, as_of: Column) -> DataFrame:
    """Failed endpoints whose waiting time is over."""
    return states.where((F.col("failed_attempts") > 0) & (F.col("next_check") <= as_of))


def available(states: DataFrame) -> DataFrame:
    return states.where(F.col("state").isin("good", "unchecked"))


def state_counts(states: DataFrame) -> DataFrame:
    unchecked, tried = F.col("state") == "unchecked", F.col("failed_attempts") > 0
    return states.agg(
        F.count_if(F.col("state") == "good").alias("good"),
        F.count_if(F.col("state") == "dead").alias("dead"),
        F.count_if(unchecked & ~tried).alias("unchecked"),
        F.count_if(unchecked & tried).alias("reanimated"),
    )


def mean_backoff(states: DataFrame) -> DataFrame:
    waiting = F.avg(F.when(F.col("state") == "dead", F.col("backoff")))
    return states.agg(F.coalesce(waiting, F.lit(0.0)).alias("mean_backoff"))


def reset_when_none_left(states: DataFrame) -> DataFrame:
    """All dead endpoints become unchecked if no other is left."""
    left = available(states).agg(F.count("*").alias("n")).scalar()
    dead_again = (left == 0) & (F.col("state") == "dead")
    return states.withColumn("state", F.when(dead_again, "unchecked").otherwise(F.col("state")))


def stop_reason(states: DataFrame, stop: bool = False) -> DataFrame:
    """One row with the ``reason`` a run must end for, NULL if endpoints are left.

    With ``stop`` a run ends when no endpoint is good or unchecked. Else dead ones are reset (``reset_when_none_left``), so it
    ends only if there is none to reset.
    """
    left = F.count_if(F.col("state").isin("good", "unchecked") | (F.lit(not stop) & (F.col("state") == "dead")))
    return states.agg(F.when(left == 0, K.NONE_LEFT if stop else K.NONE_AFTER_RESET).alias("reason"))


def state_report(
    judged: DataFrame, every: int, endpoints: DataFrame | None = None, key: str = "proxy",
    base: float = K.BACKOFF_BASE, cap: float = K.BACKOFF_CAP, until: Column | None = None,
) -> DataFrame:
    """The counts of states as they run: (at, good, dead, reanimated, unchecked, mean_backoff) every ``every`` seconds.

    An endpoint is good or dead from an outcome to the next one; a dead one is reanimated from its next check on. ``unchecked``
    are the listed endpoints not tried so far, NULL without a list. Only moments at which a state changed have a row; between
    them the counts stay. ``until`` ends the report; else it goes on to the last check that is due.

    Each outcome adds to the counts where its state begins and takes away where it ends. These changes are added up by
    moment before anything is shuffled, and the sum runs over moments, not over rows.
    """
    second = 1_000_000
    counted = scans.streak(judged.select(key, "ts", "request_id", "ban"), [key], "ts", "request_id", F.col("ban"), "_failed")
    timed = counted.select(key, "_failed", F.unix_micros("ts").alias("_us"), (-F.unix_micros("ts")).alias("_back"), (-F.col("request_id")).alias("_tie"))
    # Backwards in time the row before is the next outcome.
    rows = scans.previous(timed, [key], "_back", "_tie", F.col("_us"), "_next")
    wait = F.round(X.exp_backoff(F.col("_failed") - 1, base, cap) * second).cast("long")
    rows = rows.withColumn("_wait", F.when(F.col("_failed") > 0, wait)).withColumn("_due", F.col("_us") + F.col("_wait"))
    dead = F.col("_failed") > 0
    woken = dead & (F.col("_next").isNull() | (F.col("_due") < F.col("_next")))

    def change(when: Column, at: Column, good: int = 0, dead: int = 0, reanimated: int = 0) -> Column:
        wait = F.col("_wait") * dead if dead else F.lit(0).cast("long")
        return F.when(
            when, F.struct(at.alias("us"), F.lit(good).alias("good"), F.lit(dead).alias("dead"), F.lit(reanimated).alias("reanimated"), wait.alias("wait"))
        )

    ended = F.col("_next").isNotNull()
    changes = F.filter(
        F.array(
            change(~dead, F.col("_us"), good=1), change(~dead & ended, F.col("_next"), good=-1),
            change(dead, F.col("_us"), dead=1), change(dead & ~woken, F.col("_next"), dead=-1),
            change(woken, F.col("_due"), dead=-1, reanimated=1), change(woken & ended, F.col("_next"), reanimated=-1),
        ),
        lambda c: c.isNotNull(),
    )
    step = every * second
    tick = F.expr(f"((us + {step - 1}) div {step}) * {step}")
    summed = rows.select(F.explode(changes).alias("c")).select("c.*").groupBy(tick.alias("_at")).agg(
        *[F.sum(name).alias(name) for name in ("good", "dead", "reanimated", "wait")]
    )
    names = ("good", "dead", "reanimated", "wait")
    run = scans.running(summed, [], "_at", "_at", **{f"_{name}": ("sum", F.col(name)) for name in names})
    total = F.lit(None).cast("long") if endpoints is None else F.lit(endpoints.select(key).distinct().count())
    report = run.where(" or ".join(f"{name} <> 0" for name in names)).select(
        F.timestamp_micros("_at").alias("at"), F.col("_good").alias("good"), F.col("_dead").alias("dead"), F.col("_reanimated").alias("reanimated"),
        (total - F.col("_good") - F.col("_dead") - F.col("_reanimated")).alias("unchecked"),
        F.when(F.col("_dead") > 0, F.col("_wait") / F.col("_dead") / second).otherwise(0.0).alias("mean_backoff"),
    )
    return report if until is None else report.where(F.col("at") <= until)


def by_host_port(addresses: DataFrame, endpoints: DataFrame, address: str, spread: Column) -> DataFrame:
    """Addresses with the known endpoint of the same host:port; of several the last listed wins.

    ``spread`` tells rows apart, so that those of a busy host can be dealt over tasks.
    """
    known = (
        endpoints.groupBy(U.host_port(F.col("endpoint")).alias("host_port"))
        .agg(F.max_by("endpoint", "position").alias("endpoint"))
    )
    keyed = addresses.withColumn("host_port", U.host_port(F.col(address)))
    return joins.salted_lookup(keyed, known, "host_port", spread)
