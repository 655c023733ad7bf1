"""Endpoint state, retries and ban rules against a plain replay of the log."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pagemart.operators import health

START = dt.datetime(2024, 1, 1)
SCHEMA = "request_id bigint, url string, proxy string, ts timestamp, status int, body_len int, exception string"


def make_log(n, seed):
    """A log in which one endpoint has most of the rows, and some long runs of failures."""
    rng = random.Random(seed)
    rows, at, down = [], START, {}
    for i in range(n):
        at += dt.timedelta(seconds=rng.randrange(0, 200))
        proxy = "hot" if rng.random() < 0.5 else f"p{rng.randrange(6)}"
        if rng.random() < 0.05:
            down[proxy] = rng.randrange(1, 9)
        if down.get(proxy):
            down[proxy] -= 1
            case = rng.choice([(403, 5, None), (503, 0, None), (200, 0, None), (None, None, "core.TimeoutError")])
        else:
            case = rng.choice([(200, 10, None), (301, 0, None), (302, 0, None), (None, None, "IgnoreRequest")])
        rows.append((i, f"u{rng.randrange(60)}", proxy, at, *case))
    return rows


def banned(row):
    status, size, exception = row[4:]
    if exception:
        return exception != "IgnoreRequest"
    return status not in (200, 301, 302) or (status == 200 and not size)


def replay(rows, now):
    """Mark endpoints good or dead one outcome at a time; then look which dead ones are due."""
    state = {}
    for row in rows:
        _, failed, _, _ = state.get(row[2], ("unchecked", 0, None, None))
        if banned(row):
            wait = min(3600, 300 * 2**failed)
            state[row[2]] = ("dead", failed + 1, wait, row[3] + dt.timedelta(seconds=wait))
        else:
            state[row[2]] = ("good", 0, None, None)
    return {
        k: ("unchecked" if s == "dead" and due <= now else s, n, wait, due) for k, (s, n, wait, due) in state.items()
    }


@pytest.mark.parametrize("seed, late", [(1, 0), (2, 400), (3, 100000)])
def test_state_equals_replay(spark, seed, late):
    rows = make_log(400, seed)
    now = rows[-1][3] + dt.timedelta(seconds=late)
    log = health.outcomes(spark.createDataFrame(rows, SCHEMA).repartition(5))
    endpoints = spark.createDataFrame([("hot",), ("new",), *[(f"p{i}",) for i in range(6)]], "proxy string")
    found = health.endpoint_state(log, F.lit(now), endpoints).collect()
    wanted = {**replay(rows, now), "new": ("unchecked", 0, None, None)}
    assert {r.proxy: (r.state, r.failed_attempts, r.backoff, r.next_check) for r in found} == wanted


def test_streak_equals_replay(spark):
    rows = make_log(300, 5)
    failed, wanted = {}, {}
    for row in rows:
        failed[row[2]] = failed.get(row[2], 0) + 1 if banned(row) else 0
        wanted[row[0]] = failed[row[2]]
    found = health.failures_in_a_row(health.outcomes(spark.createDataFrame(rows, SCHEMA)))
    assert {r.request_id: r.failures for r in found.collect()} == wanted


def replay_requests(rows, limit):
    """Follow each request: a ban is one more attempt, a success or giving up ends the request."""
    count, numbers, queue = {}, {}, {}
    for row in rows:
        url = row[1]
        if not banned(row):
            count.pop(url, None)
            queue.pop(url, None)
            continue
        count[url] = count.get(url, 0) + 1
        numbers[row[0]] = queue[url] = (count[url], count[url] <= limit)
        if count[url] > limit:
            count.pop(url)
    return numbers, queue


@pytest.mark.parametrize("limit, urls", [(5, 60), (5, 3), (1, 3), (0, 3)])
def test_attempts_and_queue(spark, limit, urls):
    rows = [(r[0], f"u{r[0] * 7 % urls}", *r[2:]) for r in make_log(500, 7)]
    numbers, queue = replay_requests(rows, limit)
    log = health.outcomes(spark.createDataFrame(rows, SCHEMA))
    assert {r.request_id: (r.attempt_no, r.retry) for r in health.attempts(log, limit).collect()} == numbers
    assert {r.url: (r.attempt_no, r.retry) for r in health.retry_queue(log, limit).collect()} == queue
    own_limit = health.attempts(log.withColumn("limit", F.lit(limit)), F.col("limit"))
    assert {r.request_id: (r.attempt_no, r.retry) for r in own_limit.collect()} == numbers


def test_a_success_and_giving_up_end_a_request(spark):
    def numbers(outcomes):
        rows = [(i, "u", "p", START + dt.timedelta(seconds=i), 403 if bad == "b" else 200, 9, None) for i, bad in enumerate(outcomes)]
        log = health.outcomes(spark.createDataFrame(rows, SCHEMA))
        queue = health.retry_queue(log).collect()
        return [r.attempt_no for r in health.attempts(log).orderBy("request_id").collect()], [(r.attempt_no, r.retry) for r in queue]

    assert numbers("bbbbgbb") == ([1, 2, 3, 4, 1, 2], [(2, True)])
    assert numbers("bbbbbb") == ([1, 2, 3, 4, 5, 6], [(6, False)])
    assert numbers("bbbbbbbb") == ([1, 2, 3, 4, 5, 6, 1, 2], [(2, True)])
    assert numbers("bbg") == ([1, 2], [])


@pytest.mark.parametrize(
    "status, size, exception, ban",
    [
        (200, 1, None, False), (200, 0, None, True), (200, None, None, True), (301, 0, None, False), (302, 0, None, False),
        (404, 9, None, True), (None, None, "IgnoreRequest", False), (None, None, "core.X", True), (None, None, None, None),
    ],
)
def test_ban_rule(one, status, size, exception, ban):
    assert one(health.is_ban(F.lit(status).cast("int"), F.lit(size).cast("int"), F.lit(exception).cast("string"))) is ban


def test_unknown_outcomes_change_nothing(spark):
    rows = [(1, "u", "p", START, 403, 1, None), (2, "u", "p", START + dt.timedelta(seconds=5), None, None, "core.X")]
    log = spark.createDataFrame(rows, SCHEMA)
    blind = health.outcomes(log, lambda s, b, e: F.when(e.isNull(), s == 403))
    found = health.endpoint_state(blind, F.lit(START)).first()
    assert (found.state, found.failed_attempts) == ("dead", 1)


def test_python_policy(spark):
    import pandas as pd

    @F.pandas_udf("boolean")
    def policy(status: pd.Series, size: pd.Series, exception: pd.Series) -> pd.Series:
        return status.isin([403]) & exception.isna()

    log = spark.createDataFrame([(1, "u", "p", START, 403, 1, None), (2, "u", "q", START, 200, 0, None)], SCHEMA)
    assert {r.proxy: r.ban for r in health.outcomes(log, policy).collect()} == {"p": True, "q": False}


def test_jittered_wait(spark):
    from pagemart.functions import text as X

    log = health.outcomes(spark.createDataFrame([(i, "u", "p", START, 403, 1, None) for i in range(3)], SCHEMA))
    found = health.endpoint_state(log, F.lit(START), wait=lambda key, n: X.backoff_jitter(key, n, 5)).first()
    assert 0 <= found.backoff <= 1200 and found.failed_attempts == 3


def test_counts_reset_and_recheck(spark):
    rows = [("a", "dead", 2, 600.0, START), ("b", "dead", 1, 300.0, START + dt.timedelta(hours=1))]
    schema = "proxy string, state string, failed_attempts bigint, backoff double, next_check timestamp"
    dead = spark.createDataFrame(rows, schema)
    assert health.mean_backoff(dead).first().mean_backoff == 450
    assert {r.state for r in health.reset_when_none_left(dead).collect()} == {"unchecked"}
    assert {r.proxy for r in health.due_for_recheck(dead, F.lit(START)).collect()} == {"a"}
    mixed = spark.createDataFrame([*rows, ("c", "good", 0, None, None), ("d", "unchecked", 0, None, None), ("e", "unchecked", 1, 1.0, START)], schema)
    assert tuple(health.state_counts(mixed).first()) == (1, 2, 1, 1)
    assert {r.proxy: r.state for r in health.reset_when_none_left(mixed).collect()}["a"] == "dead"
    assert {r.proxy for r in health.available(mixed).collect()} == {"c", "d", "e"}
    assert health.mean_backoff(mixed.where("state = 'good'")).first().mean_backoff == 0


def test_known_endpoint_of_an_address(spark):
    endpoints = spark.createDataFrame([(1, "http://a:1@h:80"), (2, "http://b:2@h:80"), (3, "g")], "position int, endpoint string")
    addresses = spark.createDataFrame([("http://h:80",), ("g",), ("x",), (None,)], "address string")
    found = {r.address: r.endpoint for r in health.by_host_port(addresses, endpoints, "address", F.col("address")).collect()}
    assert found == {"http://h:80": "http://b:2@h:80", "g": "g", "x": None, None: None}


def test_policy_reads_the_body(spark):
    log = spark.createDataFrame([(1, "u", "p", START, 200, 9, None, "fine"), (2, "u", "q", START, 200, 9, None, "a captcha")], SCHEMA + ", body string")
    judged = health.outcomes(log, lambda s, n, e, body: health.is_ban(s, n, e) | body.contains("captcha"), "body")
    assert {r.proxy: r.ban for r in judged.collect()} == {"p": False, "q": True}


def report_by_replay(rows, every, base, cap, total):
    """The counts at each moment of the grid, from the state of each endpoint just then."""
    judged = sorted(((r[3], r[0], r[2], banned(r)) for r in rows if not (r[6] == "IgnoreRequest" and r[4] is not None)), key=lambda r: r[:2])
    spans, failed = [], {}
    by_proxy = {}
    for at, _, proxy, ban in judged:
        failed[proxy] = failed.get(proxy, 0) + 1 if ban else 0
        by_proxy.setdefault(proxy, []).append((at, failed[proxy]))
    last = max(r[3] for r in rows) + dt.timedelta(seconds=cap + every)
    for line in by_proxy.values():
        for (at, n), (until, _) in zip(line, [*line[1:], (last, 0)], strict=True):
            wait = min(cap, base * 2 ** (n - 1)) if n else 0
            due = at + dt.timedelta(seconds=wait)
            if n == 0:
                spans.append((at, until, "good", 0))
            else:
                spans.append((at, min(due, until), "dead", wait))
                if due < until:
                    spans.append((due, until, "reanimated", 0))
    out, at = {}, START
    while at < last - dt.timedelta(seconds=every):
        now = [(s, w) for a, b, s, w in spans if a <= at < b]
        states, waits = [s for s, _ in now], [w for s, w in now if s == "dead"]
        out[at] = (states.count("good"), states.count("dead"), states.count("reanimated"), total - len(now), sum(waits) / len(waits) if waits else 0.0)
        at += dt.timedelta(seconds=every)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_running_report_equals_replay(spark, seed):
    rows = make_log(300, seed)
    log = health.outcomes(spark.createDataFrame(rows, SCHEMA).repartition(5))
    listed = spark.createDataFrame([("hot",), ("new",), ("new",), *[(f"p{i}",) for i in range(6)]], "proxy string")
    found = {r["at"]: tuple(r)[1:] for r in health.state_report(log, 60, listed).collect()}
    now, wrong = (0, 0, 0, 8, 0.0), []
    for at, wanted in report_by_replay(rows, 60, 300, 3600, 8).items():
        now = found.get(at, now)  # between the rows the counts stay
        if now[:4] != wanted[:4] or abs(now[4] - wanted[4]) > 1e-6:
            wrong.append((at, now, wanted))
    assert found and not wrong, wrong[:3]
    assert health.state_report(log, 60).where("unchecked IS NOT NULL").count() == 0
    assert health.state_report(log.limit(0), 60).count() == 0
    end = rows[100][3]
    assert {r["at"] for r in health.state_report(log, 60, until=F.lit(end)).collect()} == {at for at in found if at <= end}


def test_limits_of_single_requests(spark):
    rows = [(i, u, "p", START + dt.timedelta(seconds=i), 403, 9, None) for i, u in enumerate("aaabbbccc")]
    log = health.outcomes(spark.createDataFrame(rows, SCHEMA))
    limit = F.when(F.col("url") == "a", 1).when(F.col("url") == "b", 3)  # none given for c
    found = {r.url: (r.attempt_no, r.retry) for r in health.retry_queue(log, limit).collect()}
    assert found == {"a": (1, True), "b": (3, True), "c": (3, True)}
    assert {r.url: (r.attempt_no, r.retry) for r in health.retry_queue(log, 2).collect()} == {u: (3, False) for u in "abc"}


def test_reason_to_stop(spark):
    def reason(stop, *states):
        return health.stop_reason(spark.createDataFrame([(s,) for s in states], "state string"), stop).first().reason

    assert reason(True, "dead", "good") is None and reason(True, "unchecked") is None
    assert reason(True, "dead") == reason(True) == "no_proxies"
    assert reason(False, "dead") is None and reason(False) == "no_proxies_after_reset"
