"""Pieces of check SQL that several queries share."""

SITE = "https://www.wildberries.ru"


def stamp(key: str) -> str:
    """Record time of a rendered page, as text."""
    return f"strftime(make_timestamp(CAST(1704067200 + {key} AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S.%f')"


def text_of(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d %H:%M:%S.%f')"


PROD = f"""prod AS (
  SELECT p_partkey, p_name, p_brand, p_type, CAST(p_partkey // 240 + 1 AS INTEGER) AS page_no,
    CASE WHEN p_partkey % 17 <> 0 THEN CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) END AS price,
    CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS full_price,
    CASE WHEN p_partkey % 11 <> 0 THEN CAST(p_partkey % 7 AS INTEGER) END AS reviews,
    CASE WHEN p_partkey % 13 <> 0 THEN p_brand END AS brand,
    '{SITE}/catalog/' || lower(p_type) AS category_url,
    CAST(row_number() OVER (PARTITION BY p_type, p_partkey // 240 ORDER BY p_partkey) AS INTEGER) AS position,
    CAST(row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS INTEGER) AS place,
    min(p_partkey) OVER (PARTITION BY p_type, p_partkey // 240) AS page_id
  FROM part)"""

LOG = """log AS (
  SELECT event_id AS request_id, 'https://shop.example/p/' || (user_id * 10 + event_id % 10) AS url,
    'http://u:p@10.0.' || (user_id // 256) || '.' || (user_id % 256) || ':8080' AS proxy, ts,
    CAST(CASE WHEN event_type = 'error' THEN CASE event_id % 4 WHEN 0 THEN 403 WHEN 1 THEN 503 WHEN 2 THEN 200 END
      WHEN event_id % 7 = 0 THEN 301 ELSE 200 END AS INTEGER) AS status,
    CAST(CASE WHEN event_type = 'error' THEN
      CASE event_id % 4 WHEN 0 THEN CASE WHEN event_id % 8 = 0 THEN 0 ELSE 120 END WHEN 1 THEN 64 WHEN 2 THEN 0 END
      WHEN event_id % 7 = 0 THEN 0 ELSE 1000 + event_id % 977 END AS INTEGER) AS body_len,
    CASE WHEN event_type = 'error' AND event_id % 4 = 3 THEN
      CASE event_id % 3 WHEN 0 THEN 'IgnoreRequest' WHEN 1 THEN 'core.TimeoutError' ELSE 'core.ConnectionLost' END
    END AS exception
  FROM events)"""

JUDGED = LOG + """, judged AS (
  SELECT *, CASE WHEN exception IS NOT NULL THEN exception <> 'IgnoreRequest'
    ELSE status NOT IN (200, 301, 302) OR (status = 200 AND coalesce(body_len, 0) = 0) END AS ban
  FROM log)"""

# The newest moment of the log is the "now" of the state queries.
STATES = JUDGED + """, newest AS (SELECT max(ts) AS now FROM log), oks AS (
  SELECT proxy, max(ts) FILTER (WHERE NOT ban) AS ok_at, max(ts) AS last_at FROM judged GROUP BY proxy
), fails AS (
  SELECT j.proxy, count(*) AS n FROM judged j JOIN oks o ON o.proxy = j.proxy
  WHERE j.ban AND (o.ok_at IS NULL OR j.ts > o.ok_at) GROUP BY j.proxy
), waits AS (
  SELECT o.proxy, coalesce(f.n, 0) AS failed_attempts, o.last_at,
    CASE WHEN f.n > 0 THEN least(172800.0, 7200.0 * pow(2.0, least(f.n - 1, 60))) END AS backoff
  FROM oks o LEFT JOIN fails f ON f.proxy = o.proxy
), states AS (
  SELECT proxy, CASE WHEN failed_attempts = 0 THEN 'good' WHEN next_check <= now THEN 'unchecked' ELSE 'dead' END AS state,
    failed_attempts, backoff, next_check
  FROM (SELECT *, last_at + to_seconds(CAST(backoff AS BIGINT)) AS next_check FROM waits), newest
)"""

# White space of every kind, for trimming.
SPACE = r"[\x09-\x0d\x1c-\x20\x{85}\pZ]"


def strip(text: str) -> str:
    return f"regexp_replace({text}, '^{SPACE}+|{SPACE}+$', '', 'g')"


ORIGIN = r"regexp_extract({}, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1)"


def origin(url: str) -> str:
    return ORIGIN.replace("{}", url)
