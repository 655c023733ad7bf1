"""Quality rules by repetition coverage.

Each text is read whole inside a task. Its words become numbers, a polynomial prefix hash over them gives
the rolling hash of every window of several lengths, and sorting the hashes of one length finds the
windows that occur again. The verdict is the share of a text's word characters that lie inside repeated
windows, and inside repeated lines.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pagemart.llm.base import once, query, slices, table, text_filter, text_kept

WORD = re.compile(rb"[^\x20\x09-\x0d]+")
SPACE = b" \t\n\x0b\x0c\r"
STEP, STEP_INVERSE = 0x9E3779B97F4A7C17, pow(0x9E3779B97F4A7C17, -1, 1 << 64)


@dataclass(frozen=True)
class Rules:
    """``coverage``: window length in words and the largest share of characters inside repeated windows."""

    min_words: int = 50
    max_repeat_pct: int = 50
    coverage: tuple[tuple[int, float], ...] = ((5, 0.40), (7, 0.35), (10, 0.30))
    max_line_share: float = 0.30
    max_symbol_share: float = 0.10


FIELDS = pa.schema(
    [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
     ("n_repeat_words", pa.int64()), ("dup_line_chars", pa.int64()), ("covered_chars", pa.list_(pa.int64())),
     ("base_failed", pa.bool_()), ("kept", pa.bool_())]
)
FIELDS_DDL = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, dup_line_chars long, "
    "covered_chars array<long>, base_failed boolean, kept boolean"
)


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 … base ** (n - 1) modulo 2 ** 64, kept by the worker and grown by doubling."""
    kept = once(("powers", base), lambda: [np.ones(1, np.uint64)])
    if len(kept[0]) < n:
        steps = np.full(max(n, 2 * len(kept[0])), base, np.uint64)
        steps[0] = 1
        kept[0] = np.cumprod(steps)
    return kept[0][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Whole numbers to well spread 64-bit values."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeated(keys: np.ndarray) -> np.ndarray | None:
    """For each key, whether it occurs twice or more; None if no key does."""
    inner = np.sort(keys)
    again = inner[1:][inner[1:] == inner[:-1]]
    if not len(again):
        return None
    at = np.searchsorted(again, keys)
    at[at == len(again)] = 0
    return again[at] == keys


def covered(windows: np.ndarray, n: int, words: int) -> np.ndarray:
    """Words inside any marked window of n words."""
    edges = np.zeros(words + 1, np.int32)
    at = np.flatnonzero(windows)
    edges[at] += 1
    edges[at + n] -= 1
    return np.cumsum(edges[:-1]) > 0


def measure(text: str | None, rules: Rules) -> tuple:
    """The values of FIELDS for one text; a null text has no words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = WORD.findall(raw)
    n = len(words)
    if not n:
        return (0, 0, 0, 0, 0, 0, [0] * len(rules.coverage), rules.min_words > 0, rules.min_words <= 0)
    whole = b"".join(words)
    lead = (np.frombuffer(whole, np.uint8) & 0xC0) != 0x80
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n))
    word_chars = int(np.count_nonzero(lead))
    symbols = sum(whole.count(c) for c in b"#*$%&|<>")

    seen, n_dup_lines, line_chars = set(), 0, 0
    for line in raw.split(b"\n"):
        if line in seen:
            n_dup_lines += 1
            line_chars += sum(len(w.decode("utf-8", "surrogatepass")) for w in WORD.findall(line))
        elif line.strip(SPACE):
            seen.add(line)

    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, n)
    n_repeat = 0
    if n >= 3:
        pairs = ids[:-1] * len(numbers) + ids[1:]
        if len(numbers) >= 1 << 21:  # else three numbers fit into 63 bits
            pairs = np.unique(pairs, return_inverse=True)[1]
        if (again := repeated(pairs[:-1] * len(numbers) + ids[2:])) is not None:
            n_repeat = int(covered(again, 3, n).sum())

    def inside(windows: np.ndarray, length: int) -> int:
        chars = np.diff(np.cumsum(lead)[ends - 1], prepend=0)
        return int(chars[covered(windows, length, n)].sum())

    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(ids) * powers(STEP, n), out=prefix[1:])
    shares = []
    for length, _ in rules.coverage:
        if n < length + 1:
            shares.append(0)
            continue
        rolling = (prefix[length:] - prefix[:-length]) * powers(STEP_INVERSE, n - length + 1)
        again = repeated(rolling)
        shares.append(0 if again is None else inside(again, length))

    failed = n < rules.min_words or 100 * n_repeat > rules.max_repeat_pct * n
    kept = (
        not failed
        and symbols <= rules.max_symbol_share * word_chars
        and line_chars <= rules.max_line_share * word_chars
        and all(c <= most * word_chars for c, (_, most) in zip(shares, rules.coverage, strict=True))
    )
    return (n, word_chars, symbols, n_dup_lines, n_repeat, line_chars, shares, failed, kept)


def quality_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """One row per input row: the id and the measures of FIELDS.

    A null or empty text has no words and fails the base rule. A null id stays null. Repeated rows are each
    measured. Other columns are not read. An empty table gives no rows.
    """
    if id_col in FIELDS.names:
        raise ValueError(f"rename the id column {id_col}")
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            rows = [measure(t, rules) for t in batch.column(1).to_pylist()]
            columns = zip(*rows, strict=True) if rows else [[]] * len(FIELDS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, f.type) for c, f in zip(columns, FIELDS, strict=True))],
                names=[id_col, *FIELDS.names],
            )

    return text_kept(docs.select(id_col, text_col), text_col).mapInArrow(run, f"`{id_col}` {kind}, {FIELDS_DDL}")


def keep_good(docs: DataFrame, text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows the rules keep, with all their columns as they were.

    A null or empty text has no words and goes, unless the rules ask for none. Repeated rows and rows with a null
    id are kept or not by their text alone. An empty table gives no rows.
    """
    return docs.where(text_filter(lambda text: measure(text, rules)[-1], text_col))


def _coverage_sql(rules: Rules) -> tuple[str, str]:
    steps, shares = [], []
    for n, _ in ((3, 0), *rules.coverage):
        gram = " || ' ' || ".join(f"lead(w, {k}) OVER d" for k in range(1, n))
        steps.append(f"""
g{n} AS (SELECT doc_id, i, w, w || ' ' || {gram} AS g FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
r{n} AS (SELECT doc_id, i, w, g IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g) > 1 AS r FROM g{n}),
c{n} AS (SELECT doc_id, w, max(r::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS c FROM r{n}),
s{n} AS (SELECT doc_id, count(*) FILTER (c = 1) AS words{n}, coalesce(sum(length(w)) FILTER (c = 1), 0) AS chars{n} FROM c{n} GROUP BY doc_id)""")
        shares.append(f"LEFT JOIN s{n} USING (doc_id)")
    return ",".join(steps), " ".join(shares)


def oracle(rules: Rules = Rules()) -> str:
    steps, joins = _coverage_sql(rules)
    word, bounds = "'[^\\x20\\x09-\\x0D]+'", " AND ".join(f"coalesce(chars{n}, 0) <= {most!r}::DOUBLE * word_chars" for n, most in rules.coverage)
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, unnest(regexp_extract_all(text, {word})) AS w,
                 generate_subscripts(regexp_extract_all(text, {word}), 1) AS i FROM texts),
totals AS (SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars,
                  sum(length(w) - length(regexp_replace(w, '[#*$%&|<>]', '', 'g'))) AS n_symbols FROM words GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts),
copies AS (SELECT doc_id, line, count(*) - 1 AS n, len(regexp_extract_all(line, {word})) AS has,
                  length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g')) AS chars
           FROM lines GROUP BY doc_id, line),
dups AS (SELECT doc_id, sum(n) AS n_dup_lines, sum(n * chars) AS line_chars FROM copies WHERE has > 0 GROUP BY doc_id),{steps},
base AS (SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
                coalesce(n_symbols, 0)::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
                coalesce(words3, 0)::BIGINT AS n_repeat_words, coalesce(line_chars, 0) AS line_chars,
                coalesce(n_words, 0) < {rules.min_words} OR 100 * coalesce(words3, 0) > {rules.max_repeat_pct} * coalesce(n_words, 0) AS base_failed,
                {", ".join(f"chars{n}" for n, _ in rules.coverage)}
         FROM texts LEFT JOIN totals USING (doc_id) LEFT JOIN dups USING (doc_id) {joins})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_symbols <= {rules.max_symbol_share!r}::DOUBLE * word_chars
       AND line_chars <= {rules.max_line_share!r}::DOUBLE * word_chars AND {bounds} AS kept
FROM base"""


@query("op8_quality_rules", oracle())
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_measures(table(spark, sf_dir, "documents")).drop("dup_line_chars", "covered_chars")
