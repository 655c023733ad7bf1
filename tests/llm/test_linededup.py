import hashlib
import random

import numpy as np
import pytest

from pagemart.llm import linededup
from pagemart.llm.mph import MinimalPerfectHash
from tools_check import compare, connect


def plain(rows, min_chars=20, min_docs=3):
    def key(line):
        k = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in k) if len(k) >= min_chars else None

    holders = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if d is not None and key(line):
                holders.setdefault(key(line), set()).add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or not key(x) or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def rows():
    rng = random.Random(2)
    pool = [f"{'Line' if k % 2 else 'ligne é'} number {k} " + "x" * (k % 12) for k in range(60)]
    made = [(d, "\n".join(rng.choice(["", " ", "\t"]) + rng.choice(pool) for _ in range(rng.randint(0, 9)))) for d in range(120)]
    common = "This very line stands in all of them"
    made = [(d, t + "\n" + (common.upper() if d % 3 else common)) for d, t in made]
    return [*made, (5, made[5][1]), (5, made[7][1]), (None, common), (None, None), (300, None), (301, ""), (302, "\n\n"), (-4, common), (303, "y" * 9 + "\r\n" + common)]


@pytest.mark.parametrize(("shard_keys", "shard_probes"), [(250_000, 1_000_000), (7, 10)])
def test_rows(spark, shard_keys, shard_probes):
    some = rows()
    docs = spark.createDataFrame([(d, t, 1, "z", None) for d, t in some], "doc_id long, text string, gone int, shard string, n_lines double")
    got = linededup.line_digests(docs, shard_keys=shard_keys, shard_probes=shard_probes).collect()
    wanted = plain(some)
    assert sorted(map(tuple, got), key=repr) == sorted(((d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in wanted), key=repr)
    texts = linededup.dedup_lines(docs, shard_keys=shard_keys, shard_probes=shard_probes)
    assert texts.columns == docs.columns
    assert sorted(((r.doc_id, r.text or "") for r in texts.collect()), key=repr) == sorted(((d, t) for d, _, _, t in wanted), key=repr)


@pytest.mark.parametrize("min_docs", [3, 255, 256, 300, 401])
def test_lines_of_many_documents(spark, min_docs):
    some = [(d, f"a line that four hundred documents share\nown line {d}") for d in range(400)]
    got = linededup.line_digests(spark.createDataFrame(some, "doc_id long, text string"), min_docs=min_docs)
    assert got.groupBy().sum("n_dropped").first()[0] == (399 if min_docs <= 400 else 0)


def test_very_long_text(spark):
    text = "\n".join(f"this is line number {k % 40_000} of a long text" for k in range(60_000))
    some = [(1, text), (2, text), (3, text + "\nthe end"), (4, "short")]
    got = linededup.line_digests(spark.createDataFrame(some, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_dropped) for r in got) == [(d, n, k) for d, n, k, _ in plain(some)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert linededup.line_digests(docs).count() == 0
    assert linededup.dedup_lines(docs).count() == 0


def test_against_sql(spark):
    ok, message = compare(spark, connect("/root/testdata/sf0.01"), linededup.op7_line_dedup, linededup.ORACLE, "/root/testdata/sf0.01")
    assert ok and "TYPES" not in message, message


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_hash_is_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    high, low = rng.integers(0, 3, n).astype(np.uint64), rng.permutation(n).astype(np.uint64)
    made = MinimalPerfectHash.from_bytes(MinimalPerfectHash.build(high, low).to_bytes())
    assert sorted(made.find(high, low).tolist()) == list(range(n))
