import random
import re
from collections import Counter

import pytest

from pagemart.llm import divergence
from tools_check import compare, connect

DDL = "doc_id long, text string, lang string, source string, value string, n string, term int, floor int"


def plain(rows, min_docs, top=50):
    docs = [(a or "", b or "", t or "") for a, b, t in rows]
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    words = [(a, b, re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lower(t))) for a, b, t in docs]
    out = []
    for lang in {a for a, _, _ in docs}:
        seen, counts, whole = Counter(), {b: Counter() for a, b, _ in docs if a == lang}, Counter()
        for a, b, w in words:
            if a == lang:
                seen.update(set(w))
                counts[b].update(w)
                whole.update(w)
        kept = [t for t, n in seen.items() if n >= min_docs]

        def shares(own, kept=kept):
            total = sum(own[t] for t in kept)
            return {t: 1 + 10**9 * (own[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q = shares(whole)
        p = {b: shares(own) for b, own in counts.items()}
        for b in counts:
            found = [(sum(abs(p[b][t] - p[o][t]) for t in kept), o) for o in counts if o != b]
            terms = [(p[b][t] - q[t], t) for t in kept if counts[b][t] and p[b][t] > q[t]]
            for part, items, most in (("pair", found, None), ("term", terms, top)):
                items = sorted(items, key=lambda i: (-i[0], i[1].encode()))[:most]
                out += [(lang, b, part, i, v, k) for k, (v, i) in enumerate(items, 1)]
    return sorted(out)


def rows(seed=4):
    rng = random.Random(seed)
    pool = ["the", "The", "né", "école", "a", "b", "zz", "日本", "x1y", "don't", *(f"w{'abcdefgh'[k % 8] * (k % 5 + 1)}" for k in range(40))]
    made = [(rng.choice(["en", "de", None, "", "xx"]), rng.choice(["s1", "s2", "S2", None, "ü"]), " ".join(rng.choices(pool, k=rng.randint(0, 25)))) for _ in range(150)]
    hot = [("en", rng.choice(["s1", "s2", "lone"]), "one text that many rows hold " * 3) for _ in range(80)]
    return [*made, *hot, ("en", "none", None), ("en", "blank", ""), ("fr", "only", "bonjour"), ("it", "p", "ciao"), ("it", "q", "12 34"), (None, None, None)]


@pytest.mark.parametrize(("min_docs", "limits"), [(3, {}), (1, {"part": 7, "held": 5, "block": 40}), (30, {}), (1000, {})])
def test_against_plain(spark, min_docs, limits):
    some = rows()
    docs = spark.createDataFrame([(1, t, a, b, "v", "n", 1, None) for a, b, t in some], DDL)
    got = divergence.source_divergence(docs, min_docs=min_docs, **limits)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain(some, min_docs)


def test_top_terms_and_ties(spark):
    some = [("en", "a", " ".join(f"t{c}" * 2 for c in "abcdefghij")), ("en", "b", "other words")]
    docs = spark.createDataFrame([(i, t, a, b) for i, (a, b, t) in enumerate(some)], "doc_id long, text string, lang string, source string")
    got = divergence.source_divergence(docs, min_docs=1, top_terms=3).collect()
    assert sorted(map(tuple, got)) == plain(some, 1, 3)


def test_counts_beyond_64_bits(spark):
    """A count of 10 ** 11 times the scale does not fit into 64 bits."""
    n, total = 10**11, 10**12 + 7
    made = spark.createDataFrame([(n, total, 9)], "n long, total long, terms long")
    assert made.select(divergence.share("n", "total", "terms")).first()[0] == 1 + 10**9 * (n + 5) // (total + 45)


def test_very_long_text_is_split_between_terms(spark):
    text = ("Abc défg, " * 150_000) + "x" * 3_000_000
    assert b"".join(divergence.parts(text.encode(), 1000)) == text.encode()
    docs = spark.createDataFrame([(1, text, "en", "a"), (2, "abc", "en", "b")], "doc_id long, text string, lang string, source string")
    got = divergence.source_divergence(docs, min_docs=1).collect()
    assert sorted(map(tuple, got)) == plain([("en", "a", text), ("en", "b", "abc")], 1)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert divergence.source_divergence(docs).count() == 0


def test_against_sql(spark):
    ok, message = compare(spark, connect("/root/testdata/sf0.01"), divergence.op11_source_divergence, divergence.ORACLE, "/root/testdata/sf0.01")
    assert ok and "TYPES" not in message, message
