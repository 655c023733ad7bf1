import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pagemart.llm import spelling


def plain_words(rows, noise=97):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(rows, noise=97):
    words = plain_words(rows, noise)
    forms, out = {}, []
    close = {w: [v for v in words if near(w, v)] for w in words}
    for w, n in words.items():
        best = min(close[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * n else None
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(close[w]), words[forms[w]] if forms[w] else None))
    return sorted(out)


def rows(seed=2):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcdeéßÿ×", k=rng.randint(4, 9))) for _ in range(25)]
    pool = []
    for w in base:
        pool += [w] * rng.randint(1, 40)
        for _ in range(12):
            at = rng.randrange(len(w))
            pool += [rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("abcdeéà") + w[at:], w[:at] + rng.choice("abcdeé") + w[at + 1 :]])] * rng.randint(1, 8)
    pool += ["".join(rng.sample("stream", 6)) for _ in range(200)]
    docs = [(d, " ".join(rng.choice([w, w, w.upper(), w + "1"]) for w in rng.choices(pool, k=80))) for d in range(60)]
    return [*docs, docs[3], docs[3], (None, docs[4][1]), (None, None), (70, None), (71, ""), (72, "日本 ΑΒΓ 12_34"), (-9, "don't stop-gap caféine" * 3)]


@pytest.mark.parametrize(("noise", "limits"), [(97, {}), (7, {"cell": 30, "block": 10, "sample": 200, "part": 50, "held": 20}), (5, {"cell": 60, "sample": 100_000})])
def test_against_plain(spark, noise, limits):
    some = rows()
    docs = spark.createDataFrame([(d, t, "w", 1, None) for d, t in some], "doc_id long, text string, word string, n int, size double")
    got = spelling.spelling_variants(docs, noise=noise, **limits)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    wanted = plain(some, noise)
    assert sorted(map(tuple, got.collect())) == wanted
    assert len(wanted) > 100 and any(r[1] and r[2] != r[1] for r in wanted)


def test_long_chain_of_forms(spark):
    words = ["a" * (5 + k) for k in range(11)]
    text = " ".join(" ".join([w] * (3 * 2**k)) for k, w in enumerate(words))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = spelling.spelling_variants(docs, noise=10**12).collect()
    assert {r.root for r in got} == {words[-1]} and sorted(map(tuple, got)) == plain([(1, text)], 10**12)


def test_many_words_of_the_same_letters(spark):
    """Cells that no cut can part are searched in blocks."""
    rng = random.Random(5)
    words = {"".join(rng.sample("abcdefg", 7)) for _ in range(400)} | {"".join(rng.sample("abcdefh", 7)) for _ in range(400)}
    text = " ".join(sorted(words)) + " "
    docs = spark.createDataFrame([(i, text) for i in range(3)], "doc_id long, text string")
    got = spelling.spelling_variants(docs, noise=10**12, cell=20, block=30)
    assert sorted(map(tuple, got.collect())) == plain([(i, text) for i in range(3)], 10**12)


def test_very_long_text_and_word(spark):
    text = "Wörter wörtar wortar " * 100_000 + "x" * 300_000 + " " + "x" * 300_000 + " " + "x" * 299_999 + "y " + "x" * 300_000
    docs = spark.createDataFrame([(i, text) for i in range(3)], "doc_id long, text string")
    got = {r.word[:8]: (r.n, r.n_near) for r in spelling.spelling_variants(docs, noise=10**12).where("word not like '%y'").collect()}
    assert got == {"wörter": (300_000, 1), "wörtar": (300_000, 2), "wortar": (300_000, 1), "x" * 8: (9, 1)}


def test_empty_table(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_search_reaches_all_within_one_step():
    rng = np.random.default_rng(1)
    some = rng.integers(0, 4, (500, spelling.SIZE)).astype(np.uint8)
    cuts = spelling.Cuts(some, 8)
    asked = some.copy()
    asked[:, 3] += 1
    found = {(int(r), int(m)) for leaf, rows_ in cuts.reached(asked, 0, 1) for r in rows_ for m in cuts.members[leaf]}
    assert all((i, i) in found for i in range(500)) and len(found) < 500 * 250
    assert sorted(np.concatenate(cuts.members).tolist()) == list(range(500))
