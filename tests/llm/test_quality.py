import random
import re
from collections import Counter

import pytest

from pagemart.llm import quality
from tools_check import compare, connect

SPACE = " \t\n\x0b\x0c\r"


def plain(text, rules):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")

    def inside(n):
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        many = Counter(grams)
        return sorted({j for i, g in enumerate(grams) if many[g] > 1 for j in range(i, i + n)})

    chars, seen, dup, dup_chars = sum(map(len, words)), set(), 0, 0
    for line in (text or "").split("\n"):
        if line.strip(SPACE):
            if line in seen:
                dup += 1
                dup_chars += sum(map(len, re.findall(r"[^\x20\x09-\x0D]+", line)))
            seen.add(line)
    covered = [sum(len(words[j]) for j in inside(n)) for n, _ in rules.coverage]
    repeat, symbols = len(inside(3)), sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < rules.min_words or 100 * repeat > rules.max_repeat_pct * len(words)
    kept = (
        not failed and symbols <= rules.max_symbol_share * chars and dup_chars <= rules.max_line_share * chars
        and all(c <= most * chars for c, (_, most) in zip(covered, rules.coverage, strict=True))
    )
    return (len(words), chars, symbols, dup, repeat, dup_chars, covered, failed, kept)


def texts():
    rng = random.Random(0)
    made = [None, "", " \n\t", "a", "a b", "a b c a b c", "é é é é", "x\x0by\x1cz \x85 #*$%&|<>", "same line\nsame line\n\n\nsame line \n" * 3, "w " * 5000]
    for _ in range(200):
        words = ["".join(rng.choice("abé#") for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(1, 40))]
        made.append("".join(rng.choice(words) + rng.choice([" ", " ", "\n", "  ", "\t"]) for _ in range(rng.randint(0, 120))))
    line = " ".join(f"word{i}" for i in range(40))
    return [*made, "\n".join([line] * 4), line + "\n" + " ".join(f"other{i}" for i in range(200)) + "\n" + line]


@pytest.mark.parametrize("rules", [quality.Rules(), quality.Rules(min_words=3, coverage=((2, 0.5), (4, 0.2)))])
def test_measures_are_those_of_plain_counting(rules):
    for text in texts():
        assert quality.measure(text, rules) == plain(text, rules), text


def test_many_different_words(monkeypatch):
    text = " ".join(f"w{i % 9000}" for i in range(20_000))
    expected = quality.measure(text, quality.Rules())
    assert expected[4] == 20_000 and expected == plain(text, quality.Rules())


def test_rows(spark):
    some = [(i, t) for i, t in enumerate(texts())] + [(None, "a b"), (3, "x y")]
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t in some], "doc_id long, text string, n_words int, kept string")
    rules = quality.Rules(min_words=5)
    found = sorted(((r[0], tuple(r[1:])) for r in quality.quality_measures(docs, rules=rules).collect()), key=repr)
    assert found == sorted(((i, plain(t, rules)) for i, t in some), key=repr)
    good = quality.keep_good(docs, rules=rules)
    assert good.schema == docs.schema
    assert sorted((r.doc_id for r in good.collect()), key=repr) == sorted((i for i, t in some if plain(t, rules)[-1]), key=repr)
    assert quality.quality_measures(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        quality.quality_measures(docs, id_col="n_words")


def test_against_sql(spark):
    ok, message = compare(spark, connect("/root/testdata/sf0.01"), quality.op8_quality_rules, quality.oracle(), "/root/testdata/sf0.01")
    assert ok and "TYPES" not in message, message
