import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pagemart.llm import components, simhash


def plain_fingerprint(text, k=4):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def plain_answer(rows, threshold=4):
    fps = [plain_fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i + 1) if (fps[i] ^ fps[j]).bit_count() <= threshold]
    root = plain_components(pairs)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root[i]] = min(least.get(root[i], d), d)
    return sorted(((d, f"{fps[i]:016x}", least.get(root[i])) for i, (d, _) in enumerate(rows)), key=repr)


def test_spark_has_the_same_hash(one):
    assert one(F.xxhash64(F.lit("a b c d"))) % 2**64 == xxhash.xxh64_intdigest(b"a b c d", seed=42)


def test_every_value_is_within_one_bit_of_its_anchor():
    values = np.random.default_rng(1).integers(0, 1 << 32, 5000).astype(np.uint64)
    near = simhash.nearest_anchor(values)
    assert (np.bitwise_count(values ^ near) <= 1).all()
    assert (simhash.nearest_anchor(near) == near).all()


@pytest.mark.parametrize("threshold", [2, 4, 5])
def test_links_meet_at_an_anchor(threshold):
    rng = random.Random(threshold)
    for _ in range(400):
        f = rng.getrandbits(64)
        g = f
        for b in rng.sample(range(64), rng.randint(1, threshold)):
            g ^= 1 << b
        both = np.array([f, g], np.uint64)
        rows, found = simhash.anchors(both, threshold)
        assert set(found[rows == 0]) & set(found[rows == 1])
        assert len(found) <= 2 * 34


def texts():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(80)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 5, 40, 200])))) for i in range(60)]
    for i in range(60, 120):
        base = rows[rng.randrange(60)][1].split(" ")
        if rng.random() < 0.7:
            base[rng.randrange(len(base))] = rng.choice(words)
        rows.append((i, "\n".join(base).upper() if rng.random() < 0.3 else " ".join(base)))
    return [*rows, (200, None), (201, ""), (202, " \t\n"), (7, rows[7][1]), (7, rows[7][1]), (None, rows[9][1]), (None, "alone with no id at all")]


@pytest.mark.parametrize("cell", [2, 6, 4096])
def test_components(spark, cell):
    rows = texts()
    docs = spark.createDataFrame([(d, t, "z", 1) for d, t in rows], "doc_id long, text string, fp string, anchor int")
    got = simhash.near_duplicates(docs, cell=cell).collect()
    assert sorted(((r.doc_id, f"{r.fp % 2**64:016x}", r.component_id) for r in got), key=repr) == plain_answer(rows)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = simhash.op2_simhash_anchors(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got), key=repr) == plain_answer([(r.doc_id, r.text) for r in docs])
    assert len({r.component_id for r in got}) < len(got)


def test_one_of_each(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "x y z"), (None, "x y z"), (4, None)]
    docs = spark.createDataFrame([(d, t, 9) for d, t in rows], "doc_id long, text string, least int")
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [1, 3, 4, None]
    assert simhash.one_of_each(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_connected_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(200, k) for k in range(201, 230)]
    got = components.connected_components(spark.createDataFrame(pairs, "a long, b long"))
    wanted = plain_components([p for p in pairs if p[0] != p[1]])
    assert {r.node: r.root for r in got.collect()} == wanted
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
