import random

import numpy as np
import pytest

import corpus_pipeline
from pagemart.llm import nearcopies
from pagemart.llm.simhash import nearest_anchor
from tests.llm.test_simhash import plain_components

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def plain_set(text, k=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + min(k, len(words))]) for i in range(len(words) - min(k, len(words)) + 1)} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def kept_ids(rows):
    sets = [plain_set(t) for _, t in rows]
    root = plain_components([(i, j) for i in range(len(rows)) for j in range(i + 1) if jaccard(sets[i], sets[j]) >= 0.8])
    return {min(rows[j][0] for j in root if root[j] == root[i]) for i in root}


def planted(seed=3):
    """Texts, and copies with a share of their words replaced; the similarity of a copy to its text is 0.7 to 0.97."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(5000)]
    rows = [(i, [rng.choice(words) for _ in range(rng.randint(100, 600))]) for i in range(150)]
    for i in range(150, 400):
        copy = list(rows[rng.randrange(150)][1])
        for at in rng.sample(range(len(copy)), max(1, round(len(copy) * rng.choice([0.005, 0.01, 0.02, 0.03])))):
            copy[at] = rng.choice(words)
        rows.append((i, copy))
    return [(i, " ".join(w)) for i, w in rows]


def test_stage_finds_planted_copies(spark):
    rows = planted()
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DDL)
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == kept_ids(rows)


def test_pairs_at_the_threshold_are_candidates():
    rng = np.random.default_rng(2)
    missed = 0
    for _ in range(1000):
        a = rng.integers(0, 1 << 63, 300).astype(np.uint64)
        b = np.concatenate([a[:267], rng.integers(0, 1 << 63, 33).astype(np.uint64)])  # 267 of 333: 0.80
        missed += not set(nearcopies.band_keys(a)) & set(nearcopies.band_keys(b))
    assert missed <= 2


def test_chain_over_a_middle_text_in_one_bucket(spark, monkeypatch):
    """All nodes are put in one bucket: every pair across components is compared, not only those with one node."""
    monkeypatch.setattr(nearcopies, "STARS", 1)
    rows = planted(4)[:120] + planted(4)[150:220]
    sets = [nearcopies.shingle_set(t) for _, t in rows]
    nodes = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sets)], "node long, hashes binary")
    members = spark.createDataFrame([(1, i) for i in range(len(rows))], "bucket long, node long")
    got = {r.node: r.root for r in nearcopies.components_of(members, nodes, 0.8).collect()}
    plain = [plain_set(t) for _, t in rows]
    wanted = plain_components([(i, j) for i in range(len(rows)) for j in range(i) if jaccard(plain[i], plain[j]) >= 0.8])
    assert got == wanted


@pytest.mark.parametrize("text", [None, "", " \t\n", "one", "ONE two", "a b c d e a b c d e a b c d e"])
def test_shingle_sets(text):
    assert len(nearcopies.shingle_set(text)) == len(plain_set(text))


@pytest.mark.parametrize("bounds", [{}, {"nodes": 20}, {"most": 30_000}])
def test_templated_texts_in_blocks(spark, bounds):
    """Texts of one template at similarity near 0.7, and some over 0.8: links in blocks join what all pairs do."""
    rng = random.Random(8)
    base = [f"t{i}" for i in range(300)]
    rows = []
    for i in range(150):
        words = list(base if i % 5 else rows[rng.randrange(i)][1] if i > 5 else base)
        for at in rng.sample(range(300), 6 if i % 5 else 1):
            words[at] = f"x{i}_{at}"
        rows.append((i, words))
    rows = [(i, " ".join(w)) for i, w in rows]
    plain = [plain_set(t) for _, t in rows]
    wanted = plain_components([(i, j) for i in range(len(rows)) for j in range(i) if jaccard(plain[i], plain[j]) >= 0.8])
    sets = spark.createDataFrame([(i, bytearray(nearcopies.shingle_set(t).tobytes())) for i, t in rows], "node long, hashes binary")
    cells = spark.createDataFrame([(b, i, i) for b in (1, 2) for i, _ in rows], "bucket long, node long, root long")
    links = [(r.a, r.b) for r in nearcopies.block_links(cells, sets, 0.8, **bounds).collect()]
    assert len(links) < 4 * len(rows) and plain_components(links) == wanted and len(set(wanted.values())) > 1


def test_rows_without_id_and_repeated_rows(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(None, words), (None, words), (None, "other words"), (None, None), (5, ""), (4, words + " more"), (4, words + " more"), (9, words)]
    kept = nearcopies.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect()), key=repr) == [(4, words + " more"), (5, ""), (None, "other words")]


def test_buckets_are_anchors_of_fingerprints():
    """Every bucket is a word of the covering code, and that of each half of each fingerprint is among them."""
    hashes = nearcopies.shingle_set(" ".join(f"w{i}" for i in range(700)))
    fps, weak = nearcopies.fingerprints(hashes)
    keys = np.array(nearcopies.band_keys(hashes), np.int64).view(np.uint64)
    low = keys & np.uint64(0xFFFFFFFF)
    assert (nearest_anchor(low) == low).all() and set((keys >> np.uint64(32)).tolist()) == set(range(2 * nearcopies.WORDS))
    for n, fp in enumerate(fps.tolist()):
        for half in (0, 1):
            own = int(nearest_anchor(np.array([fp >> 32 * half & 0xFFFFFFFF], np.uint64))[0])
            assert own | (2 * n + half) << 32 in keys.tolist()


@pytest.mark.parametrize("size", [1, 2, 255, 256, 5000])
def test_fingerprints_are_majorities(size):
    hashes = np.unique(np.random.default_rng(size).integers(0, 1 << 63, size).astype(np.uint64))
    draw = np.random.default_rng(11).integers(0, 1 << 63, (2, nearcopies.WORDS, 1)).tolist()
    fps, weak = nearcopies.fingerprints(hashes)
    for n in (0, nearcopies.WORDS - 1):
        lead = [0] * 64
        for h in hashes.tolist():
            x = (h ^ draw[0][n][0]) * (2 * draw[1][n][0] + 1) % 2**64
            x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 % 2**64
            x ^= x >> 29
            lead = [lead[b] + (1 if x >> b & 1 else -1) for b in range(64)]
        assert int(fps[n]) == sum(1 << b for b in range(64) if lead[b] > 0)
        for half in (0, 1):
            wanted = sorted(range(32), key=lambda b: (abs(lead[32 * half + b]), b))[: nearcopies.WEAK]
            assert weak[2 * n + half].tolist() == wanted


@pytest.mark.parametrize("batch", [1, 3, 7, 1000])
def test_meetings_of_small_and_large_buckets(spark, batch):
    """Pairs of small buckets and members of large ones, however the sorted rows are cut into batches."""
    sizes = {1: 1, 2: 2, 3: nearcopies.SMALL, 4: nearcopies.SMALL + 1, 5: 40, 6: 3, 7: 1, 8: 40}
    rows = [(b, 100 * b + i) for b, n in sizes.items() for i in range(n)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = nearcopies.meetings(spark.createDataFrame(rows, "bucket long, node long")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    small = [b for b, n in sizes.items() if 1 < n <= nearcopies.SMALL]
    pairs = [(None, 100 * b + i, 100 * b + j) for b in small for j in range(sizes[b]) for i in range(j)]
    members = [(b, node, None) for b, node in rows if sizes[b] > nearcopies.SMALL]
    assert sorted(map(tuple, got), key=repr) == sorted(pairs + members, key=repr)


def test_stage_finds_copies_in_a_large_group(spark, monkeypatch):
    """Larger buckets go through stars and blocks, and add to what the pairs of small ones linked."""
    monkeypatch.setattr(nearcopies, "SMALL", 2)
    rows = planted(5)
    kept = nearcopies.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in kept.collect()} == kept_ids(rows)
