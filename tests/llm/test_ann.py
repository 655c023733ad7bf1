import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemart.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, node long, unit string"


def plain(rows, is_query, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i, tuple(v)] = np.array(v, np.float32).astype(np.float64)
    out = {}
    for (i, key), v in good.items():
        if is_query(i):
            marks = [(-(v @ w) / np.sqrt((v @ v) * (w @ w)), j) for (j, _), w in good.items() if j != i and len(w) == len(v)]
            out[i] = [(j, -s) for s, j in sorted((round(s, 12), j) for s, j in marks)[:k]]
    return out


def as_dict(found):
    out = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 12)))
        assert r["rank"] == len(out[r.query_id])
    return out


def same(found, wanted):
    assert set(found) == {q for q, w in wanted.items() if w}
    for q, own in found.items():
        assert [j for j, _ in own] == [j for j, _ in wanted[q]]
        assert np.allclose([s for _, s in own], [s for _, s in wanted[q]], atol=1e-9)


def test_small_table_with_copies_ties_and_odd_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6)]) for i in range(60)]
    rows += [(100 + i, rows[10][1]) for i in range(40)]  # copies
    rows += [(300, [2 * x for x in rows[10][1]]), (301, [0.0] * 6), (302, None), (303, [1.0, None, 0.0, 0.0, 0.0, 1.0]), (304, [float("nan")] * 6)]
    rows += [(305, [float("inf")] + [1.0] * 5), (306, []), (307, [1.0, 2.0]), (None, [1.0] * 6), (5, rows[5][1]), (5, rows[5][1]), (308, [1e-30] * 6), (309, [1e30] * 6)]
    table = spark.createDataFrame([(i, v, 1, 2, "u") for i, v in rows], SCHEMA)
    for few in (0, 1000):
        found = ann.nearest(table, F.col("vec_id") % 5 == 0, few=few).collect()
        same(as_dict(found), plain(rows, lambda i: i % 5 == 0, 5))


def test_each_length_is_searched(spark):
    """Two lengths with a graph of their own, and two that few vectors have."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.standard_normal(3 + (i % 2))]) for i in range(120)]
    rows += [(1000 + i, [float(x) for x in rng.standard_normal(7)]) for i in range(4)] + [(2000, [1.0] * 9)]
    table = spark.createDataFrame([(i, v, 1, 2, "u") for i, v in rows], SCHEMA)
    found = as_dict(ann.nearest(table, F.col("vec_id") % 5 == 0, few=10).collect())
    same(found, plain(rows, lambda i: i % 5 == 0, 5))
    assert len(found) == 25


@pytest.mark.parametrize("n", [0, 1, 2, 4])
def test_fewer_rows_than_asked_for(spark, n):
    rows = [(50 * i, [1.0, float(i)]) for i in range(n)]
    table = spark.createDataFrame([(i, v, 1, 2, "u") for i, v in rows], SCHEMA)
    same(as_dict(ann.nearest(table, F.col("vec_id") % 50 == 0).collect()), plain(rows, lambda i: True, 5))


def test_recall_on_the_given_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    found = as_dict(ann.op3_nn_descent(spark, "/root/testdata/sf0.01").collect())
    wanted = plain(rows, lambda i: i % 50 == 0, 5)
    assert set(found) == set(wanted)
    hits = sum(len({j for j, _ in found[q]} & {j for j, _ in w}) for q, w in wanted.items())
    assert hits >= 0.95 * 5 * len(wanted)
    scores = {(q, j): s for q, w in plain(rows, lambda i: i % 50 == 0, 500).items() for j, s in w}
    assert all(abs(s - scores[q, j]) < 1e-9 for q, own in found.items() for j, s in own)


def test_recall_where_blocks_do_not_hold_all(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=24).astype(np.float32).tolist()) for i in range(3000)]
    table = spark.createDataFrame([(i, v, 1, 2, "u") for i, v in rows], SCHEMA)
    found = as_dict(ann.nearest(table, F.col("vec_id") % 50 == 0).collect())
    matrix = np.array([v for _, v in rows], np.float64)
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 3000, 50):
        sims = matrix @ matrix[q]
        sims[q] = -2
        hits += len({j for j, _ in found[q]} & set(np.argsort(-sims)[:5].tolist()))
    assert hits >= 0.9 * 5 * 60


@pytest.mark.parametrize("noise", [0.01, 0.001])
def test_recall_among_near_copies_of_one_vector(spark, noise):
    rng = np.random.default_rng(2)
    matrix = (rng.normal(size=64) + noise * rng.normal(size=(3000, 64))).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist(), 1, 2, "u") for i, v in enumerate(matrix)], SCHEMA)
    found = as_dict(ann.nearest(table, F.col("vec_id") % 50 == 0).collect())
    matrix = matrix.astype(np.float64)
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 3000, 50):
        sims = matrix @ matrix[q]
        sims[q] = -2
        hits += len({j for j, _ in found[q]} & set(np.argsort(-sims)[:5].tolist()))
    assert hits >= 0.9 * 5 * 60
