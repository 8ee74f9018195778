import numpy as np
import pytest

from tagloom.llm.nearest import (
    PROBED, TABLES, axis_scores, block_products, cell_scores, least_scores, nearest, rotated,
)


def by_brute_force(ids, vectors, queries, k):
    out = {}
    for q in queries:
        scores = vectors @ vectors[ids.index(q)]
        order = sorted((-s, i) for s, i in zip(scores, ids) if i != q)
        out[q] = [(i, -s) for s, i in order[:k]]
    return out


def frame(spark, ids, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], "extra") for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, entry string")


def test_rotation_keeps_products():
    unit = np.random.default_rng(0).normal(size=(5, 12))
    turned = rotated(unit, 1)
    assert turned.shape == (5, 16)
    assert np.allclose(turned @ turned.T, unit @ unit.T)
    assert axis_scores(unit, 1).shape == (5, 32)


@pytest.mark.parametrize("equal_length", [True, False])
def test_recall(spark, equal_length):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(900, 24))
    if equal_length:
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = vectors.astype(np.float32).astype(np.float64)
    ids = list(range(900))
    df = frame(spark, ids, vectors)
    found = nearest(df, df.where("vec_id % 20 = 0"), k=20).collect()
    exact = by_brute_force(ids, vectors, range(0, 900, 20), 20)
    hits = 0
    for q, best in exact.items():
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 21))
        assert [(-m[2], m[1]) for m in mine] == sorted((-m[2], m[1]) for m in mine)
        assert all(abs(m[2] - vectors[m[1]] @ vectors[q]) < 1e-9 for m in mine)
        hits += len({m[1] for m in mine} & {i for i, _ in best})
    assert hits >= 0.9 * 20 * len(exact)


def test_copies_ties_and_bad_rows(spark):
    same = [1.0, 2.0, 0.0]
    ids = list(range(60))
    vectors = [same] * 50 + [[0.0, 0.0, 1.0]] * 10
    bad = [(100, None), (101, [0.0, 0.0, 0.0]), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 0.0]),
           (104, [float("inf"), 0.0, 0.0]), (105, [1.0, 2.0]), (None, same), (106, [])]
    df = frame(spark, [*ids, 0, *[b[0] for b in bad]], [*vectors, same, *[b[1] for b in bad]])
    found = nearest(df, df.where("vec_id % 20 = 0"), k=20)
    by = {}
    for r in found.orderBy("query_id", "rank").collect():
        by.setdefault(r["query_id"], []).append(r["vec_id"])
    assert by == {
        0: list(range(1, 21)), 20: list(range(20)), 40: list(range(20))
    }


def test_fewer_than_k_and_none(spark):
    df = frame(spark, [0, 1, 2], [[1.0, 0.0], [-1.0, 0.0], [0.0, 1.0]])
    found = nearest(df, df.where("vec_id = 0"), k=20).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in found] == [(2, 0.0), (1, -1.0)]
    assert nearest(df.limit(0), df.limit(0)).count() == 0


def test_fewer_products_than_brute_force():
    """Vectors without structure, the worst case: each query is multiplied with less than all rows."""
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(4000, 64))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    queries = unit[:200]
    exact = queries @ unit.T
    nearest_20 = np.argsort(-exact, axis=1)[:, 1:21]
    products, found = 0, np.zeros(exact.shape, dtype=bool)
    for table in range(TABLES):
        first, second = (x.argmax(axis=1) for x in cell_scores(unit, table))
        order = np.lexsort((second, first))
        scores = cell_scores(queries, table)
        least = least_scores(*scores, PROBED)
        cells = (scores[0][:, :, None] + scores[1][:, None, :]).reshape(len(queries), -1)
        share = (cells >= least[:, None]).mean(axis=1)
        assert np.all(abs(share - PROBED) < 0.001)
        got = block_products(unit[order], (first[order], second[order]), queries, scores, least)
        opened = got > -np.inf
        assert np.allclose(got[opened], exact[:, order][opened])
        assert np.array_equal(opened, scores[0][:, first[order]] + scores[1][:, second[order]] >= least[:, None])
        products += opened.sum()
        found[:, order] |= opened
    assert products < 0.85 * exact.size
    assert np.take_along_axis(found, nearest_20, axis=1).mean() >= 0.93


def test_crowded_cells_and_many_blocks(spark, monkeypatch):
    """Blocks of few rows: neighbouring cells in blocks of their own, a crowded one in parts."""
    import tagloom.llm.nearest as module

    monkeypatch.setattr(module, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(4)
    crowd = rng.normal(size=8) + rng.normal(size=(200, 8)) * 1e-3
    vectors = np.concatenate([crowd, rng.normal(size=(200, 8))]).astype(np.float32).astype(np.float64)
    ids = list(range(400))
    df = frame(spark, ids, vectors)
    found = nearest(df, df.where("vec_id % 20 = 0"), k=20, probed=1.0).collect()
    exact = by_brute_force(ids, vectors, range(0, 400, 20), 20)
    for q, best in exact.items():
        mine = [(r["vec_id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q]
        assert [m[0] for m in mine] == [b[0] for b in best]


def test_doubles_are_ranked_as_they_are(spark):
    """Scores that single precision could not tell apart."""
    rows = [(0, [1.0, 0.0]), *[(i, [1.0 + i * 1e-12, 0.5]) for i in range(1, 30)]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nearest(df, df.where("vec_id = 0"), k=20, probed=1.0).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in found] == [(i, 1.0 + i * 1e-12) for i in range(29, 9, -1)]
