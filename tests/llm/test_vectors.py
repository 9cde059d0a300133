import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lexistat.llm import adscan, mtree

SCHEMA = "vec_id long, embedding array<float>, label int"
ODD = [
    (None, [1.0, 2.0], 0), (50, None, 0), (100, [], 0), (150, [1.0, None], 0), (200, [float("nan"), 1.0], 0),
    (250, [float("inf"), 1.0], 0), (300, [0.0, 0.0], 0), (350, [1.0, 2.0, 3.0], 0),
]


def asked():
    return F.col("vec_id") % 50 == 0


def points(n, dim, seed=1):
    x = np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)
    x[n // 2 : n // 2 + n // 4] = x[0]  # many equal vectors
    return x


def brute(x, score, k=5):
    out = set()
    for q in range(0, len(x), 50):
        own = score[q].copy()
        own[q] = -np.inf
        for rank, j in enumerate(np.lexsort((np.arange(len(x)), -own))[:k], 1):
            out.add((q, rank, int(j), own[j]))
    return out


@pytest.mark.parametrize("rows", [2, 3, 700])
def test_inner_product_equals_brute_force(spark, rows):
    x = points(rows, 8)
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    got = {tuple(r) for r in mtree.search(table, asked(), tree_rows=300).collect()}
    grid = np.floor(x.astype(np.float64) * 256)
    assert got == {r for r in brute(x, grid @ grid.T) if r[3] > -np.inf}


def test_bounds_save_distances():
    centres = np.random.default_rng(2).normal(size=(30, 4)) * 2000
    x = np.floor(np.repeat(centres, 100, axis=0) + np.random.default_rng(3).normal(size=(3000, 4)) * 9)
    tree = mtree.Tree(**mtree.Tree.built(np.arange(3000), x))
    tree.search(0, x[0], 5)
    assert tree.computed < 1500


def test_a_block_of_queries_shares_its_pages():
    """the pages compared grow with the tree, not with the queries, and the bounds still save distances."""
    chance = np.random.default_rng(4)
    x = np.floor(256 * chance.normal(size=(4000, 16)))
    x[1000:1500] = x[7]
    ids = chance.permutation(4000)
    tree = mtree.Tree(**mtree.Tree.built(ids, x))
    who, scores, names = tree.search_all(ids[::5], x[::5], 5)
    assert tree.visited <= 3 * len(tree.starts) < 800
    score = x[::5] @ x.T
    score[np.arange(800), np.arange(0, 4000, 5)] = -np.inf
    best = np.lexsort((np.broadcast_to(ids, score.shape), -score), axis=1)[:, :5]
    assert who.tolist() == np.repeat(np.arange(800), 5).tolist() and names.tolist() == ids[best].ravel().tolist()
    assert scores.tolist() == np.take_along_axis(score, best, 1).ravel().tolist()

    spread = chance.normal(size=(30, 4)) * 2000
    x = np.floor(np.repeat(spread, 100, axis=0) + chance.normal(size=(3000, 4)) * 9)
    tree = mtree.Tree(**mtree.Tree.built(np.arange(3000), x))
    tree.search_all(np.arange(0, 3000, 10), x[::10], 5)
    assert tree.computed < 0.25 * 300 * 3000


@pytest.mark.parametrize(("small", "large"), [(100, 100), (10**5, 10**6), (10**6, 10**9), (10**9, 10**5)])
def test_scores_are_exact_in_any_range(small, large):
    """a tree and a block of queries may differ in range."""
    chance = np.random.default_rng(5)
    x, q = chance.integers(-small, small, (400, 3)), chance.integers(-large, large, (9, 3))
    tree = mtree.Tree(**mtree.Tree.built(np.arange(400), x))
    _, scores, names = tree.search_all(np.full(9, -1), q, 4)
    true = [sorted((-sum(a * b for a, b in zip(y, z, strict=True)), i) for i, y in enumerate(x.tolist()))[:4] for z in q.tolist()]
    assert [(-s, i) for s, i in zip(scores.tolist(), names.tolist(), strict=True)] == [e for some in true for e in some]


def test_trees_are_larger_where_there_are_enough():
    assert [mtree.tree_count(n, 64, 8192, 6) for n in (0, 1, 51_282, 256_410, 1_025_640)] == [1, 1, 7, 24, 32]
    assert mtree.tree_count(1_025_640, 1024, 8192, 6) == mtree.tree_count(1_025_640, 64, 8192, 99) == 126


def test_queries_in_several_parts(spark, monkeypatch):
    """trees meet the blocks of each part once."""
    monkeypatch.setattr(mtree, "QUERY_BLOCK", 2)
    monkeypatch.setattr(mtree, "BLOCKS", 2)
    x = points(700, 8)
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    got = {tuple(r) for r in mtree.search(table, asked(), tree_rows=200).collect()}
    grid = np.floor(x.astype(np.float64) * 256)
    assert got == brute(x, grid @ grid.T)


def test_cosine_recall_and_scores(spark):
    x = points(800, 16)
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    score = unit @ unit.T
    got = adscan.search(table, asked()).collect()
    assert len(got) == 16 * 5
    assert all(math.isclose(r["score"], score[r["query_id"], r["vec_id"]], abs_tol=1e-12) for r in got)
    # Equal vectors are ties: count what is as near as the true ones.
    fifth = {q: np.sort(np.delete(score[q], q))[-5] for q in range(0, 800, 50)}
    assert sum(r["score"] >= fifth[r["query_id"]] - 1e-9 for r in got) >= 0.9 * len(got)


def test_recall_where_lists_are_skipped(spark, monkeypatch):
    """Over 64 lists of which a quarter is probed: at least 0.9 of the true neighbours are found."""
    chance = np.random.default_rng(6)
    n, dim = 17_000, 24
    centres = chance.normal(size=(200, dim))
    x = (centres[chance.integers(0, 200, n)] + 0.4 * chance.normal(size=(n, dim))).astype(np.float32)
    table = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "embedding": x.tolist()}))
    monkeypatch.setattr(adscan, "PROBES", 0.25)
    seen, plain = [], adscan.probed
    monkeypatch.setattr(adscan, "fitted", lambda rows, count, f=adscan.fitted: (lambda r: (seen.append(len(r[1])), r)[1])(f(rows, count)))
    got = {(r["query_id"], r["vec_id"]) for r in adscan.search(table, F.col("vec_id") % 50 == 0).collect()}
    assert seen[0] >= 64 and plain(np.arange(seen[0]), np.ones(seen[0], int) * 99, 16, 5).size == 16
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    score = unit[::50] @ unit.T
    score[np.arange(len(score)), np.arange(0, n, 50)] = -2
    true = {(50 * q, int(i)) for q, row in enumerate(score) for i in np.argsort(-row, kind="stable")[:5]}
    assert len(got) == len(true) and len(got & true) >= 0.9 * len(true)


def test_more_lists_are_probed_until_enough_is_found():
    sizes = np.array([1, 0, 2, 9, 9])
    near = np.array([1, 0, 2, 4, 3])
    assert adscan.probed(near, sizes, 1, 5).tolist() == [1, 0, 2, 4]
    assert adscan.probed(near, sizes, 5, 1).tolist() == [1, 0, 2, 4, 3]
    assert adscan.probed(near, sizes, 1, 99).tolist() == [1, 0, 2, 4, 3]


@pytest.mark.parametrize("search", [mtree.search, adscan.search])
def test_awkward_rows(spark, search):
    odd = spark.createDataFrame([*ODD, (400, [1.0, 1.0], 0), (401, [1.0, 1.0], 0), (403, [1.0, 1.0], 0)], SCHEMA)
    got = [tuple(r)[:3] for r in search(odd, asked()).collect() if r["query_id"] == 400]
    assert got[0] == (400, 1, 401) and got[1] == (400, 2, 403)
    names = {r["vec_id"] for r in search(odd, asked()).collect()}
    assert not names & {None, 50, 100, 150, 200, 250, 350}
    assert search(spark.createDataFrame([], SCHEMA), asked()).collect() == []
    assert search(spark.createDataFrame([(50, [1.0], 0)], SCHEMA), asked()).collect() == []
