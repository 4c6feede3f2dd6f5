"""Exact and approximate search against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotemill.llm import exact_search, hash_forest
from quotemill.llm.blocks import usable


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS id", "'y' AS vec", "1 AS score")


def clustered(n, d, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, d))
    x = centres[rng.integers(0, 5, n)] + 0.7 * rng.normal(size=(n, d))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def brute(ids, x, queries, k):
    """x: whole numbers or floats; all candidates but the query's own id."""
    out = set()
    for q in queries:
        s = x @ x[q]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[q]][:k]
        out |= {(int(ids[q]), r + 1, int(ids[j]), s[j].item()) for r, j in enumerate(order)}
    return out


ODD = [
    (None, [1.0, 0.0]), (901, None), (902, []), (903, [float("nan"), 1.0]), (904, [None, 1.0]),
    (905, [float("inf"), 0.0]), (906, [1.0, 2.0, 3.0]),
]


@pytest.mark.parametrize("block", [40, 10_000])
def test_exact_search_is_exact(spark, monkeypatch, block):
    monkeypatch.setattr(exact_search, "BLOCK_ROWS", block)
    monkeypatch.setattr(exact_search, "QUERY_ROWS", 7)
    x = clustered(200, 6, 1)
    x[50:80] = x[10]
    x[81] = 0
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    table = vectors(spark, rows + rows[:3] + ODD)
    whole = exact_search.whole_vectors(table, "vec_id", "embedding")
    got = exact_search.search(whole.filter((F.col("id") % 10 == 0) | (F.col("id") == 81)), whole, 5).collect()
    ints = np.floor(256 * x.astype(np.float64)).astype(np.int64)
    expected = brute(np.arange(200), ints, [*range(0, 200, 10), 81], 5)
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)


def test_exact_search_stops_early():
    rng = np.random.default_rng(0)
    x = (rng.exponential(1, (4000, 3)) ** 3 * 100).astype(np.int64)
    lists = exact_search.SortedLists(np.arange(4000), x)
    looked = []
    plain = lists.scores
    lists.scores = lambda rows, q: looked.append(len(rows)) or plain(rows, q)
    query = np.array([3, 1, 2])
    at, score = lists.top(query, -1, 5)
    s = x @ query
    best = np.lexsort((np.arange(4000), -s))[:5]
    assert at.tolist() == best.tolist() and score.tolist() == s[best].tolist()
    assert sum(looked) < 1000


def test_exact_search_with_few_rows_and_none(spark):
    table = exact_search.whole_vectors(vectors(spark, [(0, [1.0, -1.0]), (1, [0.5, 0.5])] + ODD[:6]), "vec_id", "embedding")
    got = exact_search.search(table.filter("id = 0"), table, 5).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 0)]
    assert exact_search.search(table.limit(0), table, 5).count() == 0
    assert exact_search.search(table, table.limit(0), 5).count() == 0


def test_exact_search_beyond_floating_point():
    x = np.array([[2**40, 1], [2**40, 0], [2**40, 2]])
    at, score = exact_search.SortedLists(np.array([5, 6, 7]), x).top(np.array([2**20, 1]), -1, 3)
    assert at.tolist() == [2, 0, 1] and score.tolist() == [2**60 + 2, 2**60 + 1, 2**60]


def test_forest_recall(spark):
    x = clustered(6000, 24, 2)
    x[100:140] = x[20]
    table = usable(vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)] + ODD + [(907, [0.0] * 24)]), "vec_id", "embedding")
    forest = hash_forest.Forest(block_rows=2500, query_rows=100)
    queries = table.filter("id % 20 = 0 AND id <> 907")
    got = [tuple(r) for r in hash_forest.search(queries, table, 20, forest).collect()]
    x = x.astype(np.float64)
    asked = [q for q in range(0, 6000, 20)]
    expected = brute(np.arange(6000), x, asked, 20)
    pairs = {(q, v) for q, _, v, _ in expected}
    assert len(got) == 20 * len(asked)
    assert len(pairs & {(q, v) for q, _, v, _ in got}) >= 0.9 * len(pairs)
    for q in asked:
        mine = sorted((r for r in got if r[0] == q), key=lambda r: r[1])
        assert [r[1] for r in mine] == list(range(1, 21))
        assert all(a[3] > b[3] or (a[3] == b[3] and a[2] < b[2]) for a, b in zip(mine, mine[1:]))
        assert all(math.isclose(r[3], float(x[r[2]] @ x[q]), rel_tol=1e-12, abs_tol=1e-12) for r in mine)


def test_forest_orders_by_inner_product_of_unequal_lengths(spark):
    x = clustered(500, 8, 4) * np.random.default_rng(1).uniform(0.1, 5, (500, 1)).astype(np.float32)
    table = usable(vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)]), "vec_id", "embedding")
    got = {(r["query_id"], r["vec_id"]) for r in hash_forest.search(table.filter("id % 20 = 0"), table, 20).collect()}
    expected = {(q, v) for q, _, v, _ in brute(np.arange(500), x.astype(np.float64), range(0, 500, 20), 20)}
    assert len(got & expected) >= 0.9 * len(expected)


def test_forest_with_few_rows_and_none(spark):
    table = usable(vectors(spark, [(0, [1.0, 2.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0])] + ODD), "vec_id", "embedding")
    got = hash_forest.search(table.filter("id = 0"), table, 20).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 1.0)]
    assert hash_forest.search(table.limit(0), table, 20).count() == 0
    assert hash_forest.search(table, table.limit(0), 20).count() == 0
