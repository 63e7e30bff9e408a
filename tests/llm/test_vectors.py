"""op7 and op8 against brute force."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidystar.llm import exact_topk, permutation_index
from tidystar.llm.common import read_table

SF = "/root/testdata/sf0.01"
SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("dim", T.StringType()), T.StructField("shard", T.StringType()),
                       T.StructField("vector", T.StringType())])


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 1, 8).astype(np.float32).tolist()) for i in range(200)]
    rows += [(200 + i, [1.0] * 8) for i in range(60)]                       # copies: ties
    rows += [(300, None), (350, [None] * 8), (400, [float("nan")] * 8), (450, [float("inf")] * 8),
             (None, [1.0] * 8), (500, [0.0] * 8), (550, [1.0, 2.0]), (551, [2.0, 1.0]), (552, []),
             (0, rows[0][1])]                                               # a repeated row
    return rows, spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def usable(rows, zero):
    return [(i, v) for i, v in rows if i is not None and v is not None and all(
        x is not None and math.isfinite(x) for x in v) and (zero or any(v))]


def brute(rows, every, k, score, best_first):
    out = []
    for q, qv in sorted({i: v for i, v in rows if i % every == 0}.items()):
        found = sorted((best_first * score(qv, v), i) for i, v in rows if i != q and len(v) == len(qv))[:k]
        out += [(q, n + 1, i, best_first * s) for n, (s, i) in enumerate(found)]
    return out


def test_exact_top_k_with_ties_and_unusable_rows(vectors):
    rows, df = vectors
    got = exact_topk.top_k_inner_product(df, F.col("vec_id") % 50 == 0, k=5, shard_rows=40, block_rows=2).collect()
    floor = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in usable(rows, True)]
    expected = brute(floor, 50, 5, lambda a, b: sum(x * y for x, y in zip(a, b)), -1)
    assert sorted(tuple(r) for r in got) == expected


def test_exact_top_k_of_large_numbers(spark):
    rows = [(i, [float(2 ** 27 + i), float(-2 ** 26 + 3 * i)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = exact_topk.top_k_inner_product(df, F.col("vec_id") % 50 == 0, k=5, scale=4.0).collect()
    floor = [(i, [math.floor(4 * x) for x in v]) for i, v in rows]
    assert sorted(tuple(r) for r in got) == brute(floor, 50, 5, lambda a, b: sum(x * y for x, y in zip(a, b)), -1)


def test_ball_tree_bounds_hold():
    rng = np.random.default_rng(2)
    x, q = rng.integers(-200, 200, (500, 6)).astype(float), rng.integers(-200, 200, (20, 6)).astype(float)
    tree = exact_topk.BallTree(x, 16)
    norm = np.sqrt((q ** 2).sum(axis=1))
    assert sorted(i for rows in tree.leaves.values() for i in rows) == list(range(500))

    def under(node):
        return tree.leaves[node] if node in tree.leaves else np.concatenate([under(c) for c in tree.children[node]])

    for node in range(len(tree.centers)):
        assert ((q @ x[under(node)].T).max(axis=1) <= tree.bound(node, q, norm)).all()


def test_subtrees_that_no_query_enters_are_not_bounded(monkeypatch):
    """Clustered rows: the branches far from all queries are cut off near the root."""
    rng = np.random.default_rng(5)
    centers = rng.normal(0, 1000, (32, 6))
    x = np.floor(np.repeat(centers, 64, axis=0) + rng.normal(0, 5, (2048, 6)))
    q, ids = x[:8] + 1, np.arange(2048)
    tree, bounded = exact_topk.BallTree(x, 32), set()
    plain = exact_topk.BallTree.bound
    monkeypatch.setattr(exact_topk.BallTree, "bound", lambda self, node, *a: (bounded.add(node), plain(self, node, *a))[1])
    best = exact_topk.search_shard(tree, ids, x, np.full(8, -1), q, 5, np.full(8, -np.inf))
    products = q @ x.T
    expected = [sorted(zip(-row, ids))[:5] for row in products]
    assert [[(-s, i) for s, i in zip(a, b)] for a, b in zip(best.scores, best.ids)] == expected
    assert len(bounded) < len(tree.centers) / 2


def test_scores_beyond_64_bits_are_the_nearest_number(spark):
    rows = [(0, [1e300, 1.0]), (1, [1e300, 2.0]), (2, [-1e300, 5.0]), (3, [0.0, 7.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = exact_topk.top_k_inner_product(df, F.col("vec_id") % 50 == 0, k=5, scale=1.0).collect()
    assert sorted(tuple(r) for r in got) == [(0, 1, 1, 2 ** 63 - 1), (0, 2, 3, 7), (0, 3, 2, -2 ** 63)]


def test_neighbours_of_a_whole_share_are_exact(vectors):
    rows, df = vectors
    got = permutation_index.nearest_neighbours(df, F.col("vec_id") % 50 == 0, k=10, share=1.0).collect()
    expected = brute(usable(rows, False), 50, 10, lambda a, b: math.dist(a, b), 1)
    assert [(r[0], r[1], r[2]) for r in sorted(tuple(r) for r in got)] == [e[:3] for e in expected]
    assert np.allclose([r[3] for r in sorted(tuple(r) for r in got)], [e[3] for e in expected], rtol=0, atol=1e-9)


def test_rows_with_the_id_of_the_query_take_no_place(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 1, 8).astype(np.float32).tolist()) for i in range(120)]
    near = np.array(rows[0][1])
    rows += [(0, (near + 0.001 * i).tolist()) for i in range(1, 40)]          # many near vectors of a query's id
    rows += [(50, rows[50][1])] * 30 + [(119, rows[50][1])] * 2               # one vector many times, shared
    # the same distance twice; the entry that also holds the query's id has the larger other id
    rows += [(100, [9.0] * 8), (100, [9.0] * 7 + [10.0]), (113, [9.0] * 7 + [10.0]), (107, [10.0] + [9.0] * 7)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows if (i, len(v)) != (100, 8) or v[0] == 9.0]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    for k, least in ((10, 256), (2, 30)):
        got = sorted(tuple(r) for r in permutation_index.nearest_neighbours(
            df, F.col("vec_id") % 50 == 0, k=k, least=least, share=0.0 if least > 200 else 0.35).collect())
        asked = {}
        for i, v in rows:
            asked[i] = min(v, asked.get(i, v))
        assert [g[:2] for g in got] == [(q, n + 1) for q in (0, 50, 100) for n in range(k)]
        assert all(g[0] != g[2] for g in got)
        if least > 200:
            expected = [(q, i) for q in (0, 50, 100) for _, i in sorted(
                (math.sqrt(((np.array(v) - asked[q]) ** 2).sum()), i) for i, v in rows if i != q)[:k]]
            assert [(g[0], g[2]) for g in got] == expected


def test_recall_of_the_index(spark):
    df = read_table(spark, "/root/testdata/sf0.1", "embeddings")
    got = permutation_index.nearest_neighbours(df, F.col("vec_id") % 20 == 0, k=10, shard_rows=1000).collect()
    rows = {r["vec_id"]: r["embedding"] for r in df.collect()}
    ids, x = np.array(list(rows)), np.array(list(rows.values()), float)
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    hits = 0
    for q, mine in found.items():
        assert len(mine) == 10
        away = np.sqrt(((x - np.array(rows[q])) ** 2).sum(axis=1))
        away[ids == q] = np.inf
        hits += len(set(ids[np.lexsort((ids, away))[:10]]) & set(mine))
    assert hits >= 0.9 * 10 * len(found)


def test_every_query_gets_its_number_from_small_shards(spark):
    """No size switch: the share holds for small shards too, and never gives fewer than asked for."""
    rng = np.random.default_rng(6)
    for n in (3, 12, 300):
        df = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(n)], "vec_id bigint, embedding array<double>")
        got = permutation_index.nearest_neighbours(df, F.col("vec_id") == 0, k=10, share=0.01).collect()
        assert len(got) == min(10, n - 1) and len({r["vec_id"] for r in got}) == len(got)


def test_footrule_of_an_index():
    rng = np.random.default_rng(3)
    x, pivots = rng.normal(size=(40, 5)), rng.normal(size=(12, 5))
    index = permutation_index.PermutationIndex(x, pivots, 6)
    orders = permutation_index.nearest_pivots(x, pivots, 6)
    query = permutation_index.nearest_pivots(rng.normal(size=(1, 5)), pivots, 6)[0].tolist()
    got = index.footrule(np.array(query))
    for row, away in zip(orders.tolist(), got):
        places = set(row) | set(query)
        expected = sum(abs((row.index(p) if p in row else 6) - (query.index(p) if p in query else 6)) for p in places)
        assert away == expected


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert exact_topk.top_k_inner_product(df, F.col("vec_id") % 50 == 0).count() == 0
    assert permutation_index.nearest_neighbours(df, F.col("vec_id") % 50 == 0).count() == 0
