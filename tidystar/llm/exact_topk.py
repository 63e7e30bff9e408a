"""Exact top-k inner-product search with a ball tree per shard.

Every shard of candidates builds a ball tree once; all queries stream past it. A batch of
queries goes down the tree together: at each node the queries whose upper bound
``q.c + |q| r`` is below their current k-th score leave, and a subtree that no query enters is
never bounded. The others visit the child of higher bound first. The k-th score starts from a
bounded set of seed rows (those of largest norm): every query is scored against them
once, and its k-th score goes with it to all shards as their shared lower bound.

Scores are integers: components are ``floor(scale * x)`` in doubles. Sums stay
exact in doubles below 2^53; beyond that the leaf products use Python integers.

Defined results: rows with a NULL id or vector, or a NULL or non-finite
component, take no part; vectors meet only vectors of their length; candidates
that carry the query's id are its own and left out; other repeated rows are each
candidates; equal scores go to the smaller id. A score beyond 64 bits counts as the nearest
64-bit number. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidystar.llm.vector_blocks import meet, one_row_per_query, unpack, usable_vectors

SHARD_ROWS = 8192
BLOCK_ROWS = 2048
LEAF_ROWS = 128
#: Rows of largest norm that give every query its first k-th score.
SEEDS = 2048
_MOST = 2 ** 63 - 1


class BallTree:
    """Nodes with centres and radii; rows are split at the median of a far pair's direction."""

    def __init__(self, x: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.centers, self.radii, self.children, self.leaves = [], [], [], {}
        stack = [(np.arange(len(x)), -1)]
        while stack:
            rows, parent = stack.pop()
            part = x[rows]
            center = part.mean(axis=0)
            away = np.sqrt(((part - center) ** 2).sum(axis=1))
            node = len(self.centers)
            self.centers.append(center)
            self.radii.append(away.max())
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            if len(rows) <= leaf_rows or not away.max():
                self.leaves[node] = np.sort(rows)
                continue
            a = part[away.argmax()]
            b = part[((part - a) ** 2).sum(axis=1).argmax()]
            order = np.argsort(part @ (b - a), kind="stable")
            half = len(rows) // 2
            stack.append((rows[order[:half]], node))
            stack.append((rows[order[half:]], node))
        self.reach = [np.sqrt((c ** 2).sum()) + r for c, r in zip(self.centers, self.radii)]

    def bound(self, node: int, q: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Upper bounds of the inner products of queries with the rows of a node."""
        return q @ self.centers[node] + norm * (self.radii[node] + 1e-9 * self.reach[node]) + 1e-6


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products: doubles while they are exact, else Python integers."""
    most = max(np.abs(q).max(initial=0), np.abs(x).max(initial=0))
    if q.shape[1] * most * most < 2.0 ** 53:
        return q @ x.T
    whole = np.vectorize(int, otypes=[object])
    return whole(q) @ whole(x).T if q.size and x.size else np.zeros((len(q), len(x)))


class Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def offer(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if scores.dtype == object and self.scores.dtype != object:
            self.scores = self.scores.astype(object)
        useful = np.flatnonzero(scores.max(axis=1) >= self.scores[at, -1])
        if not len(useful):
            return
        at = at[useful]
        scores = np.concatenate([self.scores[at], scores[useful]], axis=1)
        ids = np.concatenate([self.ids[at], np.broadcast_to(ids, (len(at), len(ids)))], axis=1)
        by_id = np.argsort(ids, axis=1, kind="stable")
        by_score = np.argsort(-np.take_along_axis(scores, by_id, 1), axis=1, kind="stable")
        order = np.take_along_axis(by_id, by_score, 1)[:, :self.k]
        self.scores[at] = np.take_along_axis(scores, order, 1)
        self.ids[at] = np.take_along_axis(ids, order, 1)


def _without_own(scores: np.ndarray, query_ids: np.ndarray, ids: np.ndarray) -> np.ndarray:
    own = query_ids[:, None] == ids
    if own.any():
        scores = scores.copy()
        scores[own] = -np.inf
    return scores


def search_shard(tree: BallTree, ids, x, query_ids, q, k: int, floor: np.ndarray) -> Best:
    """The k best rows of one shard for each query that can reach ``floor`` (its known k-th score)."""
    best = Best(len(q), k)
    norm = np.sqrt((q ** 2).sum(axis=1))
    everyone = np.arange(len(q))
    stack = [(0, everyone, tree.bound(0, q, norm))]
    while stack:
        node, at, bound = stack.pop()
        enters = bound >= np.maximum(best.scores[at, -1].astype(float), floor[at])
        at, bound = at[enters], bound[enters]
        if not len(at):
            continue
        if node in tree.leaves:
            rows = tree.leaves[node]
            best.offer(at, _without_own(_products(q[at], x[rows]), query_ids[at], ids[rows]), ids[rows])
            continue
        left, right = tree.children[node]
        # a child is never above its parent
        of_left, of_right = (np.minimum(tree.bound(c, q[at], norm[at]), bound) for c in (left, right))
        to_left = of_left >= of_right
        for group, order in ((to_left, ((right, of_right), (left, of_left))), (~to_left, ((left, of_left), (right, of_right)))):
            if group.any():  # the last one pushed is visited first
                stack += [(child, at[group], of_child[group]) for child, of_child in order]
    return best


def _with_floor(queries: DataFrame, seed_of: dict, k: int) -> DataFrame:
    """Queries with their k-th best score among the seeds (-inf if there are fewer)."""
    def run(batches):
        for batch in batches:
            floor = np.full(batch.num_rows, -np.inf)
            dims = np.asarray(batch.column("dim"))
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                if dim not in seed_of:
                    continue
                ids, x = seed_of[dim]
                part = batch.take(pa.array(at))
                q = np.asarray(part.column("vector").flatten(), float).reshape(len(at), dim)
                first = Best(len(at), k)
                first.offer(np.arange(len(at)), _without_own(_products(q, x), np.asarray(part.column("vec_id")), ids), ids)
                floor[at] = first.scores[:, -1].astype(float)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floor)], names=[*batch.schema.names, "floor"])

    return queries.mapInArrow(run, T.StructType([*queries.schema, T.StructField("floor", T.DoubleType())]))


def top_k_inner_product(df: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0,
                        id_col: str = "vec_id", vector_col: str = "embedding",
                        shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of the k best rows for every query.

    ``is_query`` is a condition on the column ``vec_id``.
    """
    whole = F.transform("vector", lambda v: _floor_double(v * F.lit(scale)))
    rows = usable_vectors(df, id_col, vector_col, zero=True).withColumn("vector", whole)
    queries = one_row_per_query(rows, is_query)
    norm = F.aggregate("vector", F.lit(0.0), lambda a, v: a + v * v)
    seeds = rows.select("vec_id", "vector", "dim", norm.alias("norm")) \
        .orderBy(F.desc("norm"), "vec_id").limit(SEEDS).collect()
    seed_of: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in {s["dim"] for s in seeds}:
        mine = [s for s in seeds if s["dim"] == dim]
        seed_of[dim] = (np.array([s["vec_id"] for s in mine]),
                        np.array([s["vector"] for s in mine], float).reshape(len(mine), dim))

    names = ["query_id", "vec_id", "score"]

    def make(candidates: pa.Table):
        ids, x = unpack(candidates)
        tree = BallTree(x)

        def answer(asked: pa.Table) -> pa.Table:
            query_ids, q = unpack(asked)
            order = np.argsort(asked.column("vec_id").to_numpy(), kind="stable")
            best = search_shard(tree, ids, x, query_ids, q, k, asked.column("floor").to_numpy()[order])
            at, place = np.nonzero(best.scores > -np.inf)
            scores = [max(min(int(s), _MOST), -_MOST - 1) for s in best.scores[at, place]]
            return pa.table([pa.array(query_ids[at]), pa.array(best.ids[at, place]), pa.array(scores, pa.int64())],
                            names=names)

        return answer

    found = meet(rows, _with_floor(queries, seed_of, k), make, "query_id bigint, vec_id bigint, score bigint", shard_rows, block_rows)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _floor_double(v: Column) -> Column:
    """floor() as a double; values too large for a long are whole already."""
    return F.when(F.abs(v) < 2.0 ** 53, F.floor(v).cast("double")).otherwise(v)
