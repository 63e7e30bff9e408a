"""Approximate nearest neighbours with a permutation index.

Pivots are a bounded sample of the vectors. A vector is represented by its
``PREFIX`` nearest pivots in order, and posted in the inverted file of each of
them with its position. A query reads the inverted files of its own nearest
pivots, adds up the footrule distance of the two orders (a pivot missing from a
prefix counts as standing just behind it), keeps the ``RERANK`` share of the
shard's vectors with the smallest distance and reranks them by exact Euclidean
distance. Every shard answers every query; the merged result is the best of all
shards.

Every row is indexed. Equal vectors of a shard are one entry, so a flood of copies
cannot push others out; nor can rows with the query's own id, however many. The share reranked is a
fraction of the shard at every size, and at least as many entries as are asked for, so
each query gets all candidates if there are fewer. A shard's index is built once and
all queries stream past it.

Defined results: rows with a NULL id or vector, a NULL or non-finite component,
or only zeros take no part; vectors meet only vectors of their length;
candidates that carry the query's id are its own and left out; other repeated
rows are each candidates; equal distances go to the smaller id. An empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidystar.llm.vector_blocks import meet, one_row_per_query, unpack, usable_vectors

#: Bounded sample of vectors that become pivots, by a hash of their ids.
PIVOTS = 512
PREFIX = 128
#: Share of a shard's distinct vectors that is reranked.
RERANK = 0.35
SHARD_ROWS = 8192
BLOCK_ROWS = 2048


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """(rows, prefix) pivot numbers, nearest first."""
    out = np.empty((len(x), prefix), np.int64)
    half = (pivots ** 2).sum(axis=1) / 2
    for a in range(0, len(x), 1024):
        away = half - x[a:a + 1024] @ pivots.T
        first = np.argpartition(away, prefix - 1, axis=1)[:, :prefix] if prefix < len(pivots) \
            else np.broadcast_to(np.arange(len(pivots)), away.shape)
        order = np.argsort(np.take_along_axis(away, first, 1), axis=1, kind="stable")
        out[a:a + 1024] = np.take_along_axis(first, order, 1)
    return out


class PermutationIndex:
    """Pivot inverted files over the distinct vectors of one shard."""

    def __init__(self, x: np.ndarray, pivots: np.ndarray, prefix: int = PREFIX):
        self.prefix = min(prefix, len(pivots))
        self.pivots, self.n = pivots, len(x)
        orders = nearest_pivots(x, pivots, self.prefix)
        by_pivot = np.argsort(orders.ravel(), kind="stable")
        self.entry = (by_pivot // self.prefix).astype(np.int32)
        self.place = (by_pivot % self.prefix).astype(np.int32)
        self.starts = np.searchsorted(orders.ravel()[by_pivot], np.arange(len(pivots) + 1))

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Footrule distance of every entry to a query's pivot order."""
        k = self.prefix
        away = np.full(self.n, k * (k + 1), np.int32)  # nothing in common
        for p, pivot in enumerate(order.tolist()):
            a, b = self.starts[pivot], self.starts[pivot + 1]
            place = self.place[a:b]
            away[self.entry[a:b]] += np.abs(place - p) - (k - p) - (k - place)
        return away

    def nearest(self, order: np.ndarray, share: float, least: int, without: np.ndarray) -> np.ndarray:
        """The entries to rerank; those of ``without`` take no place."""
        many = max(least, int(np.ceil(share * self.n)))
        if many >= self.n - len(without):
            return np.delete(np.arange(self.n), without)
        away = self.footrule(order)
        away[without] = np.iinfo(away.dtype).max
        return np.argpartition(away, many)[:many]


def _distinct(ids: np.ndarray, x: np.ndarray):
    """Distinct vectors (ordered by smallest id), the ids of each in order, and the entry of every row."""
    raw = np.ascontiguousarray(x + 0.0).view(np.dtype((np.void, x.shape[1] * 8))).ravel()
    _, first, which = np.unique(raw, return_index=True, return_inverse=True)
    order = np.argsort(which, kind="stable")
    counts = np.bincount(which)
    begins = np.cumsum(counts) - counts
    by_id = np.argsort(first, kind="stable")
    place = np.empty(len(first), np.int64)
    place[by_id] = np.arange(len(first))
    return x[first[by_id]], [ids[order[a:a + c]] for a, c in zip(begins[by_id], counts[by_id])], place[which]


class Shard:
    """The index of one shard (rows in id order)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, pivots: np.ndarray, prefix: int):
        self.ids = ids
        self.x, self.members, self.entries = _distinct(ids, x)
        self.index = PermutationIndex(self.x, pivots, prefix)
        self.smallest = np.array([m[0] for m in self.members])


def search_shard(shard: Shard, query_ids: np.ndarray, q: np.ndarray, k: int, share: float, least: int = 0):
    """(query_id, vec_id, distance) of the k nearest found in one shard for each query.

    Rows with the query's id are left out before anything is cut.
    """
    ids, x, members, entries, smallest = shard.ids, shard.x, shard.members, shard.entries, shard.smallest
    index, pivots = shard.index, shard.index.pivots
    begins, ends = np.searchsorted(ids, query_ids), np.searchsorted(ids, query_ids, side="right")
    out = []
    for query_id, vector, order, a, b in zip(query_ids.tolist(), q, nearest_pivots(q, pivots, index.prefix), begins, ends):
        others = {e: members[e][members[e] != query_id] for e in np.unique(entries[a:b]).tolist()}
        alone = np.array([e for e, m in others.items() if not len(m)], np.int64)
        at = index.nearest(order, share, max(least, k), alone)
        first_id = smallest
        if len(others) > len(alone):
            first_id = smallest.copy()
            for e, m in others.items():
                first_id[e] = m[0] if len(m) else query_id
        away = np.sqrt(((x[at] - vector) ** 2).sum(axis=1))
        # any of the k nearest rows is in one of the k first entries, among its k smallest ids
        near = np.flatnonzero(away <= np.partition(away, k - 1)[k - 1]) if len(away) > k else np.arange(len(away))
        found = sorted((away[i], v) for i in near[np.lexsort((first_id[at[near]], away[near]))][:k]
                       for v in others.get(at[i], members[at[i]])[:k].tolist())
        out += [(query_id, v, float(d)) for d, v in found[:k]]
    return out


def nearest_neighbours(df: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id",
                       vector_col: str = "embedding", n_pivots: int = PIVOTS, prefix: int = PREFIX,
                       share: float = RERANK, least: int = 0, shard_rows: int = SHARD_ROWS,
                       block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance) of the k nearest found for every query.

    ``is_query`` is a condition on the column ``vec_id``. ``share`` of each shard is reranked, or ``least``
    entries, or k, whichever is most.
    """
    rows = usable_vectors(df, id_col, vector_col, zero=False)
    queries = one_row_per_query(rows, is_query)
    sample = rows.select("dim", "vector", F.xxhash64("vec_id").alias("key")) \
        .orderBy("key", "vector").limit(n_pivots).collect()
    pivots = {}
    for dim in {s["dim"] for s in sample}:
        pivots[dim] = np.unique(np.array([s["vector"] for s in sample if s["dim"] == dim]), axis=0)

    names, types = ["query_id", "vec_id", "score"], [pa.int64(), pa.int64(), pa.float64()]

    def make(candidates: pa.Table):
        ids, x = unpack(candidates)
        # a rare length without pivots: its first vector
        shard = Shard(ids, x, pivots.get(x.shape[1], x[:1]), prefix)

        def answer(asked: pa.Table) -> pa.Table:
            columns = list(zip(*search_shard(shard, *unpack(asked), k, share, least))) or [[], [], []]
            return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        return answer

    found = meet(rows, queries, make, "query_id bigint, vec_id bigint, score double", shard_rows, block_rows)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
