"""Vectors dealt to shards, queries streamed past them.

A stated query set meets all rows without a cross join of rows: candidates are
dealt evenly to shards of about ``shard_rows`` rows, and every query is sent once to every
shard. A shard's rows come first in its partition and become its index, once; its queries
follow in Arrow batches, so a task holds one shard and one batch, however many queries there
are. Vectors of different lengths never meet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable_vectors(df: DataFrame, id_col: str, vector_col: str, zero: bool) -> DataFrame:
    """(vec_id, vector as doubles, dim) of the rows that take part.

    Rows with a NULL id or vector, or with a NULL or non-finite component, are
    left out; all-zero vectors too unless ``zero``.
    """
    v = F.col("vector")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")) \
        .where(F.col("vec_id").isNotNull() & v.isNotNull()).where(~bad)
    if not zero:
        rows = rows.where(F.exists(v, lambda x: x != 0))
    return rows.withColumn("dim", F.size("vector"))


def one_row_per_query(rows: DataFrame, is_query: Column) -> DataFrame:
    """The query rows; of rows that repeat an id the smallest vector asks."""
    return rows.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector")) \
        .withColumn("dim", F.size("vector"))


def meet(rows: DataFrame, queries: DataFrame, make, schema: str, shard_rows: int, block_rows: int) -> DataFrame:
    """What ``make(candidates)``, a function of a table of queries, gives for every (dim, shard).

    ``rows`` and ``queries`` hold vec_id, vector and dim, ``queries`` perhaps more columns.
    """
    shards = max(1, -(-rows.count() // shard_rows))
    more = [c for c in queries.columns if c not in ("vec_id", "vector", "dim")]
    dealt = rows.select("vec_id", "vector", "dim", *(F.lit(None).cast(queries.schema[c].dataType).alias(c) for c in more),
                        (F.monotonically_increasing_id() % shards).cast("int").alias("shard"), F.lit(0).alias("turn"))
    asked = queries.select("vec_id", "vector", "dim", *more,
                           F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("turn"))

    def run(batches):
        shard, held, answer = None, [], None
        for batch in batches:
            key = [np.asarray(batch.column(c)) for c in ("dim", "shard", "turn")]
            cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1 if batch.num_rows else []
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if a == b:
                    continue
                here = (key[0][a], key[1][a])
                if here != shard:
                    shard, held, answer = here, [], None
                part = batch.slice(a, b - a)
                if not key[2][a]:
                    held.append(part)
                elif held or answer:
                    if answer is None:
                        answer, held = make(pa.Table.from_batches(held)), []
                    for at in range(0, part.num_rows, block_rows):
                        yield from answer(pa.Table.from_batches([part.slice(at, block_rows)])).to_batches()

    return dealt.union(asked).repartition("dim", "shard").sortWithinPartitions("dim", "shard", "turn", "vec_id") \
        .mapInArrow(run, schema)


def unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and the (rows, dim) matrix of a group, in id order."""
    ids = table.column("vec_id").to_numpy()
    flat = table.column("vector").combine_chunks()
    flat = (flat.flatten() if not isinstance(flat, pa.ChunkedArray) else pa.concat_arrays(
        [c.flatten() for c in flat.chunks])).to_numpy(zero_copy_only=False)
    order = np.argsort(ids, kind="stable")
    return ids[order], flat.reshape(len(ids), -1)[order] if len(ids) else flat.reshape(0, 0)
