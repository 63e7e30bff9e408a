"""Integrity checks as distributed jobs (A7, J6, S9 lengths).

The reference relies on database constraints (primary key, foreign key,
VARCHAR(n)). Parquet tables enforce none of them, so each becomes a query
whose result lists the offending rows; an empty result means the constraint
holds. Each check is a single aggregate or anti join, never a collect.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, and the NULL key if present.

    Partial aggregation counts each key on the map side first, so a hot key
    costs one row per map task in the shuffle.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter((F.col("n_rows") > 1) | F.col(key).isNull())


def orphans(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose non-NULL foreign ``key`` is missing from ``dim``."""
    return df.filter(F.col(key).isNotNull()).join(dim.select(key), on=key, how="left_anti")


def too_long(df: DataFrame, key: str, limits: Mapping[str, int]) -> DataFrame:
    """(key, column, length) for each text value longer than its declared size.

    One pass over the table: every limit is tested in the same projection.
    """
    hits = F.array_compact(F.array(*[
        F.when(F.length(c) > n, F.struct(F.lit(c).alias("column_name"),
                                         F.length(c).alias("length")))
        for c, n in limits.items()]))
    return (df.select(key, hits.alias("hits"))
              .filter(F.size("hits") > 0)
              .select(key, F.explode("hits").alias("h"))
              .select(key, "h.column_name", "h.length"))


def key_and_length_violations(df: DataFrame, key: str, limits: Mapping[str, int]) -> DataFrame:
    """A7 + S9 in one pass: keys that repeat or are NULL, or whose rows hold a
    text value longer than its declared size (one grouped scan of the table)."""
    aggs = [F.count(F.lit(1)).alias("n_rows")] + [
        F.max(F.length(c)).alias(f"max_len_{c}") for c in limits]
    bad = (F.col("n_rows") > 1) | F.col(key).isNull()
    for c, n in limits.items():
        bad = bad | (F.col(f"max_len_{c}") > n)
    return df.groupBy(key).agg(*aggs).filter(bad)


def dropped_rows(raw_c: DataFrame, raw_p: DataFrame, raw_o: DataFrame, stg_c: DataFrame, stg_p: DataFrame,
                 stg_o: DataFrame, key_type: str = "int") -> DataFrame:
    """(table_name, rule, n_rows): how many rows each rule of the run leaves out.

    ``no key``: rows whose key is NULL after cleaning. ``repeated key``: rows
    beyond the one kept per key. ``country or names``: customers left out by the
    stage filters. ``unknown customer`` / ``unknown product``: staged orders whose
    key the dimension lacks (a NULL key counts).
    """
    def counted(name: str, raw: DataFrame, key: str) -> DataFrame:
        clean = raw.select(R.key_int(key, key_type).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        return clean.agg(
            F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("no key"),
            F.coalesce(F.sum(F.when(F.col("k").isNotNull(), F.col("n") - 1)), F.lit(0)).alias("repeated key"),
            F.count("k").alias("keys")).withColumn("table_name", F.lit(name))

    def rules(df: DataFrame) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"`{r}`").cast("bigint").alias("n_rows"))
                          for r in ("no key", "repeated key")])
        return df.select("table_name", F.inline(pairs))

    def missing(dim: DataFrame, key: str, rule: str) -> DataFrame:
        gone = stg_o.groupBy(key).agg(F.count(F.lit(1)).alias("n")).join(dim.select(key), key, "left_anti")
        return gone.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows")) \
            .select(F.lit("orders").alias("table_name"), F.lit(rule).alias("rule"), "n_rows")

    customers = counted("customers", raw_c, "customer_id")
    kept = stg_c.agg(F.count(F.lit(1)).alias("n")).scalar()
    filtered = customers.select("table_name", F.lit("country or names").alias("rule"), (F.col("keys") - kept).alias("n_rows"))
    return (rules(customers).union(filtered).union(rules(counted("products", raw_p, "product_id")))
            .union(rules(counted("orders", raw_o, "order_id")))
            .union(missing(stg_c, "customer_id", "unknown customer"))
            .union(missing(stg_p, "product_id", "unknown product")))


def assert_empty(df: DataFrame, what: str) -> None:
    """Fail the run when a check finds rows (reads at most one row)."""
    if df.limit(1).count() > 0:
        raise ValueError(f"integrity check failed: {what}")
