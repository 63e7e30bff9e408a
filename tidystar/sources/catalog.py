"""Named tables of the session's catalog: bucketed, declared and computed on read.

* ``save_bucketed`` stores a table by buckets of its key, sorted inside them. Joins of two such
  tables on the key (J1 to J3) need no exchange and no sort.
* ``declare`` creates a table from declared columns: VARCHAR(n) sizes are checked by the write
  itself, which fails on a longer value, and columns with a DEFAULT are filled in.
* ``net_amount_view`` adds the computed column of the fact when it is read (C20); its files do not hold it.

Every table lies under a path that the caller names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.model import with_net_amount

#: The load stamp that the reference's tables fill in by themselves.
LOAD_STAMP = "fecha_carga TIMESTAMP DEFAULT current_timestamp()"


def save_bucketed(df: DataFrame, table: str, key: str, n_buckets: int, path: str) -> None:
    """Replace ``table`` by ``df`` in buckets of ``key``; one file per bucket."""
    df.repartition(n_buckets, key).write.mode("overwrite").format("parquet").option("path", path) \
        .bucketBy(n_buckets, key).sortBy(key).saveAsTable(table)


def declared_columns(df: DataFrame, limits: Mapping[str, int]) -> list[str]:
    """Column declarations of ``df``: its types, with VARCHAR(n) for the columns of ``limits``."""
    return [f"`{f.name}` VARCHAR({limits[f.name]})" if f.name in limits else f"`{f.name}` {f.dataType.simpleString()}"
            for f in df.schema]


def declare(spark: SparkSession, table: str, columns: Sequence[str], path: str) -> None:
    """Create ``table`` anew with declared columns (those of S9 end with ``LOAD_STAMP``)."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({', '.join(columns)}) USING parquet LOCATION '{path}'")


def insert(df: DataFrame, table: str) -> None:
    """Append ``df``; columns that it lacks get their DEFAULT, an over-long text fails the write."""
    names = ", ".join(f"`{c}`" for c in df.columns)
    df.sparkSession.sql(f"INSERT INTO {table} ({names}) SELECT {names} FROM {{rows}}", rows=df)


def net_amount_view(spark: SparkSession, table: str, view: str) -> DataFrame:
    """A view of a fact without net amounts that computes them; the view's rows."""
    with_net_amount(spark.table(table)).createOrReplaceTempView(view)
    return spark.table(view)


def drop(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def case_blind(c, collation: str = "UTF8_LCASE"):
    """A text that compares, joins and groups without regard to case, as the reference's server does."""
    return F.collate(F.col(c) if isinstance(c, str) else c, collation)
