"""Table scans and layer sinks (inventory S5, S6, S8-S10, S12)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import compile_small_methods


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan of a single split over the cluster's cores.

    One Parquet row group is read by one task, and all row-level cleaning after
    it would run on one core. Only a scan of one partition is spread, so at most
    one split is ever moved; any other scan passes unchanged.
    """
    if df.rdd.getNumPartitions() > 1:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def load_table(spark: SparkSession, base_dir: str, name: str,
               parallel: bool = True) -> DataFrame:
    """Scan one Parquet table. Lazy: Catalyst prunes columns and pushes filters."""
    compile_small_methods(spark)
    df = spark.read.parquet(os.path.join(base_dir, f"{name}.parquet"))
    return spread(df) if parallel else df


def with_load_stamp(df: DataFrame, name: str = "fecha_carga") -> DataFrame:
    """Add the load-time stamp column (never part of compared results)."""
    return df.withColumn(name, F.current_timestamp())


def write_layer(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a layer table whole.

    ``overwrite`` is the rerun safety of the reference's drop-if-exists.
    Writing to a *new* path is required when ``df`` reads ``path`` itself.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
