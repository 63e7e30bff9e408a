"""Keyed layers in versions, and the update of a few keys without rewriting the layer.

A layer is a folder:

* ``data/<id>/``: Parquet files, never changed once written;
* ``manifests/<version>/``: one row per live file with its rows and key range, and
  ``blooms/<version>/``: the Bloom filter of its keys as 32,768-bit bitmaps;
* ``CURRENT``: the name of the version that readers see, switched by one rename.

Files are written in ranges of the key, so ranges are narrow. ``update_by_key`` finds the files
that a change set touches: keys meet key ranges in a range join, and candidates whose Bloom
filter lacks the key are dropped. Only touched files are read, joined with the changes and
written anew; the next manifest takes all other files over as they are. A run that dies
before the switch leaves the old version in place, and unnamed files beside it.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranges import number_bins, range_join
from . import files

#: Bits of a Bloom filter per key, hash functions, and bits of one bitmap (fixed by Spark).
BITS_PER_KEY, HASHES, BITMAP = 10, 4, 32_768


def _bits(key: str, n_bitmaps) -> F.Column:
    """The bit numbers of a key in a filter of so many bitmaps."""
    size = n_bitmaps * F.lit(BITMAP).cast("bigint")
    return F.array(*(F.pmod(F.xxhash64(F.col(key), F.lit(i)), size) for i in range(HASHES)))


def _describe(spark: SparkSession, folder: str, key: str) -> tuple[DataFrame, DataFrame]:
    """(manifest, blooms) of the files of a data folder; only the key column is read.

    All files of one write have filters of one size, made for the largest of them.
    """
    keys = spark.read.parquet(folder).select(F.col(key).alias("key"), F.col("_metadata.file_path").alias("file"))
    files_of = keys.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), F.min("key").alias("key_low"),
                                        F.max("key").alias("key_high"))
    most = files_of.agg(F.max("n_rows")).first()[0] or 1
    n_bitmaps = F.lit(-(-most * BITS_PER_KEY // BITMAP)).cast("bigint")
    bits = keys.where("key IS NOT NULL").select("file", F.explode(_bits("key", n_bitmaps)).alias("bit"))
    blooms = bits.groupBy("file", F.floor(F.col("bit") / BITMAP).alias("bitmap")) \
        .agg(F.bitmap_construct_agg((F.col("bit") % BITMAP)).alias("bits"))
    return files_of.withColumn("n_bitmaps", n_bitmaps), blooms


def _write_data(spark: SparkSession, df: DataFrame, root: str, key: str, n_files: int) -> str:
    folder = os.path.join(root, "data", uuid.uuid4().hex)
    df.repartitionByRange(n_files, key).sortWithinPartitions(key).write.parquet(folder)
    return folder


def _publish(spark: SparkSession, root: str, manifest: DataFrame, blooms: DataFrame) -> str:
    version = f"{int(current_version(spark, root) or 0) + 1:08d}"
    # left by a run that died before it switched: replaced
    manifest.write.mode("overwrite").parquet(os.path.join(root, "manifests", version))
    blooms.write.mode("overwrite").parquet(os.path.join(root, "blooms", version))
    files.put(spark, os.path.join(root, "CURRENT"), version)
    return version


def current_version(spark: SparkSession, root: str) -> str | None:
    return files.get(spark, os.path.join(root, "CURRENT"))


def _part(spark: SparkSession, root: str, part: str, version: str | None) -> DataFrame:
    version = version or current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no published version: {root}")
    return spark.read.parquet(os.path.join(root, part, version))


def manifest_of(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """file, n_rows, key_low, key_high, n_bitmaps of the files of a version (the current one)."""
    return _part(spark, root, "manifests", version)


def read_version(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """The rows of a version (the current one)."""
    names = [r["file"] for r in manifest_of(spark, root, version).select("file").collect()]
    return spark.read.parquet(*sorted(names))


def create(spark: SparkSession, root: str, df: DataFrame, key: str, n_files: int) -> str:
    """Write ``df`` whole, in ``n_files`` ranges of ``key``, as the next version; its name."""
    return _publish(spark, root, *_describe(spark, _write_data(spark, df, root, key, n_files), key))


def touched_files(spark: SparkSession, root: str, keys: DataFrame, key: str) -> DataFrame:
    """(file): the files of the current version that may hold one of ``keys``."""
    manifest = manifest_of(spark, root).withColumnRenamed("file", "held_in")
    span = manifest.agg(F.min("key_low").alias("low"), F.max("key_high").alias("high"), F.count("*").alias("n")).first()
    width = max(1, (int(span["high"] or 0) - int(span["low"] or 0)) // max(span["n"], 1))
    asked = keys.where(F.col(key).isNotNull()).select(F.col(key).alias("asked")).distinct()
    near = range_join(asked, manifest, "asked", "key_low", "key_high", number_bins(width))
    # every bit of the key must be set in the filter of the file
    bits = near.select("held_in", "asked", F.explode(_bits("asked", F.col("n_bitmaps"))).alias("bit")) \
        .select("held_in", "asked", F.floor(F.col("bit") / BITMAP).alias("bitmap"), (F.col("bit") % BITMAP).alias("at"))
    blooms = _part(spark, root, "blooms", None).withColumnRenamed("file", "held_in")
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = bits.join(blooms, ["held_in", "bitmap"]).where(F.getbit(byte, (F.col("at") % 8).cast("int")) == 1)
    return held.groupBy("held_in", "asked").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == HASHES) \
        .select(F.col("held_in").alias("file")).distinct()


def update_by_key(spark: SparkSession, root: str, changes: DataFrame, key: str) -> tuple[str, int]:
    """Set the other columns of ``changes`` where the key of a row is one of its keys.

    ``changes`` has one row per key, or it is refused; keys that the layer lacks change nothing, a NULL key
    matches nothing, a NULL value is written. Returns the new version and the number of rewritten files.
    """
    if not changes.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").isEmpty():
        raise ValueError(f"a key of the change set repeats: {key}")
    # one name per file: as many as the reader lists anyway
    names = sorted(r["file"] for r in touched_files(spark, root, changes, key).collect())
    if not names:
        return current_version(spark, root), 0
    old = spark.read.parquet(*names)
    columns = [c for c in changes.columns if c != key]
    new = changes.where(F.col(key).isNotNull()).select(key, F.struct(*columns).alias("changed_to"))
    done = old.join(new, key, "left").select(*(
        F.when(F.col("changed_to").isNotNull(), F.col(f"changed_to.{c}")).otherwise(F.col(c)).alias(c)
        if c in columns else F.col(c) for c in old.columns))
    manifest, blooms = _describe(spark, _write_data(spark, done, root, key, len(names)), key)
    gone = F.col("file").isin(names)
    version = _publish(spark, root, manifest_of(spark, root).where(~gone).unionByName(manifest),
                       _part(spark, root, "blooms", None).where(~gone).unionByName(blooms))
    return version, len(names)
