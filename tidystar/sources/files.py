"""Small marker and pointer files on any store that Spark can write (through its Hadoop file systems)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, store = _place(spark, path)
    return store.exists(place)


def put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers see the old text or the new one, never a part: written beside, then renamed."""
    beside, store = _place(spark, f"{path}.{uuid.uuid4().hex}")
    place, _ = _place(spark, path)
    out = store.create(beside)
    out.write(text.encode())
    out.close()
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    chosen = spark.sparkContext._gateway.new_array(options, 1)
    chosen[0] = options.OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        place.makeQualified(store.getUri(), store.getWorkingDirectory()).toUri(),
        spark._jsc.hadoopConfiguration()).rename(
            beside.makeQualified(store.getUri(), store.getWorkingDirectory()),
            place.makeQualified(store.getUri(), store.getWorkingDirectory()), chosen)


def get(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    place, store = _place(spark, path)
    if not store.exists(place):
        return None
    stream = store.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
