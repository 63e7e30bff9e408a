"""Exact distinct counts that can be merged: bitmaps over a dense key map (A2).

1. ``dense_key_map`` numbers the distinct (owner, key) pairs, an order of a customer say. Pairs
   are dealt by hash to buckets of half the size of a bitmap and numbered inside their
   bucket, so numbers are dense without a sort of all of them. The map is a table that is
   made once and used for any period.
2. ``distinct_states`` turns rows into one bitmap of 32,768 numbers per period and bucket
   (``bitmap_construct_agg``): a repeated key sets a bit again. A period costs one bit
   per pair, whatever its number of rows.
3. ``merge_states`` ORs the bitmaps of several periods (``bitmap_or_agg``): quarters from months,
   any range from its days, without the rows.
4. ``count_all`` adds up ``bitmap_count``; ``count_by_owner`` joins bitmaps and key map by bucket (at
   most one bitmap's worth of rows on either side of a key) and counts the pairs whose bit is set.

NULL keys are not counted, as in ``COUNT(DISTINCT)``; a NULL owner is an owner like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Numbers of a bitmap (fixed by Spark's bitmap functions), and pairs dealt to a bucket on average.
BITMAP = 32_768
PER_BUCKET = BITMAP // 2


def dense_key_map(df: DataFrame, owner: str, key: str, per_bucket: int = PER_BUCKET) -> DataFrame:
    """(owner, key, number) of the distinct pairs with a key; numbers start at 1."""
    pairs = df.where(F.col(key).isNotNull()).select(owner, key).distinct()
    buckets = max(1, -(-pairs.count() // per_bucket))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(owner, key))
    # twice the average is some 180 standard deviations away
    number = F.when(place <= BITMAP, F.col("bucket") * BITMAP + place) \
        .otherwise(F.raise_error(F.lit("a bucket of the key map is over full")).cast("bigint"))
    return pairs.withColumn("bucket", F.pmod(F.xxhash64(owner, key), F.lit(buckets).cast("bigint"))) \
        .select(owner, key, number.alias("number"))


def distinct_states(df: DataFrame, key_map: DataFrame, owner: str, key: str, periods: list[str]) -> DataFrame:
    """(periods, bucket, bits): the pairs that occur in each period."""
    same = F.col(f"d.{owner}").eqNullSafe(F.col(f"m.{owner}")) & (F.col(f"d.{key}") == F.col(f"m.{key}"))
    found = df.alias("d").join(key_map.alias("m"), same).select(*(f"d.{p}" for p in periods), "m.number")
    return found.groupBy(*periods, F.bitmap_bucket_number("number").alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def merge_states(states: DataFrame, periods: list[str]) -> DataFrame:
    """States of coarser periods."""
    return states.groupBy(*periods, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_all(states: DataFrame, periods: list[str], out: str = "n_keys") -> DataFrame:
    """Distinct pairs per period."""
    return states.groupBy(*periods).agg(F.sum(F.bitmap_count("bits")).alias(out))


def bit_is_set(bits: Column, position: Column) -> Column:
    """Whether a bitmap has the bit at ``position`` (0 is the lowest bit of the first byte)."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def count_by_owner(states: DataFrame, key_map: DataFrame, owner: str, periods: list[str], out: str = "n_keys") -> DataFrame:
    """Distinct keys of each owner per period."""
    numbered = key_map.select(owner, F.bitmap_bucket_number("number").alias("bucket"),
                              F.bitmap_bit_position("number").alias("position"))
    return numbered.join(states, "bucket").where(bit_is_set(F.col("bits"), F.col("position"))) \
        .groupBy(*periods, owner).agg(F.count(F.lit(1)).alias(out))
