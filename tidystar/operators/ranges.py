"""Range joins: rows with a value meet all ranges that hold it.

Both sides are dealt to bins of the value's axis; a range is in every bin it touches. Rows and
ranges of a bin meet by an equi-join and the exact bounds are tested inside it, so there is no
nested loop. Bins with more than 1 in ``HOT`` of all rows (fewer than ``HOT`` bins, by this
definition, hence broadcast) are split: their rows are dealt to parts by hash, and
their ranges stand in every part.

Bounds are inclusive, as in BETWEEN. A NULL value or bound meets nothing, nor does a range whose
end is before its beginning.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import HOT

_BIN, _PART = "range_join_bin", "range_join_part"


def day_bins(days: int) -> Callable[[Column], Column]:
    """Bins of so many days for dates and timestamps."""
    return lambda c: F.floor(F.unix_date(F.to_date(c)) / days)


def number_bins(width) -> Callable[[Column], Column]:
    """Bins of equal width for numbers."""
    return lambda c: F.floor(c / F.lit(width))


def range_join(rows: DataFrame, ranges: DataFrame, value: str, low: str, high: str, bins: Callable[[Column], Column],
               how_many: int = HOT) -> DataFrame:
    """Every row of ``rows`` with every row of ``ranges`` where ``low <= value <= high``.

    ``bins`` maps a value to the whole number of its bin and never falls as values rise. Columns of the
    two sides must differ. A width near the usual length of a range keeps ranges in few bins.
    """
    clash = {c.lower() for c in rows.columns} & {c.lower() for c in ranges.columns}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    binned = rows.where(F.col(value).isNotNull()).withColumn(_BIN, bins(F.col(value)).cast("bigint"))
    sizes = binned.groupBy(_BIN).agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    parts = F.ceil(F.col("n") * how_many / F.lit(max(total, 1))).cast("bigint").alias("parts")
    hot = F.broadcast(sizes.where(F.col("n") * how_many > F.lit(total)).select(_BIN, parts))
    many = F.coalesce("parts", F.lit(1).cast("bigint"))
    spread = binned.join(hot, _BIN, "left") \
        .withColumn(_PART, F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in rows.columns)), many)) \
        .drop("parts")
    held = ranges.where(F.col(low) <= F.col(high)) \
        .withColumn(_BIN, F.explode(F.sequence(bins(F.col(low)).cast("bigint"), bins(F.col(high)).cast("bigint")))) \
        .join(hot, _BIN, "left").withColumn(_PART, F.explode(F.sequence(F.lit(0).cast("bigint"), many - 1))).drop("parts")
    return spread.join(held, [_BIN, _PART]).where((F.col(value) >= F.col(low)) & (F.col(value) <= F.col(high))) \
        .drop(_BIN, _PART)
