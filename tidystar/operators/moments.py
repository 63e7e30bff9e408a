"""Exact, order-free count, mean and sample deviation of a decimal column (A4, A5).

Values become whole numbers (``x`` times ten to the scale); their number, sum and sum of
squares are exact decimals, so they are the same in whatever order and grouping rows or
states are added. A state is such a row per key; states of days or files can be stored and
merged. Only the last step divides in doubles, from exact numbers taken about a whole number
beside the mean, so nothing cancels and every partitioning gives the same bits.

Sums hold ``DECIMAL(38,0)``: with values of 12 digits, 10 trillion rows. Beyond that Spark
raises an overflow error; a sum is never wrong. NULL values are left out; a group without
values has a NULL mean, one with a single value a NULL deviation.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WHOLE = "decimal(38,0)"
STATE = ("n", "s1", "s2")


def moment_aggregates(col: str, scale: int) -> list[Column]:
    """The aggregates of a state over a decimal column of at most ``scale`` places."""
    whole = (F.col(col).cast(f"decimal(18,{scale})") * F.lit(Decimal(10) ** scale)).cast("decimal(19,0)")
    return [F.count(col).alias("n"), F.sum(whole).cast(_WHOLE).alias("s1"),
            F.sum((whole * whole).cast(_WHOLE)).cast(_WHOLE).alias("s2")]


def moment_states(df: DataFrame, keys: list[str], col: str, scale: int = 2) -> DataFrame:
    """One state per group of ``keys`` (all rows without keys)."""
    return df.groupBy(*keys).agg(*moment_aggregates(col, scale))


def merge_states(states: DataFrame, keys: list[str]) -> DataFrame:
    """States of larger groups: plain sums."""
    return states.groupBy(*keys).agg(F.sum("n").alias("n"), *(F.sum(c).cast(_WHOLE).alias(c) for c in STATE[1:]))


def mean(scale: int = 2) -> Column:
    """Mean of a state: the exact sum as a double, divided by the count."""
    total = (F.col("s1") * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal(38,{scale})")
    return total.cast("double") / F.nullif(F.col("n"), F.lit(0))


def deviation(scale: int = 2) -> Column:
    """Sample deviation of a state."""
    n = F.col("n").cast("decimal(20,0)")
    about = F.round(F.col("s1") / F.nullif(n, F.lit(0).cast("decimal(20,0)"))).cast(_WHOLE)
    first = (F.col("s1") - (about * n).cast(_WHOLE)).cast(_WHOLE)
    # sum of (x - about) squared = s2 - about * (2 * s1 - n * about), all exact
    second = (F.col("s2") - (about * (F.col("s1") + first)).cast(_WHOLE)).cast(_WHOLE)
    off = first.cast("double")
    squares = second.cast("double") - off * off / F.nullif(F.col("n"), F.lit(0)).cast("double")
    return F.sqrt(F.greatest(squares, F.lit(0.0)) / F.nullif(F.col("n") - 1, F.lit(0))) / F.lit(float(10 ** scale))


def with_moments(states: DataFrame, scale: int = 2) -> DataFrame:
    """States with columns ``mean`` and ``deviation``."""
    return states.withColumns({"mean": mean(scale), "deviation": F.when(F.col("n") > 1, deviation(scale))})
