"""Which part of a date comes first, decided per source and column.

Text such as ``03/04/2001`` does not tell whether it is month first (as the reference's server
setting reads it) or day first; a whole file usually does, by its days above 12.

1. ``evidence`` holds per source and column how many dates have two leading parts, and how many
   prove day first (first part 13 to 31, second at most 12) or month first. It is three
   sums: states of several files, days or runs are merged by adding.
2. ``decide``: ``day`` or ``month`` where only one is proved, ``mixed`` where both are, ``undecided``
   where none is (``none`` without such dates). Undecided and mixed sources keep the reference's
   reading, month first, except for dates that can only be day first; ``report`` lists them.
3. ``read_dates`` brings day-first text into month-first order and casts once with the common rule.

NULL and other text is no evidence; a NULL source is a source like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import safe_timestamp, strip_quotes
from .skew import join_hot

#: Two parts of one or two digits, then a year, then perhaps a time.
LEADING = r"^ *([0-9]{1,2})[-/]([0-9]{1,2})[-/]([0-9]{4}|[0-9]{2})(?![0-9])"


def _parts(c: Column) -> tuple[Column, Column]:
    text = strip_quotes(c)
    return tuple(F.regexp_extract(text, LEADING, i).try_cast("int") for i in (1, 2))  # no match is '' and gives NULL


def evidence(df: DataFrame, source: str, columns: list[str]) -> DataFrame:
    """(source, column_name, n_rows, n_dates, n_day, n_month): mergeable sums."""
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("cell")) for c in columns)))
    first, second = _parts(F.col("c.cell"))
    valid = first.between(1, 31) & second.between(1, 31)
    return df.select(F.col(source).alias("source"), cells.alias("c")).groupBy("source", F.col("c.column_name")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(valid).alias("n_dates"),
        F.count_if(valid & (first > 12) & (second <= 12)).alias("n_day"),
        F.count_if(valid & (second > 12) & (first <= 12)).alias("n_month"))


def merge_evidence(*states: DataFrame) -> DataFrame:
    """The evidence of several states together."""
    rows = states[0]
    for more in states[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("source", "column_name").agg(
        *(F.sum(c).alias(c) for c in ("n_rows", "n_dates", "n_day", "n_month")))


def decide(found: DataFrame) -> DataFrame:
    """Evidence with ``date_order``: day, month, mixed, undecided or none."""
    day, month = F.col("n_day") > 0, F.col("n_month") > 0
    return found.withColumn("date_order", F.when(day & month, "mixed").when(day, "day").when(month, "month")
                            .when(F.col("n_dates") > 0, "undecided").otherwise("none"))


def report(decided: DataFrame) -> DataFrame:
    """The sources and columns whose order is not known."""
    return decided.where(F.col("date_order").isin("mixed", "undecided"))


def month_first(c: Column, date_order: Column) -> Column:
    """Date text in month-first order."""
    first, second = _parts(c)
    day_first = (date_order == "day") | ((first > 12) & (second <= 12))
    return F.when(day_first, F.regexp_replace(strip_quotes(c), LEADING, "$2-$1-$3")).otherwise(c)


def read_dates(df: DataFrame, decided: DataFrame, source: str, column: str, out: str) -> DataFrame:
    """``df`` with ``out``: the text of ``column`` as a timestamp, in its source's order.

    A hot source is joined by broadcast, the rest by a shuffle on the source.
    """
    mine = decided.where(F.col("column_name") == column)
    known = F.coalesce(F.col(source).cast("string"), F.lit("")), F.col(source).isNull()
    rows = df.withColumns({"date_order_key": known[0], "date_order_null": known[1]})
    orders = mine.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("date_order_key"),
                         F.col("source").isNull().alias("date_order_null"), "date_order", F.col("n_rows").alias("date_order_rows"))
    joined = join_hot(rows, orders, ["date_order_key", "date_order_null"], "date_order_rows")
    # a column of its own: the cast tests its text many times
    return joined.withColumn("date_order_text", month_first(F.col(f"`{column}`"), F.col("date_order"))) \
        .withColumn(out, safe_timestamp("date_order_text")).select(*df.columns, out)
