"""Business questions over the star schema (R1-R3; A1-A5, J3-J5, C18, C19, T1-T3).

Scale notes
-----------
* One-row statistics (the quarter bounds of R1, the mean and deviation of R3) are
  scalar subqueries: partial aggregates on every task, one final row, fed to the
  main plan as a value. There is no cross join, and nothing is collected.
* R1 counts per customer before it meets the dimension. R2 joins first and then
  groups by month and category: a few hundred partial rows per task are shuffled
  instead of nearly one per sale. No join carries a hint; Spark broadcasts a
  dimension by its measured size and otherwise splits skewed partitions.
* Sorts sit at the very end; the top-k is a ``TakeOrderedAndProject``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .distinct import count_by_owner, distinct_states
from .moments import deviation, mean, moment_states

SUM_TYPE = "decimal(38,2)"


def latest_quarter_bounds(fact: DataFrame, date_col: str = "order_date"):
    """A1: scalar (lo, hi): first instant of the newest date's calendar quarter, newest date.

    Both are NULL when there is no dated row.
    """
    d = F.max(date_col)
    start = F.make_timestamp_ntz(F.year(d), (F.quarter(d) - 1) * 3 + 1, F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return fact.agg(F.struct(start.alias("lo"), d.alias("hi")).alias("s")).scalar()


def full_name(first: str = "first_name", last: str = "last_name"):
    """CONCAT(first, ' ', last) where a NULL part counts as empty text."""
    return F.concat(F.coalesce(F.col(first), F.lit("")), F.lit(" "),
                    F.coalesce(F.col(last), F.lit("")))


def top_customers_latest_quarter(fact: DataFrame, dim_c: DataFrame, n: int = 3,
                                 keys_checked: bool = False) -> DataFrame:
    """The ``n`` customers with most orders in the latest quarter.

    The quarter runs from its first day to the newest order (not 90 days,
    not the last full quarter). Ties: more orders first, then name, then id.

    ``keys_checked=True`` states what ``run_layers`` verifies: order ids are unique
    in ``fact`` and every fact customer is in ``dim_c``. Orders are then counted
    instead of counted distinct (a map-side sum), and only customers at or above
    the ``n``-th largest count, ties included, go on to the dimension.
    """
    bounds = latest_quarter_bounds(fact)
    in_quarter = fact.filter((F.col("order_date") >= bounds.getField("lo"))
                             & (F.col("order_date") <= bounds.getField("hi")))
    orders = F.count("order_id") if keys_checked else F.count_distinct("order_id")
    counts = in_quarter.groupBy("customer_id").agg(orders.alias("cantidad_pedidos"))
    if keys_checked:
        kth = (counts.orderBy(F.desc("cantidad_pedidos")).limit(n)
               .agg(F.min("cantidad_pedidos")).scalar())
        counts = counts.filter(F.col("cantidad_pedidos") >= kth)
    named = counts.join(dim_c.select("customer_id", "first_name", "last_name"), on="customer_id", how="inner")
    out = named.select(F.col("customer_id"), full_name().alias("nombre_completo"),
                       F.col("cantidad_pedidos"))
    return out.orderBy(F.desc("cantidad_pedidos"), F.asc("nombre_completo"),
                       F.asc("customer_id")).limit(n)


def top_customers_by_distinct_orders(fact: DataFrame, key_map: DataFrame, dim_c: DataFrame, n: int = 3) -> DataFrame:
    """R1 where order ids repeat: distinct orders by the bitmaps of ``operators.distinct``.

    ``key_map`` numbers the (customer_id, order_id) pairs of the fact, or of more rows.
    """
    bounds = latest_quarter_bounds(fact)
    in_quarter = fact.filter((F.col("order_date") >= bounds.getField("lo"))
                             & (F.col("order_date") <= bounds.getField("hi")))
    states = distinct_states(in_quarter, key_map, "customer_id", "order_id", [])
    counts = count_by_owner(states, key_map, "customer_id", [], "cantidad_pedidos")
    named = counts.join(dim_c.select("customer_id", "first_name", "last_name"), on="customer_id", how="inner")
    return named.select("customer_id", full_name().alias("nombre_completo"), "cantidad_pedidos") \
        .orderBy(F.desc("cantidad_pedidos"), F.asc("nombre_completo"), F.asc("customer_id")).limit(n)


def revenue_by_month_category(fact: DataFrame, dim_p: DataFrame) -> DataFrame:
    """R2: gross revenue (sum of totals, not net) by year, month and category.

    A NULL order date forms its own (NULL, NULL) group, as in SQL.
    """
    out = fact.join(dim_p.select("product_id", "category"), on="product_id", how="inner").groupBy(
        F.year("order_date").cast("bigint").alias("ano"), F.month("order_date").cast("bigint").alias("mes"),
        F.col("category").alias("categoria"),
    ).agg(F.sum(F.col("total_amount_usd").cast(SUM_TYPE)).cast(SUM_TYPE).alias("revenue_total"))
    return out.orderBy(F.desc("revenue_total"), "ano", "mes", "categoria")


def total_stats(fact: DataFrame, col: str = "total_amount_usd"):
    """A4/A5: scalar (mean, sd), the same bits for every order and partitioning of the rows."""
    state = moment_states(fact, [], col)
    return state.select(F.struct(mean().alias("mean"), F.when(F.col("n") > 1, deviation()).alias("sd")).alias("s")).scalar()


def zscore_outliers(fact: DataFrame, threshold: float = 2.0,
                    col: str = "total_amount_usd") -> DataFrame:
    """Orders whose total is more than ``threshold`` deviations above the mean.

    The cut is on the unrounded z; the value shown and sorted is rounded to
    four places. A deviation of 0 gives no rows (z is NULL).
    """
    s = total_stats(fact, col)
    z = (F.col(col).cast("double") - s.getField("mean")) / F.nullif(s.getField("sd"),
                                                                   F.lit(0.0))
    return (fact.select("order_id", "customer_id", col, z.alias("z_raw"))
                .filter(F.col("z_raw") > F.lit(threshold))
                .select("order_id", "customer_id", col,
                        F.round("z_raw", 4).alias("z_score"))
                .orderBy(F.desc("z_score"), F.asc("order_id")))
