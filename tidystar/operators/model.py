"""Stage -> star schema: two dimensions and the sales fact.

The fact keeps only orders whose customer and product exist in the
dimensions. Those joins only test existence, so they are ``left_semi``: a
fact row can never be multiplied, and Spark is free to broadcast the key set
when its *measured* size is under the adaptive threshold (the size check),
or to shuffle-join it otherwise. No broadcast is forced here, because a
customer dimension grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R

DIM_CUSTOMER_COLUMNS = ("customer_id", "first_name", "last_name", "email", "phone", "city",
                        "country", "age", "registration_date", "loyalty_tier")
DIM_PRODUCT_COLUMNS = ("product_id", "product_name", "category", "price_usd", "cost_usd",
                       "stock_units", "supplier", "active")
FACT_COLUMNS = ("order_id", "customer_id", "product_id", "quantity", "unit_price_usd",
                "total_amount_usd", "discount_pct", "net_amount_usd", "order_date",
                "ship_date", "status", "payment_method", "credit_card_last4")

# Declared lengths of the text columns (VARCHAR(n)), checked by checks.too_long.
CUSTOMER_TEXT_LIMITS = {"first_name": 150, "last_name": 150, "email": 255, "phone": 50,
                        "city": 100, "country": 100, "loyalty_tier": 100}
PRODUCT_TEXT_LIMITS = {"product_name": 255, "category": 150, "supplier": 150, "active": 50}
FACT_TEXT_LIMITS = {"status": 100, "payment_method": 100, "credit_card_last4": 50}

_TYPES = {
    "age": "int",
    "stock_units": "int", "quantity": "int",
    "price_usd": "decimal(10,2)", "cost_usd": "decimal(10,2)",
    "unit_price_usd": "decimal(10,2)", "total_amount_usd": "decimal(10,2)",
    "discount_pct": "decimal(5,2)",
    "registration_date": "timestamp_ntz", "order_date": "timestamp_ntz",
    "ship_date": "timestamp_ntz",
}


_KEYS = ("customer_id", "product_id", "order_id")


def _typed(df: DataFrame, columns, key_type: str) -> DataFrame:
    """Select the declared columns in order, each cast to its declared type."""
    out = []
    for c in columns:
        t = key_type if c in _KEYS else _TYPES.get(c)
        out.append(F.col(c).cast(t).alias(c) if t else F.col(c))
    return df.select(*out)


def dim_customers(stg_customers: DataFrame, key_type: str = "int") -> DataFrame:
    return _typed(stg_customers, DIM_CUSTOMER_COLUMNS, key_type)


def dim_products(stg_products: DataFrame, key_type: str = "int") -> DataFrame:
    return _typed(stg_products, DIM_PRODUCT_COLUMNS, key_type)


def keep_existing(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``dim`` (an existence test)."""
    return df.join(dim.select(key), on=key, how="left_semi")


def with_net_amount(df: DataFrame) -> DataFrame:
    """C20: net amount after discount, exact DECIMAL(25,10)."""
    return df.withColumn("net_amount_usd",
                         R.net_amount("total_amount_usd", "discount_pct"))


def fact_sales(stg_orders: DataFrame, dim_c: DataFrame, dim_p: DataFrame, key_type: str = "int") -> DataFrame:
    """The sales fact: stage orders with a known customer and product, plus net amount.

    The customer test goes first: the country filter makes it the more
    selective one, so the product join sees fewer rows.
    """
    known = keep_existing(keep_existing(stg_orders, dim_c, "customer_id"), dim_p, "product_id")
    return _typed(with_net_amount(known), FACT_COLUMNS, key_type)
