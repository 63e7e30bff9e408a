"""Raw -> stage: clean, repair, deduplicate and filter.

Each ``clean_*`` is a pure projection of the rules (one narrow stage, no
shuffle). Each ``stage_*`` adds the one shuffle the layer needs: the dedup
window on the table key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from .dedup import RN, first_per_key_flag, keep_first

# --- Fixed values (must equal the reference's for the same results) ---------
DEFAULT_COUNTRY = "COLOMBIA"
# -----------------------------------------------------------------------------

CUSTOMER_COLUMNS = ("customer_id", "first_name", "last_name", "email", "phone", "city",
                    "country", "age", "registration_date", "loyalty_tier")
PRODUCT_COLUMNS = ("product_id", "product_name", "category", "price_usd", "cost_usd",
                   "stock_units", "supplier", "active")
ORDER_COLUMNS = ("order_id", "customer_id", "product_id", "quantity", "unit_price_usd",
                 "total_amount_usd", "order_date", "ship_date", "status", "payment_method",
                 "discount_pct", "credit_card_last4")


def clean_customers(raw: DataFrame, key_type: str = "int") -> DataFrame:
    """Typed, cleaned customers, one row per raw row."""
    return raw.select(
        R.key_int("customer_id", key_type).alias("customer_id"),
        R.clean_text("first_name").alias("first_name"),
        R.clean_text("last_name").alias("last_name"),
        R.clean_text("email").alias("email"),
        R.clean_text("phone", upper=False).alias("phone"),
        R.clean_text("city").alias("city"),
        R.clean_text("country").alias("country"),
        R.null_outside(R.safe_int("age"), 0, 120).alias("age"),
        R.safe_timestamp("registration_date").alias("registration_date"),
        R.label_or_default("loyalty_tier").alias("loyalty_tier"),
    )


def clean_products(raw: DataFrame, key_type: str = "int") -> DataFrame:
    money = "decimal(10,2)"
    return raw.select(
        R.key_int("product_id", key_type).alias("product_id"),
        R.clean_text("product_name").alias("product_name"),
        R.clean_text("category").alias("category"),
        R.floor_zero(R.safe_decimal("price_usd", 10, 2), 0, money).alias("price_usd"),
        R.floor_zero(R.safe_decimal("cost_usd", 10, 2), 0, money).alias("cost_usd"),
        R.floor_zero(R.safe_int("stock_units"), 0, "int").alias("stock_units"),
        R.match_or_default("supplier").alias("supplier"),
        R.flag("active").alias("active"),
    )


def clean_orders(raw: DataFrame, key_type: str = "int") -> DataFrame:
    """Typed, cleaned order lines; quantity repaired (C13), ship date not yet checked."""
    unit = R.safe_decimal("unit_price_usd", 10, 2)
    total = R.safe_decimal("total_amount_usd", 10, 2)
    return raw.select(
        R.key_int("order_id", key_type).alias("order_id"),
        R.key_int("customer_id", key_type).alias("customer_id"),
        R.key_int("product_id", key_type).alias("product_id"),
        R.ratio_if_invalid(R.safe_int("quantity"), total, unit).alias("quantity"),
        unit.alias("unit_price_usd"),
        total.alias("total_amount_usd"),
        R.safe_timestamp("order_date").alias("order_date"),
        R.safe_timestamp("ship_date").alias("ship_date"),
        R.label_or_default("status").alias("status"),
        R.label_or_default("payment_method").alias("payment_method"),
        R.clamp(R.safe_decimal("discount_pct", 5, 2), 0, 100, "decimal(5,2)").alias("discount_pct"),
        R.clean_text("credit_card_last4", upper=False).alias("credit_card_last4"),
    )


def stage_customers(raw: DataFrame, country: str = DEFAULT_COUNTRY, key_type: str = "int") -> DataFrame:
    """Oldest row per customer, then the country and not-all-empty filters.

    The order of steps is the reference's: deduplicate over all countries
    first, filter after, so a customer whose oldest row is elsewhere drops
    out. An undated row sorts first, as in the reference's ascending order.
    """
    cleaned = clean_customers(raw, key_type).filter(F.col("customer_id").isNotNull())
    ties = [c for c in CUSTOMER_COLUMNS if c not in ("customer_id", "registration_date")]
    flagged = first_per_key_flag(cleaned, ["customer_id"],
                                 [F.col("registration_date").asc_nulls_first()], ties)
    keep = ((F.col(RN) == 1) & (F.col("country") == F.lit(country))
            & F.coalesce("first_name", "last_name", "email").isNotNull())
    return flagged.filter(keep).drop(RN)


def oldest_customer_rows(raw: DataFrame, key_type: str = "int") -> DataFrame:
    """W1 alone: the oldest row per customer over every country."""
    ties = [c for c in CUSTOMER_COLUMNS if c not in ("customer_id", "registration_date")]
    return keep_first(clean_customers(raw, key_type), ["customer_id"],
                      [F.col("registration_date").asc_nulls_first()], ties)


def stage_products(raw: DataFrame, key_type: str = "int") -> DataFrame:
    """One row per product (W2): any row in the reference; here the first by all columns."""
    ties = [c for c in PRODUCT_COLUMNS if c != "product_id"]
    return keep_first(clean_products(raw, key_type), ["product_id"], (), ties)


def stage_orders(raw: DataFrame, key_type: str = "int") -> DataFrame:
    """One row per order id (W2), then the ship-date rule (C14)."""
    ties = [c for c in ORDER_COLUMNS if c != "order_id"]
    first = keep_first(clean_orders(raw, key_type), ["order_id"], (), ties)
    return first.withColumn("ship_date", R.null_if_before("ship_date", "order_date"))
