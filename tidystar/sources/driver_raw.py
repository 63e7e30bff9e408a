"""Raw inputs derived from the driver's TPC-H-like tables.

The reference reads three untidy CSV files (customers, products, orders) as
all-text tables. The driver's tables are clean and typed, so this module
rewrites them into those three raw shapes and adds deterministic dirt (quotes,
padding, mixed case, slashed and US dates, the word NULL, letters in numbers,
duplicated keys) chosen by key arithmetic. No row is dropped or sampled: every
customer, part and line item becomes a raw row. Every customer and part also
gets a second row: for some keys (chosen by key arithmetic) it is a real
duplicate with other values, for the rest its key is junk that the stage
drops. No input row is filtered out.

The dirt is written once as SQL expression text with a small dialect switch,
so Spark (``selectExpr``) and the DuckDB oracle build identical raw input;
the operators under test are written separately on each side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import load_table

RAW_CUSTOMER_COLUMNS = ("customer_id", "first_name", "last_name", "email", "phone", "city",
                        "country", "age", "registration_date", "loyalty_tier")
RAW_PRODUCT_COLUMNS = ("product_id", "product_name", "category", "price_usd", "cost_usd",
                       "stock_units", "supplier", "active")
RAW_ORDER_COLUMNS = ("order_id", "customer_id", "product_id", "unit_price_usd",
                     "total_amount_usd", "quantity", "order_date", "ship_date", "status",
                     "payment_method", "discount_pct", "credit_card_last4")

_SPARK_FMT = {"iso": "yyyy-MM-dd", "slash": "yyyy/MM/dd", "us": "MM/dd/yyyy",
              "compact": "yyyyMMdd", "named": "MMM d yyyy", "short": "M-d-yy"}
_DUCK_FMT = {"iso": "%Y-%m-%d", "slash": "%Y/%m/%d", "us": "%m/%d/%Y", "compact": "%Y%m%d",
             "named": "%b %-d %Y", "short": "%-m-%-d-%y"}


def _date_text(expr: str, style: str, dialect: str) -> str:
    if dialect == "spark":
        return f"date_format({expr}, '{_SPARK_FMT[style]}')"
    return f"strftime({expr}, '{_DUCK_FMT[style]}')"


def _plus_days(day: str, n_expr: str, dialect: str) -> str:
    if dialect == "spark":
        return f"date_add(DATE'{day}', CAST({n_expr} AS INT))"
    return f"(DATE '{day}' + CAST({n_expr} AS INTEGER))"


def _s(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _q(expr: str) -> str:
    return f"""('"' || {expr} || '"')"""


# Second rows whose key stays valid (real duplicates); the others get junk keys.
CUSTOMER_SECOND_KEEP = "c_custkey % 4 = 1"
PRODUCT_SECOND_KEEP = "p_partkey % 10 = 3"


def customer_exprs(dialect: str) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """(base copy, second copy) column expressions over customer/nation/region."""
    k = "c_custkey"
    s = _s(k)
    first = "split_part(c_name, '#', 1)"
    last = "split_part(c_name, '#', 2)"
    days = f"(({k} * 37) % 2900)"
    reg = _plus_days("2015-01-01", days, dialect)
    age = _s(f"(({k} * 7) % 140 - 10)")
    phone = f"('+1-' || lpad({_s(f'({k} * 7919) % 10000000')}, 7, '0'))"
    iso = _date_text(reg, "iso", dialect)
    base = [
        ("customer_id", f"""CASE WHEN {k} % 17 = 7 THEN 'C' || {s}
            WHEN {k} % 11 = 3 THEN {_q(s)}
            WHEN {k} % 13 = 5 AND {k} >= 10 THEN substr({s}, 1, 1) || ' ' || substr({s}, 2)
            WHEN {k} % 19 = 6 THEN ' ' || {s} || '  '
            ELSE {s} END"""),
        ("first_name", f"""CASE WHEN {k} % 50 = 13 OR {k} % 41 = 17 THEN NULL
            WHEN {k} % 7 = 1 THEN '  ' || lower({first}) || ' '
            WHEN {k} % 9 = 2 THEN {_q(first)}
            ELSE {first} END"""),
        ("last_name", f"""CASE WHEN {k} % 50 = 13 THEN NULL
            WHEN {k} % 11 = 3 THEN {_q(last)}
            ELSE {last} END"""),
        ("email", f"""CASE WHEN {k} % 50 = 13 OR {k} % 10 = 4 THEN NULL
            WHEN {k} % 23 = 6 THEN 'null'
            WHEN {k} % 29 = 8 THEN '   '
            ELSE ' Customer' || {s} || '@Mail.Example' END"""),
        ("phone", f"CASE WHEN {k} % 6 = 2 THEN {_q(phone)} || '  ' ELSE {phone} END"),
        ("city", f"CASE WHEN {k} % 4 = 3 THEN lower(n_name) ELSE n_name END"),
        ("country", f"""CASE WHEN {k} % 6 = 5 THEN '  ' || lower(r_name) || ' '
            WHEN {k} % 14 = 3 THEN {_q('r_name')}
            ELSE r_name END"""),
        ("age", f"""CASE WHEN {k} % 43 = 1 THEN NULL
            WHEN {k} % 19 = 4 THEN 'abc'
            WHEN {k} % 17 = 5 THEN {_q(age)}
            WHEN {k} % 23 = 9 THEN {age} || '.5'
            ELSE {age} END"""),
        ("registration_date", f"""CASE WHEN {k} % 31 = 7 THEN '2019-02-30'
            WHEN {k} % 37 = 11 THEN 'unknown'
            WHEN {k} % 29 = 1 THEN {iso} || ' 08:30'
            WHEN {k} % 29 = 2 THEN {iso} || ' 08:30:59.' || lpad({_s(f'({k} * 31) % 1000')}, 3, '0')
            WHEN {k} % 29 = 3 THEN {_date_text(reg, 'us', dialect)} || ' 10:30:00'
            WHEN {k} % 29 = 4 THEN {iso} || 'T08:30:00.5'
            WHEN {k} % 29 = 5 THEN {_date_text(reg, 'compact', dialect)} || ' 08:30:00'
            WHEN {k} % 29 = 6 THEN {_date_text(reg, 'named', dialect)}
            WHEN {k} % 29 = 7 THEN {_date_text(reg, 'short', dialect)} || ' 7:05'
            WHEN {k} % 29 = 8 THEN {iso} || chr(10)
            WHEN {k} % 29 = 9 THEN {iso} || 'T08:30'
            WHEN {k} % 8 = 6 THEN {_q(iso)}
            WHEN {k} % 5 = 0 THEN {iso}
            WHEN {k} % 5 = 1 THEN {_date_text(reg, 'slash', dialect)}
            WHEN {k} % 5 = 2 THEN {_date_text(reg, 'us', dialect)}
            WHEN {k} % 5 = 3 THEN {iso} || ' 08:30:' || lpad({_s(f'{k} % 60')}, 2, '0')
            ELSE {_date_text(reg, 'compact', dialect)} END"""),
        ("loyalty_tier", f"""CASE WHEN {k} % 25 = 4 THEN NULL
            WHEN {k} % 21 = 3 THEN ''
            WHEN {k} % 15 = 2 THEN 'null'
            WHEN {k} % 27 = 5 THEN ' "NULL" '
            WHEN {k} % 6 = 1 THEN ' ' || lower(c_mktsegment) || ' '
            ELSE c_mktsegment END"""),
    ]
    shifted = _plus_days("2015-01-01", f"{days} + CASE WHEN {k} % 3 = 0 THEN -200 ELSE 150 END",
                         dialect)
    second = [
        ("customer_id", f"""CASE WHEN NOT ({CUSTOMER_SECOND_KEEP}) THEN 'dup-' || {s}
            WHEN {k} % 3 = 2 THEN {_q(s)} ELSE {s} END"""),
        ("first_name", f"lower({first})"),
        ("last_name", last),
        ("email", f"'c' || {s} || '@old.example'"),
        ("phone", phone),
        ("city", "n_name"),
        ("country", f"CASE WHEN {k} % 3 = 0 THEN 'ASIA' ELSE lower(r_name) END"),
        ("age", _s(f"({k} * 11) % 100")),
        ("registration_date",
         f"CASE WHEN {k} % 20 = 9 THEN NULL ELSE {_date_text(shifted, 'iso', dialect)} END"),
        ("loyalty_tier", "'GOLD'"),
    ]
    return base, second



def product_exprs(dialect: str) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    k = "p_partkey"
    s = _s(k)
    price = _s("CAST(p_retailprice AS DECIMAL(12,2))")
    cost = _s("CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 0.6 AS DECIMAL(12,2))")
    stock = _s("p_size - 5")
    sup = f"('PROVEEDOR ' || chr(CAST(65 + {k} % 26 AS INTEGER)))"
    base = [
        ("product_id", f"""CASE WHEN {k} % 47 = 5 THEN 'P' || {s}
            WHEN {k} % 9 = 4 THEN {_q(s)}
            WHEN {k} % 13 = 6 THEN {s} || ' '
            WHEN {k} % 11 = 7 AND {k} >= 10 THEN substr({s}, 1, 1) || ' ' || substr({s}, 2)
            ELSE {s} END"""),
        ("product_name", f"""CASE WHEN {k} % 8 = 3 THEN {_q('p_name')}
            WHEN {k} % 5 = 2 THEN ' ' || upper(p_name)
            ELSE p_name END"""),
        ("category", f"CASE WHEN {k} % 6 = 4 THEN lower(p_type) || '  ' ELSE p_type END"),
        ("price_usd", f"""CASE WHEN {k} % 23 = 4 THEN NULL
            WHEN {k} % 13 = 1 THEN '-' || {price}
            WHEN {k} % 17 = 2 THEN 'abc'
            WHEN {k} % 19 = 3 THEN '1e3'
            WHEN {k} % 31 = 6 THEN '1,234.50'
            WHEN {k} % 37 = 8 THEN {price} || chr(10)
            WHEN {k} % 29 = 5 THEN {price} || '5'
            WHEN {k} % 7 = 6 THEN {_q(price)}
            ELSE {price} END"""),
        ("cost_usd", f"""CASE WHEN {k} % 14 = 3 THEN NULL
            WHEN {k} % 11 = 2 THEN '-1.00'
            ELSE {cost} END"""),
        ("stock_units", f"""CASE WHEN {k} % 8 = 2 THEN 'x' || {stock}
            WHEN {k} % 12 = 5 THEN {_q(stock)}
            WHEN {k} % 21 = 4 THEN {stock} || chr(10)
            ELSE {stock} END"""),
        ("supplier", f"""CASE WHEN {k} % 13 = 4 THEN NULL
            WHEN {k} % 9 = 2 THEN 'PROVEEDOR ' || {_s(f'{k} % 10')}
            WHEN {k} % 11 = 3 THEN 'PROVEEDOR AB'
            WHEN {k} % 15 = 5 THEN ' "proveedor x" '
            WHEN {k} % 17 = 6 THEN {sup} || chr(10)
            WHEN {k} % 7 = 1 THEN lower({sup})
            ELSE {sup} END"""),
        ("active", f"""CASE {k} % 8 WHEN 0 THEN '1' WHEN 1 THEN 'true' WHEN 2 THEN 'Activo'
            WHEN 3 THEN 'yes' WHEN 4 THEN '0' WHEN 5 THEN 'no' WHEN 6 THEN NULL
            ELSE ' ACTIVO ' END"""),
    ]
    second = [
        ("product_id", f"CASE WHEN {PRODUCT_SECOND_KEEP} THEN {s} ELSE 'dup-' || {s} END"),
        ("product_name", "lower(p_name)"),
        ("category", "p_type"),
        ("price_usd", _s("CAST(CAST(p_retailprice AS DECIMAL(12,2)) + 1 AS DECIMAL(12,2))")),
        ("cost_usd", cost),
        ("stock_units", _s("p_size")),
        ("supplier", "'PROVEEDOR Z'"),
        ("active", "'no'"),
    ]
    return base, second



def order_exprs(dialect: str) -> list[tuple[str, str]]:
    k = "(l_orderkey * 10 + l_linenumber)"
    s = _s(k)
    cs = _s("o_custkey")
    ps = _s("l_partkey")
    unit = _s("CAST(l_extendedprice AS DECIMAL(12,2))")
    total = _s("CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_quantity AS DECIMAL(12,2))"
               " AS DECIMAL(14,2))")
    qty = _s("CAST(l_quantity AS INT)")
    disc = _s("CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS DECIMAL(5,2))")
    last4 = f"lpad({_s('(l_orderkey * 7919 + l_linenumber) % 10000')}, 4, '0')"
    o_iso = _date_text("o_orderdate", "iso", dialect)
    return [
        ("order_id", f"""CASE WHEN {k} % 97 = 5 THEN 'X' || {s}
            WHEN {k} % 17 = 3 THEN {_q(s)}
            WHEN {k} % 19 = 4 THEN ' ' || {s}
            WHEN {k} % 101 = 9 THEN {s} || chr(10)
            ELSE {s} END"""),
        ("customer_id", f"""CASE WHEN {k} % 13 = 2 THEN {_q(cs)}
            WHEN {k} % 11 = 5 AND o_custkey >= 10 THEN substr({cs}, 1, 1) || ' ' || substr({cs}, 2)
            ELSE {cs} END"""),
        ("product_id", f"CASE WHEN {k} % 29 = 1 THEN {_q(ps)} ELSE {ps} END"),
        ("unit_price_usd", f"""CASE WHEN {k} % 23 = 2 THEN NULL
            WHEN {k} % 31 = 3 THEN '0'
            WHEN {k} % 37 = 4 THEN 'abc'
            ELSE {unit} END"""),
        ("total_amount_usd", f"""CASE WHEN {k} % 41 = 6 THEN NULL
            WHEN {k} % 43 = 7 THEN '-' || {total}
            ELSE {total} END"""),
        ("quantity", f"""CASE WHEN {k} % 10 = 1 THEN NULL
            WHEN {k} % 9 = 0 THEN '0'
            WHEN {k} % 11 = 2 THEN {qty} || '.0'
            WHEN {k} % 13 = 3 THEN '-1'
            WHEN {k} % 14 = 4 THEN {_q(qty)}
            ELSE {qty} END"""),
        ("order_date", f"""CASE WHEN {k} % 59 = 8 THEN NULL
            WHEN {k} % 53 = 7 THEN '2000-02-30'
            WHEN {k} % 5 = 0 THEN {o_iso}
            WHEN {k} % 5 = 1 THEN {_date_text('o_orderdate', 'slash', dialect)}
            WHEN {k} % 5 = 2 THEN {_date_text('o_orderdate', 'us', dialect)}
            WHEN {k} % 5 = 3 THEN {_q(o_iso)}
            ELSE {_date_text('o_orderdate', 'compact', dialect)} END"""),
        ("ship_date", f"""CASE WHEN {k} % 61 = 9 THEN NULL
            WHEN {k} % 2 = 0 THEN {_date_text('l_shipdate', 'iso', dialect)}
            ELSE {_date_text('l_shipdate', 'slash', dialect)} END"""),
        ("status", f"""CASE WHEN {k} % 25 = 4 THEN NULL
            WHEN {k} % 21 = 3 THEN ''
            WHEN {k} % 15 = 2 THEN 'null'
            WHEN {k} % 6 = 1 THEN lower(o_orderstatus) || ' '
            ELSE o_orderstatus END"""),
        ("payment_method", f"""CASE WHEN {k} % 27 = 6 THEN NULL
            WHEN {k} % 18 = 5 THEN 'NULL'
            WHEN {k} % 4 = 0 THEN 'card'
            WHEN {k} % 4 = 1 THEN 'CASH'
            WHEN {k} % 4 = 2 THEN 'Transfer'
            ELSE ' "wallet" ' END"""),
        ("discount_pct", f"""CASE WHEN {k} % 31 = 5 THEN NULL
            WHEN {k} % 17 = 1 THEN '-5'
            WHEN {k} % 19 = 2 THEN '150'
            WHEN {k} % 23 = 3 THEN '1000'
            WHEN {k} % 29 = 4 THEN 'abc'
            WHEN {k} % 37 = 6 THEN '100.01'
            ELSE {disc} END"""),
        ("credit_card_last4", f"""CASE WHEN {k} % 13 = 4 THEN NULL
            WHEN {k} % 17 = 5 THEN 'null'
            WHEN {k} % 19 = 6 THEN '   '
            WHEN {k} % 7 = 2 THEN '4111111111' || {last4}
            WHEN {k} % 11 = 3 THEN substr({last4}, 4, 1)
            WHEN {k} % 23 = 7 THEN ' ' || {last4} || ' '
            ELSE {last4} END"""),
    ]


def _select(df: DataFrame, exprs: list[tuple[str, str]]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {name}" for name, e in exprs])


def _two_rows(df: DataFrame, base: list[tuple[str, str]], second: list[tuple[str, str]]) -> DataFrame:
    """Both copies of every source row from one scan."""
    copies = [f"named_struct({', '.join(f"'{name}', CAST({e} AS STRING)" for name, e in exprs)})"
              for exprs in (base, second)]
    return df.selectExpr(f"inline(array({', '.join(copies)}))")


def raw_customers(spark: SparkSession, base_dir: str) -> DataFrame:
    """customer x nation x region -> raw customers (all text), two rows per customer."""
    nation = load_table(spark, base_dir, "nation")
    region = load_table(spark, base_dir, "region")
    src = (load_table(spark, base_dir, "customer")
           .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
           .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    return _two_rows(src, *customer_exprs("spark"))


def raw_products(spark: SparkSession, base_dir: str) -> DataFrame:
    """part -> raw products (all text), two rows per part."""
    return _two_rows(load_table(spark, base_dir, "part"), *product_exprs("spark"))


def raw_orders(spark: SparkSession, base_dir: str) -> DataFrame:
    """lineitem x orders -> raw order lines (all text); natural duplicate ids stay."""
    src = load_table(spark, base_dir, "lineitem").join(
        load_table(spark, base_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return _select(src, order_exprs("spark"))


# --- order dates whose sources write them in different orders (C6, N4) --------------
# One source per priority: month first, day first, day first with short years, a source
# whose days never exceed 12, and one that mixes both. Valid in Spark and DuckDB.
_TWO = "lpad(CAST({} AS STRING), 2, '0')"
_DAY, _MONTH, _YEAR = _TWO.format("day(o_orderdate)"), _TWO.format("month(o_orderdate)"), "CAST(year(o_orderdate) AS STRING)"
ORDER_DATE_TEXT = f"""CASE o_orderpriority
    WHEN '1-URGENT' THEN {_MONTH} || '/' || {_DAY} || '/' || {_YEAR}
    WHEN '2-HIGH' THEN {_DAY} || '/' || {_MONTH} || '/' || {_YEAR}
    WHEN '3-MEDIUM' THEN '"' || {_DAY} || '-' || {_MONTH} || '-' || substr({_YEAR}, 3, 2) || '"'
    WHEN '4-NOT SPECIFIED' THEN {_TWO.format("(day(o_orderdate) - 1) % 12 + 1")} || '/' || {_MONTH} || '/' || {_YEAR}
    ELSE CASE WHEN o_orderkey % 2 = 0 THEN {_DAY} || '/' || {_MONTH} ELSE {_MONTH} || '/' || {_DAY} END || '/' || {_YEAR} END"""


def raw_order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """o_orderkey, source, order_date (text) of every order."""
    return load_table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_orderpriority AS source", f"{ORDER_DATE_TEXT} AS order_date")
