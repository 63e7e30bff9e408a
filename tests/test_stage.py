"""Dedup, stage, model and checks on hand-made raw rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidystar.operators import checks, model, reports, stage
from tidystar.plans.layers import run_layers
from tidystar.session import scratch_path
from tidystar.sources.driver_raw import RAW_CUSTOMER_COLUMNS, RAW_ORDER_COLUMNS, \
    RAW_PRODUCT_COLUMNS


def raw(spark, columns, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


def cust(cid, reg, country, first="ANA", last="LOPEZ", email="a@b.co"):
    return (cid, first, last, email, "1", "BOGOTA", country, "30", reg, "oro")


def test_dedup_before_country_filter(spark):
    rows = [cust("1", "2020-01-01", "PERU"), cust("1", "2021-01-01", "COLOMBIA"),
            cust("2", None, "colombia"), cust("2", "2020-01-01", "COLOMBIA", first="X"),
            cust("3", "2020-01-01", "COLOMBIA", first=None, last=None, email=None),
            cust(" 4 ", "2020-01-01", '"Colombia"'), cust("x5", "2020-01-01", "COLOMBIA")]
    out = stage.stage_customers(raw(spark, RAW_CUSTOMER_COLUMNS, rows)).orderBy("customer_id")
    got = [(r.customer_id, r.first_name, r.registration_date) for r in out.collect()]
    # 1: oldest row is PERU -> gone (N5); 2: undated row sorts first and wins;
    # 3: all of first/last/email empty -> dropped (C17); x5: bad key -> dropped
    assert got == [(2, "ANA", None), (4, "ANA", dt.datetime(2020, 1, 1))]


def test_dedup_is_order_and_partition_independent(spark):
    rows = [cust(str(i % 7), f"2020-01-{1 + i % 5:02d}", "COLOMBIA", first=f"N{i}")
            for i in range(60)]
    df = raw(spark, RAW_CUSTOMER_COLUMNS, rows)
    a = stage.stage_customers(df).collect()
    b = stage.stage_customers(df.repartition(7).orderBy(F.rand(3))).collect()
    assert sorted(a) == sorted(b)
    assert len({r.customer_id for r in a}) == len(a) == 7


def test_stage_products_one_per_key(spark):
    rows = [("1", "a", "c", "5", "1", "3", "proveedor b", "1"),
            ("1", "a", "c", "4", "1", "3", "proveedor b", "1"),
            ('"2"', "b", "c", "-1", "x", "-3", "PROVEEDOR 9", "no"),
            (None, "z", "c", "1", "1", "1", "PROVEEDOR A", "1")]
    out = stage.stage_products(raw(spark, RAW_PRODUCT_COLUMNS, rows)).orderBy("product_id")
    got = [(r.product_id, str(r.price_usd), str(r.cost_usd), r.stock_units, r.supplier, r.active)
           for r in out.collect()]
    assert got == [(1, "4.00", "1.00", 3, "PROVEEDOR B", "ACTIVO"),
                   (2, "0.00", "0.00", 0, "NO DETERMINADO", "INACTIVO")]


def order(oid, cid, pid, order_date="2023-01-02", ship="2023-01-01", total="10", qty="1"):
    return (oid, cid, pid, "10", total, qty, order_date, ship, "ok", "card", "5", "1234")


def test_fact_keeps_known_keys_and_checks(spark):
    dim_c = model.dim_customers(stage.stage_customers(raw(spark, RAW_CUSTOMER_COLUMNS, [
        cust("1", "2020-01-01", "COLOMBIA"), cust("2", "2020-01-01", "PERU")])))
    dim_p = model.dim_products(stage.stage_products(raw(spark, RAW_PRODUCT_COLUMNS, [
        ("7", "a", "c", "5", "1", "3", "proveedor b", "1")])))
    stg_o = stage.stage_orders(raw(spark, RAW_ORDER_COLUMNS, [
        order("10", "1", "7"), order("10", "1", "7", total="99"), order("11", "2", "7"),
        order("12", "1", "8"), order("13", None, "7")]))
    fact = model.fact_sales(stg_o, dim_c, dim_p)
    rows = fact.collect()
    assert [(r.order_id, str(r.total_amount_usd), r.ship_date) for r in rows] == [
        (10, "10.00", None)]  # ship before order -> NULL (C14)
    assert str(rows[0].net_amount_usd) == "9.5000000000"
    assert checks.orphans(fact, dim_c, "customer_id").count() == 0
    assert sorted(r.order_id for r in checks.orphans(stg_o, dim_c, "customer_id").collect()) \
        == [11]
    assert checks.duplicate_keys(dim_c, "customer_id").count() == 0
    dups = checks.duplicate_keys(stage.clean_orders(raw(spark, RAW_ORDER_COLUMNS, [
        order("10", "1", "7"), order("10", "1", "7"), order(None, "1", "7")])), "order_id")
    assert sorted((r.order_id, r.n_rows) for r in dups.collect()
                  if r.order_id is not None) == [(10, 2)]


def test_too_long(spark):
    df = spark.createDataFrame([(1, "x" * 6, "ok"), (2, "abc", "toolong")],
                               "k int, a string, b string")
    got = sorted(tuple(r) for r in checks.too_long(df, "k", {"a": 5, "b": 5}).collect())
    assert got == [(1, "a", 6), (2, "b", 7)]


def test_reports_edge_cases(spark):
    d = dt.datetime
    fact = spark.createDataFrame(
        [(1, 1, d(2023, 8, 1)), (2, 1, d(2023, 7, 1)), (3, 2, d(2023, 6, 30)),
         (4, 3, d(2023, 9, 2))],
        "order_id int, customer_id int, order_date timestamp_ntz") \
        .withColumn("total_amount_usd", F.lit(5).cast("decimal(10,2)"))
    dim_c = spark.createDataFrame([(1, None, "X"), (2, "B", "B"), (3, "C", None)],
                                  "customer_id int, first_name string, last_name string")
    top = reports.top_customers_latest_quarter(fact, dim_c).collect()
    # quarter of 2023-09-02 starts 2023-07-01; order 3 (June) is outside
    assert [(r.customer_id, r.nombre_completo, r.cantidad_pedidos) for r in top] == [
        (1, " X", 2), (3, "C ", 1)]
    top_c = reports.top_customers_latest_quarter(fact, dim_c, keys_checked=True).collect()
    assert [tuple(r) for r in top_c] == [tuple(r) for r in top]
    empty = fact.filter(F.lit(False))
    assert reports.top_customers_latest_quarter(empty, dim_c, keys_checked=True).count() == 0
    # all totals equal: deviation 0 -> z NULL -> no outliers
    assert reports.zscore_outliers(fact).count() == 0


def test_run_layers_rejects_overlong_text(spark):
    long_name = "X" * 151  # first_name is VARCHAR(150)
    raw_c = raw(spark, RAW_CUSTOMER_COLUMNS,
                [cust("1", "2020-01-01", "COLOMBIA", first=long_name)])
    raw_p = raw(spark, RAW_PRODUCT_COLUMNS, [("7", "a", "c", "5", "1", "3", "proveedor b", "1")])
    raw_o = raw(spark, RAW_ORDER_COLUMNS, [order("10", "1", "7")])
    with pytest.raises(ValueError, match="dim_customers primary key / text lengths"):
        run_layers(spark, {"customers": raw_c, "products": raw_p, "orders": raw_o},
                   scratch_path(spark, "too-long"))


def test_key_and_length_violations(spark):
    df = spark.createDataFrame([(1, "ok"), (1, "ok"), (2, "x" * 9), (3, "ok"), (None, "ok")],
                               "k int, a string")
    got = sorted((r.k if r.k is not None else -1, r.n_rows)
                 for r in checks.key_and_length_violations(df, "k", {"a": 5}).collect())
    assert got == [(-1, 1), (1, 2), (2, 1)]
