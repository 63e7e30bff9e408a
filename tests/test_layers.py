"""End to end: CSV folder -> layers -> reports, twice, same answers."""

import os

from pyspark.sql import functions as F

from tests.conftest import SF001
from tidystar.plans.layers import ingest_folder, run_from_folder, run_layers
from tidystar.session import scratch_path
from tidystar.sources import driver_raw
from tidystar.sources.csv_folder import write_raw_csv


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_run_layers_from_csv_twice(spark):
    folder = scratch_path(spark, "csv-in")
    write_raw_csv(driver_raw.raw_customers(spark, SF001), os.path.join(folder, "customers.csv"))
    # products as a Latin-1 file with accented names: the run must detect and decode it
    accented = driver_raw.raw_products(spark, SF001).withColumn(
        "product_name", F.regexp_replace("product_name", "a", "á"))
    write_raw_csv(accented, os.path.join(folder, "Products.csv"), encoding="ISO-8859-1")
    write_raw_csv(driver_raw.raw_orders(spark, SF001), os.path.join(folder, "orders.csv"))
    n_orders = driver_raw.raw_orders(spark, SF001).count()
    answers = []
    out = scratch_path(spark, "layers")  # S10: the second run replaces the first in place
    for _ in range(2):
        steps = {}
        rep = run_from_folder(spark, folder, out, country="AMERICA",
                              on_step=lambda k, v: steps.__setitem__(k, v))
        assert set(steps) == {"ingest", "stage", "analytics", "checks", "protect"}
        answers.append((_rows(rep.top_customers), _rows(rep.revenue), _rows(rep.outliers)))
        raw_orders = spark.read.parquet(os.path.join(out, "raw", "raw_orders"))
        assert raw_orders.count() == n_orders == rep.counts["raw_orders"]["rows"]
        assert rep.counts["raw_orders"]["files"] >= 1
        assert set(rep.counts) == {"raw_customers", "raw_products", "raw_orders"}
        dim_p = spark.read.parquet(os.path.join(out, "protected/dim_products"))
        assert dim_p.filter(F.col("product_name").contains("Á")).count() > 0
        assert dim_p.filter(F.col("product_name").contains("\ufffd")).count() == 0
        prot = spark.read.parquet(os.path.join(out, "protected/dim_customers"))
        assert prot.filter(F.col("email").contains("@")).count() == 0
        cards = spark.read.parquet(os.path.join(out, "protected/fact_ventas"))
        assert cards.filter(~F.col("credit_card_last4").startswith("****")).count() == 0
        assert cards.filter((F.col("discount_pct") < 0) | (F.col("discount_pct") > 100)).count() == 0
    assert answers[0] == answers[1]
    assert len(answers[0][0]) == 3 and len(answers[0][1]) > 0


def test_ingest_folder_counts(spark):
    folder = scratch_path(spark, "csv-count")
    write_raw_csv(driver_raw.raw_products(spark, SF001), os.path.join(folder, "products.csv"))
    raw, counts = ingest_folder(spark, folder, scratch_path(spark, "raw-out"))
    assert set(raw) == {"products"}
    assert counts["raw_products"]["rows"] == raw["products"].count() == \
        driver_raw.raw_products(spark, SF001).count()


def test_dropped_rows_add_up(spark):
    raw = {"customers": driver_raw.raw_customers(spark, SF001), "products": driver_raw.raw_products(spark, SF001),
           "orders": driver_raw.raw_orders(spark, SF001)}
    out = scratch_path(spark, "layers-dropped")
    rep = run_layers(spark, raw, out, country="AMERICA", key_type="bigint")
    n = {(r["table_name"], r["rule"]): r["n_rows"] for r in rep.dropped.collect()}
    for table in raw:
        kept = spark.read.parquet(os.path.join(out, f"stg_{table}")).count()
        gone = sum(v for (t, rule), v in n.items() if t == table and not rule.startswith("unknown"))
        assert raw[table].count() == kept + gone
    assert all(v > 0 for v in n.values())


def test_ids_beyond_int_need_bigint(spark):
    from tidystar.functions import rules as R
    df = spark.createDataFrame([("3000000000",)], "k string")
    assert df.select(R.key_int("k").alias("a"), R.key_int("k", "bigint").alias("b")).first() == (None, 3_000_000_000)


def test_reports_are_lazy_and_plain(spark):
    """R1 is one plan over the fact (no collect, no distinct); R2 shuffles only grouped rows."""
    from tidystar.operators import reports
    fact = spark.createDataFrame([(i, i % 7, i % 5, 1, None) for i in range(50)],
                                 "order_id int, customer_id int, product_id int, total_amount_usd int, x int") \
        .withColumn("order_date", F.lit("2020-05-01 00:00:00").cast("timestamp_ntz"))
    dim_c = spark.createDataFrame([(i, f"n{i}", None) for i in range(7)], "customer_id int, first_name string, last_name string")
    dim_p = spark.createDataFrame([(i, "c") for i in range(5)], "product_id int, category string")
    groups = []
    spark.sparkContext.setJobGroup("lazy", "lazy")
    top = reports.top_customers_latest_quarter(fact, dim_c, keys_checked=True)
    groups = spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")
    assert not groups  # building the report runs nothing
    spark.sparkContext._jsc.clearJobGroup()
    assert [r["customer_id"] for r in top.collect()] == [0, 1, 2]
    # a busy hot product: the sum is the same with a forced merge join
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    usual = _rows(reports.revenue_by_month_category(fact, dim_p))
    try:
        for k in saved:
            spark.conf.set(k, "-1")
        forced = reports.revenue_by_month_category(fact, dim_p)
        assert _rows(forced) == usual
        assert "SortMergeJoin" in forced._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
