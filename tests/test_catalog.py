"""Catalog tables: bucketed joins, declared sizes and defaults, a computed column, case-blind text."""
import glob
import uuid
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from tidystar.operators.model import keep_existing
from tidystar.session import scratch_path
from tidystar.sources import catalog


@pytest.fixture()
def names(spark):
    found = [f"t_{uuid.uuid4().hex[:10]}" for _ in range(3)]
    yield found
    for name in found:
        catalog.drop(spark, name)


def plan_of(df, capsys):
    df.explain()
    return capsys.readouterr().out


def test_joins_of_bucketed_tables_need_no_exchange(spark, names, capsys):
    orders = spark.range(5000).select("id", (F.col("id") % 700).alias("customer_id"))
    customers = spark.range(600).select(F.col("id").alias("customer_id"), F.lit("x").alias("city"))
    catalog.save_bucketed(orders, names[0], "customer_id", 4, scratch_path(spark, "b"))
    catalog.save_bucketed(customers, names[1], "customer_id", 4, scratch_path(spark, "b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        known = keep_existing(spark.table(names[0]), spark.table(names[1]), "customer_id")
        named = spark.table(names[0]).join(spark.table(names[1]), "customer_id").groupBy("customer_id").count()
        for found in (known, named):
            plan = plan_of(found, capsys)
            assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
        assert known.count() == orders.where("customer_id < 600").count() and named.count() == 600
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_an_over_long_value_fails_the_write(spark, names):
    columns = ["id INT", "city VARCHAR(5)", "tier STRING DEFAULT 'none'", catalog.LOAD_STAMP]
    catalog.declare(spark, names[0], columns, scratch_path(spark, "d"))
    catalog.insert(spark.createDataFrame([(1, "lima"), (2, None), (3, "")], "id int, city string"), names[0])
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        catalog.insert(spark.createDataFrame([(4, "bogota")], "id int, city string"), names[0])
    rows = spark.table(names[0]).orderBy("id").collect()
    assert [(r["id"], r["city"], r["tier"]) for r in rows] == [(1, "lima", "none"), (2, None, "none"), (3, "", "none")]
    assert all(r["fecha_carga"] is not None for r in rows)


def test_the_computed_column_is_not_in_the_files(spark, names):
    path = scratch_path(spark, "v")
    spark.sql("SELECT 1 AS order_id, CAST(200 AS DECIMAL(10,2)) AS total_amount_usd, CAST(25 AS DECIMAL(5,2)) AS discount_pct") \
        .write.format("parquet").option("path", path).saveAsTable(names[0])
    assert glob.glob(f"{urlparse(path).path}/*.parquet")
    assert "net_amount_usd" not in spark.read.parquet(path).columns
    assert [float(r["net_amount_usd"]) for r in catalog.net_amount_view(spark, names[0], names[1] + "_view").collect()] == [150.0]


def test_text_is_compared_and_grouped_without_case(spark):
    df = spark.createDataFrame([("Abc",), ("ABC",), ("abd",), (None,)], "a string")
    blind = df.select(catalog.case_blind("a").alias("a"))
    assert {r["count"] for r in blind.where("a IS NOT NULL").groupBy("a").count().collect()} == {2, 1}
    assert df.where(catalog.case_blind("a") == "aBc").count() == 2
