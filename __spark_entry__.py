"""

``entry(spark)`` runs the flagship query (revenue by year, month and
category) on sf0.001. ``queries()`` holds one callable per operator of
``oracle_sql()`` holds the DuckDB statement for the same key.

The driver tables are mapped to the reference's three raw inputs by
``tidystar.sources.driver_raw``; the country kept by the stage is the
region name ``AMERICA`` (the reference fixes ``COLOMBIA``; it is a
parameter of ``stage_customers``).
"""

from __future__ import annotations

import importlib
import importlib.util
import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidystar.functions import privacy as P  # noqa: E402
from tidystar.functions import rules as R  # noqa: E402
from tidystar.operators import checks, date_order, distinct, model, moments, protect, ranges, reports, stage  # noqa: E402
from tidystar.plans.layers import build_layers, ingest_folder, run_layers  # noqa: E402
from tidystar.plans.publish import read_published, run_published  # noqa: E402
from tidystar.session import scratch_path  # noqa: E402
from tidystar.sources import catalog, driver_raw, versions  # noqa: E402
from tidystar.sources.csv_folder import write_raw_csv  # noqa: E402
from tidystar.sources.tables import read_layer  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
COUNTRY = "AMERICA"
# order ids are l_orderkey * 10 + l_linenumber, which outgrows INT
KEY_TYPE = "bigint"


def _raw(spark: SparkSession, sf_dir: str):
    return (driver_raw.raw_customers(spark, sf_dir), driver_raw.raw_products(spark, sf_dir),
            driver_raw.raw_orders(spark, sf_dir))


def _layers(spark: SparkSession, sf_dir: str):
    return build_layers(*_raw(spark, sf_dir), country=COUNTRY, key_type=KEY_TYPE)


def entry(spark: SparkSession) -> DataFrame:
    return q_report_revenue_by_month_category(spark, SMOKE_DIR)


# --- written runs ----------------------------------------------------------------
# Some queries read tables that Spark writes from the driver tables. A run is
# written once per application and state of the input folder, under the shared
# scratch folder.
_RUNS: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make):
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(sf_dir) \
        .agg(F.count("path"), F.sum("length"), F.max("modificationTime"),
             F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()
    key = (spark.sparkContext.applicationId, sf_dir, name, tuple(listing))
    if key not in _RUNS:
        _RUNS[key] = make()
    return _RUNS[key]


# --- ingest (S1-S5, S13) -------------------------------------------------------
def _accented(column: str):
    return F.replace(F.col(column), F.lit("a"), F.lit("\u00e1"))


def _ingested(spark, sf_dir):
    """The three raw inputs written as CSV folders and ingested: (raw tables, counts).

    Customers and products carry accents. The products are part files of two
    encodings, whose columns stand in different orders.
    """
    def make():
        folder, out = scratch_path(spark, "ingest"), scratch_path(spark, "raw-layer")
        customers, products, orders = _raw(spark, sf_dir)
        write_raw_csv(customers.withColumn("city", _accented("city")), os.path.join(folder, "Customers.csv"))
        products = products.withColumn("product_name", _accented("product_name"))
        even = F.coalesce(F.length("product_name") % 2 == 0, F.lit(False))
        write_raw_csv(products.where(even), os.path.join(folder, "Products.csv", "utf8"))
        write_raw_csv(products.where(~even).select(*reversed(products.columns)),
                      os.path.join(folder, "Products.csv", "latin"), encoding="ISO-8859-1")
        write_raw_csv(orders, os.path.join(folder, "orders.csv"))
        return ingest_folder(spark, folder, out)

    return _once(spark, sf_dir, "ingest", make)


def q_ingest_raw_csv(spark, sf_dir):
    return _ingested(spark, sf_dir)[0]["customers"]


def q_ingest_raw_products(spark, sf_dir):
    return _ingested(spark, sf_dir)[0]["products"]


def q_ingest_raw_orders(spark, sf_dir):
    return _ingested(spark, sf_dir)[0]["orders"]


def q_ingest_counts(spark, sf_dir):
    """Files and rows that the ingest reported, beside what its raw layer holds."""
    raw, counts = _ingested(spark, sf_dir)
    rows = None
    for name, df in raw.items():
        told = counts[f"raw_{name}"]
        part = df.agg(F.count(F.lit(1)).alias("held")).select(
            F.lit(f"raw_{name}").alias("table_name"), F.lit(told["files"] > 0).alias("has_files"),
            F.when(F.col("held") == told["rows"], F.col("held")).alias("n_rows"))
        rows = part if rows is None else rows.union(part)
    return rows


# --- rules (C1-C14, C20) -------------------------------------------------------
def q_rule_clean_text(spark, sf_dir):
    raw = driver_raw.raw_customers(spark, sf_dir)
    return raw.select(F.col("customer_id").alias("customer_id_raw"),
                      R.clean_text("first_name").alias("first_name"),
                      R.clean_text("last_name").alias("last_name"),
                      R.clean_text("email").alias("email"),
                      R.clean_text("phone", upper=False).alias("phone"),
                      R.clean_text("city").alias("city"),
                      R.clean_text("country").alias("country"))


def q_rule_key_int(spark, sf_dir):
    raw = driver_raw.raw_orders(spark, sf_dir)
    return raw.select(F.col("order_id").alias("order_id_raw"),
                      R.key_int("order_id").alias("order_id"),
                      R.key_int("customer_id").alias("customer_id"),
                      R.key_int("product_id").alias("product_id"))


def q_rule_safe_int(spark, sf_dir):
    raw = driver_raw.raw_products(spark, sf_dir)
    return raw.select(F.col("product_id").alias("product_id_raw"),
                      F.col("stock_units").alias("stock_units_raw"),
                      R.safe_int("stock_units").alias("stock_units"))


def q_rule_safe_decimal(spark, sf_dir):
    raw = driver_raw.raw_products(spark, sf_dir)
    return raw.select(F.col("product_id").alias("product_id_raw"),
                      F.col("price_usd").alias("price_usd_raw"),
                      R.safe_decimal("price_usd", 10, 2).alias("price_usd"),
                      R.safe_decimal("cost_usd", 10, 2).alias("cost_usd"))


def q_rule_safe_timestamp(spark, sf_dir):
    raw = driver_raw.raw_customers(spark, sf_dir)
    return raw.select(F.col("customer_id").alias("customer_id_raw"),
                      F.col("registration_date").alias("registration_date_raw"),
                      R.safe_timestamp("registration_date").alias("registration_date"))


def q_rule_null_outside(spark, sf_dir):
    raw = driver_raw.raw_customers(spark, sf_dir)
    return raw.select(F.col("customer_id").alias("customer_id_raw"),
                      F.col("age").alias("age_raw"),
                      R.null_outside(R.safe_int("age"), 0, 120).alias("age"))


def q_rule_floor_zero(spark, sf_dir):
    raw = driver_raw.raw_products(spark, sf_dir)
    money = "decimal(10,2)"
    return raw.select(
        F.col("product_id").alias("product_id_raw"),
        R.floor_zero(R.safe_decimal("price_usd", 10, 2), 0, money).alias("price_usd"),
        R.floor_zero(R.safe_decimal("cost_usd", 10, 2), 0, money).alias("cost_usd"),
        R.floor_zero(R.safe_int("stock_units"), 0, "int").alias("stock_units"))


def q_rule_clamp(spark, sf_dir):
    raw = driver_raw.raw_orders(spark, sf_dir)
    return raw.select(F.col("order_id").alias("order_id_raw"),
                      F.col("discount_pct").alias("discount_pct_raw"),
                      R.clamp(R.safe_decimal("discount_pct", 5, 2), 0, 100,
                              "decimal(5,2)").alias("discount_pct"))


def q_rule_label_or_default(spark, sf_dir):
    raw = driver_raw.raw_orders(spark, sf_dir)
    return raw.select(F.col("order_id").alias("order_id_raw"),
                      R.label_or_default("status").alias("status"),
                      R.label_or_default("payment_method").alias("payment_method"))


def q_rule_match_or_default(spark, sf_dir):
    raw = driver_raw.raw_products(spark, sf_dir)
    return raw.select(F.col("product_id").alias("product_id_raw"),
                      F.col("supplier").alias("supplier_raw"),
                      R.match_or_default("supplier").alias("supplier"))


def q_rule_flag(spark, sf_dir):
    raw = driver_raw.raw_products(spark, sf_dir)
    return raw.select(F.col("product_id").alias("product_id_raw"),
                      F.col("active").alias("active_raw"),
                      R.flag("active").alias("active"))


def q_rule_ratio_if_invalid(spark, sf_dir):
    raw = driver_raw.raw_orders(spark, sf_dir)
    unit = R.safe_decimal("unit_price_usd", 10, 2)
    total = R.safe_decimal("total_amount_usd", 10, 2)
    return raw.select(F.col("order_id").alias("order_id_raw"),
                      F.col("quantity").alias("quantity_raw"),
                      R.ratio_if_invalid(R.safe_int("quantity"), total, unit).alias("quantity"))


def q_rule_null_if_before(spark, sf_dir):
    raw = driver_raw.raw_orders(spark, sf_dir)
    order_date = R.safe_timestamp("order_date")
    return raw.select(F.col("order_id").alias("order_id_raw"),
                      order_date.alias("order_date"),
                      R.null_if_before(R.safe_timestamp("ship_date"), order_date).alias("ship_date"))


def q_rule_net_amount(spark, sf_dir):
    stg = stage.stage_orders(driver_raw.raw_orders(spark, sf_dir), KEY_TYPE)
    return stg.select("order_id", "total_amount_usd", "discount_pct",
                      R.net_amount("total_amount_usd", "discount_pct").alias("net_amount_usd"))


# --- dedup and stage (W1, W2, C15-C17) -----------------------------------------
def q_dedup_oldest_customer(spark, sf_dir):
    return stage.oldest_customer_rows(driver_raw.raw_customers(spark, sf_dir), KEY_TYPE)


def q_stage_customers(spark, sf_dir):
    return stage.stage_customers(driver_raw.raw_customers(spark, sf_dir), COUNTRY, KEY_TYPE)


def q_stage_products(spark, sf_dir):
    return stage.stage_products(driver_raw.raw_products(spark, sf_dir), KEY_TYPE)


def q_stage_orders(spark, sf_dir):
    return stage.stage_orders(driver_raw.raw_orders(spark, sf_dir), KEY_TYPE)


# --- star schema (S9, J1, J2, C20) ---------------------------------------------
def q_dim_customers(spark, sf_dir):
    return _layers(spark, sf_dir).dim_customers


def q_dim_products(spark, sf_dir):
    return _layers(spark, sf_dir).dim_products


def q_fact_ventas(spark, sf_dir):
    return _layers(spark, sf_dir).fact_ventas


# --- privacy (X1, X2) ------------------------------------------------------------
def q_protect_email(spark, sf_dir):
    return protect.protect_customers(_layers(spark, sf_dir).dim_customers)


def q_protect_card(spark, sf_dir):
    fact = _layers(spark, sf_dir).fact_ventas
    return fact.select("order_id", P.mask_column("credit_card_last4").alias("credit_card_last4"))


# --- checks (A7, J6, S9) -------------------------------------------------------
def q_check_duplicate_keys(spark, sf_dir):
    return checks.duplicate_keys(stage.clean_customers(driver_raw.raw_customers(spark, sf_dir), KEY_TYPE), "customer_id")


def q_check_duplicate_products(spark, sf_dir):
    return checks.duplicate_keys(stage.clean_products(driver_raw.raw_products(spark, sf_dir), KEY_TYPE), "product_id")


def q_check_duplicate_orders(spark, sf_dir):
    return checks.duplicate_keys(stage.clean_orders(driver_raw.raw_orders(spark, sf_dir), KEY_TYPE), "order_id")


def q_check_orphan_orders(spark, sf_dir):
    lay = _layers(spark, sf_dir)
    return checks.orphans(lay.stg_orders, lay.dim_customers, "customer_id")


def q_check_orphan_products(spark, sf_dir):
    lay = _layers(spark, sf_dir)
    return checks.orphans(lay.stg_orders, lay.dim_products, "product_id")


def q_check_text_lengths(spark, sf_dir):
    """Sizes tight enough to find rows in all three tables."""
    lay = _layers(spark, sf_dir)
    rows = None
    for name, df, key, limits in (
            ("stg_c", lay.dim_customers, "customer_id", {"first_name": 7, "email": 26, "city": 8}),
            ("stg_p", lay.dim_products, "product_id", {"product_name": 20, "category": 20}),
            ("fact", lay.fact_ventas, "order_id", {"status": 2, "credit_card_last4": 4})):
        part = checks.too_long(df, key, limits).select(
            F.lit(name).alias("table_name"), F.col(key).alias("row_key"), "column_name", "length")
        rows = part if rows is None else rows.union(part)
    return rows


def q_check_dropped_rows(spark, sf_dir):
    lay = _layers(spark, sf_dir)
    return checks.dropped_rows(*_raw(spark, sf_dir), lay.stg_customers, lay.stg_products, lay.stg_orders, KEY_TYPE)


# --- reports (R1-R3) -------------------------------------------------------------
# The reports read the published (protected) layer written by the layered run,
# as the reference's last phase reads the tables of the earlier phases.
def _layer_run(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the written layers."""
    def make():
        out = scratch_path(spark, "layers")
        raw = dict(zip(("customers", "products", "orders"), _raw(spark, sf_dir)))
        run_layers(spark, raw, out, country=COUNTRY, key_type=KEY_TYPE)
        return out

    return _once(spark, sf_dir, "layers", make)


def _analytics(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the written, unprotected star schema."""
    return read_layer(spark, os.path.join(_layer_run(spark, sf_dir), "analytics", name))


def published_layer(spark: SparkSession, sf_dir: str):
    out = _layer_run(spark, sf_dir)

    def read(name):
        return read_layer(spark, os.path.join(out, "protected", name)).drop("fecha_carga")
    return read("fact_ventas"), read("dim_customers"), read("dim_products")


def q_report_top_customers_latest_quarter(spark, sf_dir):
    fact, dim_c, _ = published_layer(spark, sf_dir)
    # the layered run has verified that every fact customer is in the dimension
    return reports.top_customers_latest_quarter(fact, dim_c, 3, keys_checked=True)


def q_report_revenue_by_month_category(spark, sf_dir):
    fact, _, dim_p = published_layer(spark, sf_dir)
    return reports.revenue_by_month_category(fact, dim_p)


def q_report_zscore_outliers(spark, sf_dir):
    fact, _, _ = published_layer(spark, sf_dir)
    return reports.zscore_outliers(fact, 2.0)


# --- exact statistics and distinct counts that merge (A2, A4, A5) ------------------
def q_exact_stats_by_month(spark, sf_dir):
    """States per month, and the states of all months merged."""
    fact = _analytics(spark, sf_dir, "fact_ventas")
    months = moments.moment_states(
        fact.select(F.year("order_date").cast("bigint").alias("ano"), F.month("order_date").cast("bigint").alias("mes"),
                    "total_amount_usd"), ["ano", "mes"], "total_amount_usd")
    null = F.lit(None).cast("bigint")
    both = months.withColumn("part", F.lit("month")).unionByName(
        moments.merge_states(months, []).select(F.lit("all").alias("part"), null.alias("ano"), null.alias("mes"), *moments.STATE))
    return moments.with_moments(both).select("part", "ano", "mes", "n", F.round("mean", 4).alias("mean"),
                                             F.round("deviation", 4).alias("deviation"))


def _orders_with_repeated_ids(spark, sf_dir):
    """The fact, and its order numbers without the line number: an order has several rows.

    The key map of all (customer, order) pairs is written once.
    """
    fact = _analytics(spark, sf_dir, "fact_ventas").withColumn("order_id", F.expr("order_id div 10"))

    def make():
        out = scratch_path(spark, "order-map")
        distinct.dense_key_map(fact, "customer_id", "order_id").write.parquet(out)
        return out

    return fact, read_layer(spark, _once(spark, sf_dir, "order-map", make))


def q_distinct_orders_by_quarter(spark, sf_dir):
    fact, numbers = _orders_with_repeated_ids(spark, sf_dir)
    dated = fact.withColumns({"ano": F.year("order_date").cast("bigint"), "mes": F.month("order_date").cast("bigint"),
                              "trimestre": F.quarter("order_date").cast("bigint")})
    months = distinct.distinct_states(dated, numbers, "customer_id", "order_id", ["ano", "trimestre", "mes"])
    return distinct.count_all(distinct.merge_states(months, ["ano", "trimestre"]), ["ano", "trimestre"], "n_orders")


def q_distinct_orders_by_customer(spark, sf_dir):
    fact, numbers = _orders_with_repeated_ids(spark, sf_dir)
    states = distinct.distinct_states(fact.withColumn("ano", F.year("order_date").cast("bigint")), numbers,
                                      "customer_id", "order_id", ["ano"])
    return distinct.count_by_owner(states, numbers, "customer_id", ["ano"], "n_orders")


def q_report_top_customers_distinct(spark, sf_dir):
    fact, numbers = _orders_with_repeated_ids(spark, sf_dir)
    return reports.top_customers_by_distinct_orders(fact, numbers, _analytics(spark, sf_dir, "dim_customers"), 3)


# --- keyed update and publish (S10, S11, E1) ---------------------------------------
def q_keyed_update_email(spark, sf_dir):
    """The customers layer after the e-mails of the latest quarter's buyers were hashed in place."""
    def make():
        root, fact = scratch_path(spark, "customers"), _analytics(spark, sf_dir, "fact_ventas")
        versions.create(spark, root, _analytics(spark, sf_dir, "dim_customers"), "customer_id",
                        spark.sparkContext.defaultParallelism)
        bounds = reports.latest_quarter_bounds(fact)
        buyers = fact.where(F.col("order_date") >= bounds.getField("lo")).select("customer_id").distinct()
        changes = versions.read_version(spark, root).join(buyers, "customer_id", "left_semi") \
            .select("customer_id", P.hash_column("email").alias("email"))
        versions.update_by_key(spark, root, changes, "customer_id")
        return root

    return versions.read_version(spark, _once(spark, sf_dir, "customers", make))


def q_published_fact(spark, sf_dir):
    """The fact that readers of the published run see."""
    def make():
        root = scratch_path(spark, "published")
        raw = dict(zip(("customers", "products", "orders"), _raw(spark, sf_dir)))
        run_published(spark, raw, root, "first", country=COUNTRY, key_type=KEY_TYPE)
        return root

    return read_published(spark, _once(spark, sf_dir, "published", make), "fact_ventas")


# --- date order per source (C6, N4) and range join (J5) ----------------------------
def q_date_order_decisions(spark, sf_dir):
    return date_order.decide(date_order.evidence(driver_raw.raw_order_dates(spark, sf_dir), "source", ["order_date"]))


def q_date_order_cast(spark, sf_dir):
    raw = driver_raw.raw_order_dates(spark, sf_dir)
    return date_order.read_dates(raw, q_date_order_decisions(spark, sf_dir), "source", "order_date", "order_moment")


def q_join_calendar_ranges(spark, sf_dir):
    """Orders and revenue of overlapping ranges: every three months in a row, and every year."""
    fact = _analytics(spark, sf_dir, "fact_ventas").select("order_date", "total_amount_usd")

    def spans(name, unit, months):
        start = F.trunc("order_date", unit)
        return fact.where("order_date IS NOT NULL").select(
            F.lit(name).alias("span"), start.cast("timestamp_ntz").alias("range_start"),
            F.last_day(F.add_months(start, months - 1)).cast("timestamp_ntz").alias("range_end")).distinct()

    joined = ranges.range_join(fact, spans("quarter", "month", 3).union(spans("year", "year", 12)),
                               "order_date", "range_start", "range_end", ranges.day_bins(92))
    return joined.groupBy("span", "range_start", "range_end").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.col("total_amount_usd").cast(reports.SUM_TYPE)).cast(reports.SUM_TYPE).alias("revenue_total"))


# --- catalog tables (S5, S8, S9, C20) and collation (N2) ----------------------------
def _table(spark, sf_dir, name, make):
    """A catalog table that ``make(table, path)`` fills once."""
    def once():
        table = f"{name}_{uuid.uuid4().hex[:12]}"
        make(table, scratch_path(spark, name))
        return table

    return _once(spark, sf_dir, f"table-{name}", once)


def _bucketed(spark, sf_dir, name, key, df):
    return spark.table(_table(spark, sf_dir, name, lambda table, path: catalog.save_bucketed(
        df, table, key, 2 * spark.sparkContext.defaultParallelism, path)))


def q_catalog_known_customers(spark, sf_dir):
    """J1 over bucketed tables: staged orders whose customer the dimension holds."""
    out = _layer_run(spark, sf_dir)
    orders = _bucketed(spark, sf_dir, "stg_orders", "customer_id", read_layer(spark, os.path.join(out, "stg_orders")))
    customers = _bucketed(spark, sf_dir, "dim_customers", "customer_id", _analytics(spark, sf_dir, "dim_customers"))
    return model.keep_existing(orders, customers, "customer_id").drop("fecha_actualizacion_stage")


def q_declared_dim_customers(spark, sf_dir):
    """The dimension written into its declared table."""
    dim = _analytics(spark, sf_dir, "dim_customers")

    def make(table, path):
        catalog.declare(spark, table, [*catalog.declared_columns(dim, model.CUSTOMER_TEXT_LIMITS), catalog.LOAD_STAMP], path)
        catalog.insert(dim, table)

    return spark.table(_table(spark, sf_dir, "declared_customers", make)).drop("fecha_carga")


def q_view_fact_ventas(spark, sf_dir):
    """The fact with net amounts computed on read; its files hold none."""
    fact = _analytics(spark, sf_dir, "fact_ventas")
    table = _table(spark, sf_dir, "plain_fact", lambda table, path: fact.drop("net_amount_usd").write
                   .format("parquet").option("path", path).saveAsTable(table))
    return catalog.net_amount_view(spark, table, f"view_of_{table}").select(fact.columns)


def q_collated_customers_by_country(spark, sf_dir):
    """Raw customers per country in any case, and whether that is the country kept by the stage."""
    raw = driver_raw.raw_customers(spark, sf_dir).select(catalog.case_blind(R.clean_text("country", upper=False)).alias("country"))
    return raw.groupBy("country").agg(F.count(F.lit(1)).alias("n_rows")) \
        .select(F.upper(F.col("country").cast("string")).alias("country"),
                (F.col("country") == catalog.case_blind(F.lit(COUNTRY.title()))).alias("is_kept"), "n_rows")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in list(globals().items())
    if name.startswith("q_") and callable(fn)
}


def _present(name: str) -> bool:
    try:
        return importlib.util.find_spec(name) is not None
    except ModuleNotFoundError:  # the package of the module is absent
        return False


def _training_data():
    """The query modules of the training-data operators, where they are present.

    The corpus pipeline is part of them: it is left out where their package is absent.
    """
    names = [n for n in ("tidystar.llm.queries", "corpus_pipeline") if _present(n)]
    return [importlib.import_module(n) for n in names] if "tidystar.llm.queries" in names else []


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = dict(_QUERIES)
    for module in _training_data():
        found.update(module.queries())
    return found


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL (same column names) for each key of ``queries()`` that SQL can express."""
    from oracle_queries import oracle_sql as _oracle
    found = _oracle()
    for module in _training_data():
        found.update(module.oracle_sql())
    return found
