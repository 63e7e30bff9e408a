"""The layered run (E1): CSV folder -> raw -> stage -> analytics -> protected -> reports.

``build_layers`` chains the operators lazily (one logical plan per output, so
Catalyst prunes and pushes filters through every layer). ``run_layers`` is
the production form: each layer is written whole (independent tables of a
layer from a few driver threads) and read back before the next one starts,
so a lost executor only recomputes the current layer, and only the protected
layer is published for the reports. ``ingest_folder`` adds the raw layer from
a CSV folder and ``run_from_folder`` chains both. Errors are raised, never
swallowed; ``out_dir`` should be shared storage on a cluster.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators import model, protect, reports, stage
from ..operators.checks import assert_empty, dropped_rows, key_and_length_violations
from ..session import compile_small_methods
from ..sources.csv_folder import RAW_PREFIX, list_csv_entries, raw_table
from ..sources.tables import read_layer, with_load_stamp, write_layer


@dataclass
class Layers:
    stg_customers: DataFrame
    stg_products: DataFrame
    stg_orders: DataFrame
    dim_customers: DataFrame
    dim_products: DataFrame
    fact_ventas: DataFrame

    def protected(self) -> tuple[DataFrame, DataFrame]:
        return (protect.protect_customers(self.dim_customers),
                protect.protect_sales(self.fact_ventas))


def build_layers(raw_customers: DataFrame, raw_products: DataFrame, raw_orders: DataFrame,
                 country: str = stage.DEFAULT_COUNTRY, key_type: str = "int") -> Layers:
    """``key_type`` is the type of the ids: INT as the reference declares, or BIGINT."""
    stg_c = stage.stage_customers(raw_customers, country, key_type)
    stg_p = stage.stage_products(raw_products, key_type)
    stg_o = stage.stage_orders(raw_orders, key_type)
    dim_c = model.dim_customers(stg_c, key_type)
    dim_p = model.dim_products(stg_p, key_type)
    return Layers(stg_c, stg_p, stg_o, dim_c, dim_p, model.fact_sales(stg_o, dim_c, dim_p, key_type))


def in_parallel(*jobs: Callable[[], object], workers: int = 4) -> list:
    """Run independent Spark actions from a few driver threads; re-raise the first error.

    Each action is its own Spark job; running them together overlaps their
    driver-side planning and commit work and keeps executors busy while a
    small job finishes.
    """
    with ThreadPoolExecutor(max_workers=max(1, min(workers, len(jobs)))) as pool:
        futures = [pool.submit(job) for job in jobs]
        return [f.result() for f in futures]


@dataclass
class Reports:
    top_customers: DataFrame
    revenue: DataFrame
    outliers: DataFrame
    #: Lazy (table_name, rule, n_rows): what each rule of the run left out.
    dropped: DataFrame | None = None
    #: Files and rows read per raw table (filled by ``run_from_folder``).
    counts: dict[str, dict[str, int]] = field(default_factory=dict)


def build_reports(fact: DataFrame, dim_c: DataFrame, dim_p: DataFrame,
                  keys_checked: bool = False) -> Reports:
    return Reports(reports.top_customers_latest_quarter(fact, dim_c, keys_checked=keys_checked),
                   reports.revenue_by_month_category(fact, dim_p),
                   reports.zscore_outliers(fact))


def run_layers(spark: SparkSession, raw: dict[str, DataFrame], out_dir: str,
               country: str = stage.DEFAULT_COUNTRY, check: bool = True, key_type: str = "int",
               on_step: Callable[[str, float], None] | None = None, is_done: Callable[[str], bool] | None = None,
               set_done: Callable[[str], None] | None = None) -> Reports:
    """Write stage, analytics and protected layers under ``out_dir``; return the reports.

    ``raw`` maps ``customers``, ``products`` and ``orders`` to raw text
    tables (from ``sources.csv_folder.load_raw_folder`` or the driver tables).
    ``on_step(name, seconds)`` is called after each layer is written. A layer for which
    ``is_done(name)`` holds is taken as it lies there; ``set_done(name)`` is called for every other
    one once it is complete (see ``plans.publish``).
    """
    compile_small_methods(spark)

    def path(name: str) -> str:
        return os.path.join(out_dir, name)

    clock = [time.perf_counter()]

    def done(name: str) -> bool:
        return is_done is not None and is_done(name)

    def step(name: str) -> None:
        if set_done:
            set_done(name)
        now = time.perf_counter()
        if on_step:
            on_step(name, now - clock[0])
        clock[0] = now

    # Stage layer: one write per table, load stamp added on write only.
    if not done("stage"):
        built = build_layers(raw["customers"], raw["products"], raw["orders"], country, key_type)
        in_parallel(*[
            (lambda df=df, name=name: write_layer(with_load_stamp(df, "fecha_actualizacion_stage"),
                                                  path(name)))
            for name, df in (("stg_orders", built.stg_orders),
                             ("stg_customers", built.stg_customers),
                             ("stg_products", built.stg_products))])
        step("stage")
    stg_c = read_layer(spark, path("stg_customers")).drop("fecha_actualizacion_stage")
    stg_p = read_layer(spark, path("stg_products")).drop("fecha_actualizacion_stage")
    stg_o = read_layer(spark, path("stg_orders")).drop("fecha_actualizacion_stage")

    # Analytics layer (unprotected; kept private to the run).
    if not done("analytics"):
        in_parallel(lambda: write_layer(model.dim_customers(stg_c, key_type), path("analytics/dim_customers")),
                    lambda: write_layer(model.dim_products(stg_p, key_type), path("analytics/dim_products")))
        write_layer(model.fact_sales(stg_o, read_layer(spark, path("analytics/dim_customers")),
                                     read_layer(spark, path("analytics/dim_products")), key_type),
                    path("analytics/fact_ventas"))
        step("analytics")
    dim_c = read_layer(spark, path("analytics/dim_customers"))
    dim_p = read_layer(spark, path("analytics/dim_products"))
    fact = read_layer(spark, path("analytics/fact_ventas"))

    if check and not done("checks"):
        # Keys and the declared VARCHAR(n) sizes: any offending row fails the run,
        # as the reference's constraints would fail its inserts. One grouped scan
        # per table covers its key and its text sizes. References hold by the
        # fact's own semi joins; ``dropped`` tells what those left out.
        in_parallel(*[
            (lambda df=df, key=key, limits=limits, what=what: assert_empty(
                key_and_length_violations(df, key, limits), f"{what} primary key / text lengths"))
            for df, key, limits, what in (
                (dim_c, "customer_id", model.CUSTOMER_TEXT_LIMITS, "dim_customers"),
                (dim_p, "product_id", model.PRODUCT_TEXT_LIMITS, "dim_products"),
                (fact, "order_id", model.FACT_TEXT_LIMITS, "fact_ventas"))])
        step("checks")

    # Protected layer: the only one the reports read.
    # The fact is sorted by order date inside each task (no shuffle): Parquet
    # row groups then cover narrow date ranges, so date-bounded reads (R1) skip most.
    if not done("protect"):
        in_parallel(
            lambda: write_layer(with_load_stamp(protect.protect_sales(fact))
                                .sortWithinPartitions("order_date"),
                                path("protected/fact_ventas")),
            lambda: write_layer(with_load_stamp(protect.protect_customers(dim_c)),
                                path("protected/dim_customers")),
            lambda: write_layer(with_load_stamp(dim_p), path("protected/dim_products")))
        step("protect")
    p_dim_c = read_layer(spark, path("protected/dim_customers")).drop("fecha_carga")
    p_dim_p = read_layer(spark, path("protected/dim_products")).drop("fecha_carga")
    p_fact = read_layer(spark, path("protected/fact_ventas")).drop("fecha_carga")
    found = build_reports(p_fact, p_dim_c, p_dim_p, keys_checked=check)
    found.dropped = dropped_rows(raw["customers"], raw["products"], raw["orders"],
                                 stg_c, stg_p, stg_o, key_type)
    return found


def ingest_folder(spark: SparkSession, in_dir: str,
                  out_dir: str) -> tuple[dict[str, DataFrame], dict[str, dict[str, int]]]:
    """Phase 1 (S1-S5, S13): every CSV entry of ``in_dir`` written as ``raw_<name>``.

    Returns the raw tables read back from the written layer (keyed without the
    ``raw_`` prefix) and, per table, the number of files and rows read.
    """
    def ingest_one(name: str, path: str, n_files: int) -> dict[str, int]:
        table = raw_table(spark, name, path, n_files)
        write_layer(table.df, os.path.join(out_dir, name))
        return {"files": table.n_files, "rows": table.row_count()}

    entries = list_csv_entries(spark, in_dir)
    found = in_parallel(*[(lambda n=n, e=e: ingest_one(n, *e)) for n, e in entries.items()])
    raw = {n[len(RAW_PREFIX):]: read_layer(spark, os.path.join(out_dir, n)) for n in entries}
    return raw, dict(zip(entries, found))


def run_from_folder(spark: SparkSession, in_dir: str, out_dir: str,
                    country: str = stage.DEFAULT_COUNTRY, key_type: str = "int",
                    on_step: Callable[[str, float], None] | None = None) -> Reports:
    """E1 whole: CSV folder -> raw -> stage -> analytics -> protected -> reports."""
    t0 = time.perf_counter()
    raw, counts = ingest_folder(spark, in_dir, os.path.join(out_dir, "raw"))
    missing = {"customers", "products", "orders"} - set(raw)
    if missing:
        raise FileNotFoundError(f"input folder lacks {sorted(missing)} CSV files: {in_dir}")
    if on_step:
        on_step("ingest", time.perf_counter() - t0)
    reports = run_layers(spark, raw, out_dir, country=country, key_type=key_type, on_step=on_step)
    reports.counts = counts
    return reports
