"""Keyed updates of a versioned layer, and publish and restart of the layered run."""
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tidystar.plans import layers, publish
from tidystar.session import scratch_path
from tidystar.sources import driver_raw, files, versions


@pytest.fixture()
def layer(spark):
    df = spark.range(1, 2001).select("id", F.concat(F.lit("m"), F.col("id")).alias("email"), F.lit(1).alias("other"))
    root = scratch_path(spark, "layer")
    assert versions.create(spark, root, df, "id", 8) == "00000001"
    return root


def names(spark, root, version=None):
    return {r["file"] for r in versions.manifest_of(spark, root, version).collect()}


def test_only_touched_files_are_rewritten(spark, layer):
    before = names(spark, layer)
    assert len(before) == 8
    changes = spark.createDataFrame([(5, "new"), (6, None), (1990, "end"), (99_999, "absent"), (None, "no key")],
                                    "id bigint, email string")
    version, rewritten = versions.update_by_key(spark, layer, changes, "id")
    after = names(spark, layer)
    assert (version, rewritten) == ("00000002", 2) and len(before & after) == 6 and len(after) == 8
    got = {r["id"]: (r["email"], r["other"]) for r in versions.read_version(spark, layer).collect()}
    want = {i: (f"m{i}", 1) for i in range(1, 2001)} | {5: ("new", 1), 6: (None, 1), 1990: ("end", 1)}
    assert got == want
    # readers of the old version still find it whole
    assert {r["id"]: r["email"] for r in versions.read_version(spark, layer, "00000001").collect()}[5] == "m5"
    # ranges and filters of the rewritten files hold for the next update
    assert versions.update_by_key(spark, layer, spark.createDataFrame([(6, "again")], "id bigint, email string"), "id")[1] == 1


def test_bloom_filters_spare_files_whose_range_holds_the_key(spark):
    root = scratch_path(spark, "sparse")
    versions.create(spark, root, spark.range(0, 4000, 2).select("id", F.lit("x").alias("email")), "id", 4)
    odd = spark.range(1, 4000, 40).select("id")
    touched = versions.touched_files(spark, root, odd, "id").count()
    asked = spark.createDataFrame([(301,)], "id bigint")
    assert versions.touched_files(spark, root, asked, "id").count() == 0 and touched <= 4
    assert versions.update_by_key(spark, root, asked.withColumn("email", F.lit("y")), "id") == ("00000001", 0)


def test_a_repeated_key_of_the_change_set_is_refused(spark, layer):
    with pytest.raises(ValueError, match="repeats"):
        versions.update_by_key(spark, layer, spark.createDataFrame([(5, "a"), (5, "b")], "id bigint, email string"), "id")


def test_an_update_that_dies_before_the_switch_changes_nothing(spark, layer, monkeypatch):
    def dies(*_):
        raise RuntimeError("killed")

    change = spark.createDataFrame([(5, "new")], "id bigint, email string")
    monkeypatch.setattr(files, "put", dies)
    with pytest.raises(RuntimeError):
        versions.update_by_key(spark, layer, change, "id")
    monkeypatch.undo()
    assert versions.current_version(spark, layer) == "00000001"
    assert versions.read_version(spark, layer).where("email = 'new'").count() == 0
    assert versions.update_by_key(spark, layer, change, "id") == ("00000002", 1)
    assert versions.read_version(spark, layer).where("email = 'new'").count() == 1


def test_small_files_are_replaced_whole(spark):
    path = os.path.join(scratch_path(spark, "small"), "CURRENT")
    assert files.get(spark, path) is None and not files.exists(spark, path)
    for text in ("one", "twö"):
        files.put(spark, path, text)
        assert files.get(spark, path) == text and files.exists(spark, path)


def test_a_killed_run_leaves_the_old_version_and_is_finished_later(spark, monkeypatch):
    raw = {"customers": driver_raw.raw_customers(spark, SF001), "products": driver_raw.raw_products(spark, SF001),
           "orders": driver_raw.raw_orders(spark, SF001)}
    root = scratch_path(spark, "published")
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, root, "fact_ventas")
    # an earlier run of half the orders is what readers see
    half = {**raw, "orders": raw["orders"].where("order_id < '5'")}
    publish.run_published(spark, half, root, "first", country="AMERICA", key_type="bigint")
    old = publish.read_published(spark, root, "fact_ventas").count()

    def dies(_):
        raise RuntimeError("killed")

    monkeypatch.setattr(layers.protect, "protect_sales", dies)
    steps = []
    with pytest.raises(RuntimeError):
        publish.run_published(spark, raw, root, "second", country="AMERICA", key_type="bigint",
                              on_step=lambda name, _: steps.append(name))
    assert steps == ["stage", "analytics", "checks"]
    assert publish.published_run(spark, root) == "first"
    assert publish.read_published(spark, root, "fact_ventas").count() == old

    monkeypatch.undo()
    steps.clear()
    publish.run_published(spark, raw, root, "second", country="AMERICA", key_type="bigint",
                          on_step=lambda name, _: steps.append(name))
    assert steps == ["protect"]  # the complete layers were taken as they lay there
    assert publish.published_run(spark, root) == "second"
    assert publish.read_published(spark, root, "fact_ventas").count() > old
