"""Shared folders and the load stamp."""

import datetime as dt
from types import SimpleNamespace

import pytest

from tidystar.session import compile_small_methods, ensure_checkpoint_dir, scratch_path
from tidystar.sources.tables import load_table, with_load_stamp


def fake_session(master, conf=None, current=None):
    made = []
    sc = SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda k, d=None: d),
                         getCheckpointDir=lambda: made[-1] if made else current, setCheckpointDir=made.append)
    return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: conf or d))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[3,2,1024]"])
def test_a_cluster_must_name_its_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake_session(master))
    assert ensure_checkpoint_dir(fake_session(master, conf="hdfs:///shared")) == "hdfs:///shared"
    assert ensure_checkpoint_dir(fake_session(master, current="hdfs:///set")) == "hdfs:///set"


def test_scratch_paths_lie_in_the_shared_folder(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(ensure_checkpoint_dir(spark))


def test_load_stamp_is_the_time_of_the_write(spark):
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - dt.timedelta(seconds=1)
    rows = with_load_stamp(spark.range(3)).selectExpr("CAST(to_utc_timestamp(fecha_carga, current_timezone()) AS TIMESTAMP_NTZ) AS t").collect()
    after = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(seconds=1)
    assert len({r["t"] for r in rows}) == 1 and before <= rows[0]["t"] <= after


def test_reading_a_table_keeps_generated_methods_small_in_any_session(spark, tmp_path):
    name, usual = "spark.sql.codegen.hugeMethodLimit", spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    try:
        spark.conf.unset(name)
        spark.conf.set(name, "65535")  # Spark's default, as in sessions that others make
        load_table(spark, str(tmp_path), "t")
        assert spark.conf.get(name) == "8000"
        spark.conf.set(name, "4000")
        compile_small_methods(spark)
        assert spark.conf.get(name) == "4000"
    finally:
        spark.conf.set(name, usual)
