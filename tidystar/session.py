"""Spark session and shared-folder helpers.

The library never picks a machine-local folder on a cluster: scratch and
lineage-cutting writes go under the folder the cluster names in
``spark.checkpoint.dir``. Only a local master may leave that setting out (tests);
then a private temporary folder is created and registered. Elsewhere its absence
is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of the library wants. AQE re-plans joins on measured
# sizes (that is the size check behind every broadcast), coalesces small
# shuffle partitions and splits skewed ones.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    # The cleaning projections are wide: a whole-stage method above HotSpot's
    # 8000-byte JIT limit would run interpreted (measured 2x slower stage), so
    # such subtrees fall back to separately compiled expression code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def compile_small_methods(spark: SparkSession) -> SparkSession:
    """Keep generated methods below the JVM's compile limit in a session that others made.

    Without it the projections of the cleaning rules run interpreted there. A
    lower limit of the session stays.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name, "65535")) > int(BASE_CONF[name]):
        spark.conf.set(name, BASE_CONF[name])
    return spark


def get_session(master: str | None = None, app_name: str = "tidystar",
                shuffle_partitions: int | None = None,
                extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only if unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tidystar-ckpt-")  # a local run or a test
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
