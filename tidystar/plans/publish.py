"""Consistent publish and restart of the layered run.

Every run has a folder of its own under ``root/runs``; a layer that is complete leaves a mark
there. A run that is started again under its name takes marked layers as they are and begins
at the first one without a mark. Readers follow ``root/CURRENT``, which is switched by one
rename after the last layer, so they see the whole old run or the whole new one, whatever
fails in between.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import stage
from ..sources import files
from ..sources.tables import read_layer
from .layers import Reports, run_layers


def _pointer(root: str) -> str:
    return os.path.join(root, "CURRENT")


def run_folder(root: str, run_id: str) -> str:
    return os.path.join(root, "runs", run_id)


def run_published(spark: SparkSession, raw: dict[str, DataFrame], root: str, run_id: str,
                  country: str = stage.DEFAULT_COUNTRY, key_type: str = "int",
                  on_step: Callable[[str, float], None] | None = None) -> Reports:
    """Run (or finish) the layers of ``run_id``, then let ``root`` point to them."""
    folder = run_folder(root, run_id)

    def marked(layer: str) -> bool:
        return files.exists(spark, os.path.join(folder, "done", layer))

    found = run_layers(spark, raw, folder, country=country, key_type=key_type, on_step=on_step, is_done=marked,
                       set_done=lambda layer: files.put(spark, os.path.join(folder, "done", layer), run_id))
    files.put(spark, _pointer(root), run_id)
    return found


def published_run(spark: SparkSession, root: str) -> str | None:
    """The run that readers see."""
    return files.get(spark, _pointer(root))


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table (``fact_ventas``, ``dim_customers``, ``dim_products``) of the published run, without its load stamp."""
    run_id = published_run(spark, root)
    if run_id is None:
        raise FileNotFoundError(f"nothing is published: {root}")
    return read_layer(spark, os.path.join(run_folder(root, run_id), "protected", name)).drop("fecha_carga")
