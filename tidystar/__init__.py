"""tidystar: layered sales analytics on PySpark (raw -> stage -> star schema -> reports)."""

from .plans.layers import build_layers, build_reports, ingest_folder, run_from_folder, run_layers
from .session import get_session, scratch_path

__all__ = ["build_layers", "build_reports", "get_session", "ingest_folder", "run_from_folder",
           "run_layers", "scratch_path"]
