"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import os
from urllib.parse import urlparse

import pytest

import __spark_entry__ as E
from tidystar.session import ensure_checkpoint_dir
from tests.conftest import SF001, SF01
from tests.oracle_compare import compare, duck_connection

SQL = E.oracle_sql()
NAMES = sorted(E._QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF01)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(SQL)
    assert set(SQL) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(E.queries()[name](spark, SF01), con, SQL[name])
    assert res["names_match"] and res["types_match"] and res["values_match"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert [f.name for f in df.schema.fields] == ["ano", "mes", "categoria", "revenue_total"]
    assert df.count() > 0
    assert SF001


@pytest.mark.parametrize("name", NAMES)
def test_query_reads_driver_tables_or_derived_data(spark, name):
    """Every registered query scans the driver tables, or layers Spark wrote from them."""
    scratch_root = os.path.dirname(urlparse(ensure_checkpoint_dir(spark)).path)
    files = [urlparse(f).path for f in E.queries()[name](spark, SF001).inputFiles()]
    assert files
    assert all(f.startswith(SF001) or f.startswith(scratch_root) for f in files), files
