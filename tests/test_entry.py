"""The entry module without the optional query modules."""

import importlib
import importlib.util
import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as E

ROOT = os.path.dirname(os.path.abspath(E.__file__))


def test_core_queries_stand_alone(monkeypatch):
    monkeypatch.setattr(importlib.util, "find_spec", lambda name: None)
    assert set(E.queries()) == set(E._QUERIES)
    assert set(E.oracle_sql()) == set(E._QUERIES)


def test_a_missing_package_is_not_an_error(monkeypatch):
    def gone(name):
        raise ModuleNotFoundError(name)

    monkeypatch.setattr(importlib.util, "find_spec", gone)
    assert set(E.queries()) == set(E._QUERIES)


def test_a_broken_query_module_is_an_error(monkeypatch):
    def broken(name):
        raise ImportError(name)

    monkeypatch.setattr(importlib.util, "find_spec", lambda name: object())
    monkeypatch.setattr(importlib, "import_module", broken)
    with pytest.raises(ImportError):
        E.queries()


@pytest.mark.parametrize("without", [("tidystar/llm", "tests/llm"), ("tidystar/llm", "tests/llm", "corpus_pipeline.py")])
def test_a_copy_of_the_tree_without_the_optional_folders(tmp_path, without):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: [
        n for n in names if n in (".git", "__pycache__")
        or os.path.relpath(os.path.join(folder, n), ROOT) in without])
    code = ("import __spark_entry__ as E; q, o = E.queries(), E.oracle_sql(); "
            "assert set(q) == set(o) == set(E._QUERIES) and 'pipeline' not in q; print(E.__file__)")
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120,
                          env={**os.environ, "PYTHONPATH": ""})
    assert done.returncode == 0, done.stderr
    assert str(copy) in done.stdout
