"""Every registered query against its SQL, on the smallest driver tables."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import oracle_check
import pytest

import __spark_entry__ as entry
from carelake.standin.oracle import SQL
from carelake.standin.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def connection():
    return oracle_check.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert oracle_check.compare(spark, connection, name, FOLDER) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns[0] == "service_code"
    assert result.count() > 0


def test_entry_without_the_training_data_operators(tmp_path):
    """Every other query stays registered in a copy that lacks their folders, whether or not the pipeline lies there."""
    repo, out = Path(__file__).resolve().parent.parent, shutil.ignore_patterns("llm", ".git", "__pycache__", "tests")
    shutil.copytree(repo, tmp_path / "copy", ignore=out)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
    for _ in range(2):
        said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True, check=True)
        assert said.stdout.split() == [str(len(QUERIES)), str(len(SQL)), "False"]
        (tmp_path / "copy" / "corpus_pipeline.py").unlink(missing_ok=True)
