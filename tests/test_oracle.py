"""Every registered query against its SQL counterpart."""

import os
import shutil
import subprocess
import sys

import pytest
from compare import differences, duck

import __spark_entry__ as entry
from tablepull.plans import oracle, queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = queries.QUERIES, oracle.ORACLE


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_its_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_imports_without_the_optional_parts(tmp_path):
    """The entry module and the library run where the operators for training data and the pipeline are not there."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/tablepull", tmp_path / "tablepull", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert set(e.queries()) == set(e.oracle_sql()) and len(e.queries()) > 70"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SF_DIR), connection, SQL[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
