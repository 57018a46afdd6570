"""Every registered query against its SQL on DuckDB."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
import check
from platterwatch.plans.catalog import QUERIES
from platterwatch.plans.catalog_sql import ORACLE

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def con(folder):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for table in check.TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_equals_its_sql(spark, con, folder, name):
    good, text = check.compare(spark, con, name, folder)
    assert good, text


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("missing", ["corpus_pipeline", "platterwatch.llm", "public_tokenizers", "xxhash"])
def test_core_queries_do_without_the_other_subpackage(missing):
    """Whichever import fails, the queries of the core are there."""
    code = f"""
import sys
sys.modules[{missing!r}] = None
import __spark_entry__ as entry
from platterwatch.plans.catalog import QUERIES
assert entry.queries().keys() == QUERIES.keys() == entry.oracle_sql().keys()
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert "without the queries of platterwatch.llm" in done.stderr
