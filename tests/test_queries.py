"""Every registered query against its SQL on the smallest given tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from stratum.plans import registry
from tests.check import compare, connect

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")

QUERIES, SQL = entry.queries(), entry.oracle_sql()
CORE = registry.all_queries()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    """Those of the optional subpackage that SQL cannot express are listed in its own tests."""
    assert set(CORE) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), con.sql(SQL[name])) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
