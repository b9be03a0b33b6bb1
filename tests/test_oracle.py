"""Every registered query at the smallest scale against its SQL twin."""

import os

import pytest

import __spark_entry__ as entry
from ratewise.plans import registry
from tests.oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES = registry.queries()
ORACLE = registry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLE[name], SF_DIR) is None


def test_names():
    assert set(ORACLE) <= set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 10
