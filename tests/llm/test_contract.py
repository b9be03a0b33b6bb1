"""Registered queries with a SQL twin, and the columns of all of them."""

import os

import pytest

from ratewise.llm.queries import ORACLE, QUERIES
from tests.oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLE[name], SF_DIR) is None


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
