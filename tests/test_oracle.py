"""Every query against its SQL, and the driver's entry point."""

import os

import pytest
from compare import connect, differences

import __spark_entry__ as entry

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, FOLDER), duck, ORACLES[name]) is None


def test_oracles_name_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_has_rows(spark, name):
    assert not QUERIES[name](spark, FOLDER).isEmpty()


def test_entry(spark):
    assert entry.entry(spark).count() > 0
