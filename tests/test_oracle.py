"""Every registered query against its reference SQL on the driver tables."""

import os

import pytest
from compare import connect, difference

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_reference_sql():
    assert set(entry.REGISTRY) == set(entry.ORACLE_SQL)


@pytest.mark.parametrize("name", list(entry.REGISTRY))
def test_query(spark, connection, name):
    df = entry.queries()[name](spark, FOLDER)
    assert difference(df, connection, entry.oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
