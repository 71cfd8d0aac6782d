"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from catalog import ORACLES, QUERIES
from tools.check_parity import compare, connect

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are absent")
@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_sql(spark, connection, key):
    good, note = compare(spark, connection, SF_DIR, key)
    assert good, note


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLES)
