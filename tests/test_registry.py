"""Registered queries against their SQL on the smallest tables."""

import pytest

import __spark_entry__ as registry
import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare.difference(spark, con, name, FOLDER) is None
