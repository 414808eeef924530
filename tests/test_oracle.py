"""Every registered query against its SQL restatement."""

import pytest

import __spark_entry__ as entry
from chunkloom.plans.catalog import QUERIES
from chunkloom.plans.oracle import ORACLE
from tests.compare import both, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_equals_sql(spark, con, key):
    found, wanted = both(spark, con, SF, key)
    assert found[0] == wanted[0]
    assert found[1] == wanted[1]
    assert found[1]
