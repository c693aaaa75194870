"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as contract
from oracle import compare, connect
from starloom.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    assert compare(df, duck, contract.oracle_sql()[name]) is None
    assert not df.isEmpty()


def test_entry(spark):
    assert contract.entry(spark).count() > 0
