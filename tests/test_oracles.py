import pytest

import __spark_entry__ as contract
from tests.oracle import assert_same, connect

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


# Queries of their own package, which has its own tests.
OWN = {name for name in contract.queries() if name.startswith("op") or name == "pipeline"}


def test_every_query_has_an_oracle():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(contract.queries()) - set(contract.oracle_sql()) <= OWN


@pytest.mark.parametrize("name", sorted(set(contract.oracle_sql()) - OWN))
def test_query_matches_sql(spark, con, name):
    assert_same(contract.queries()[name](spark, SF), con, contract.oracle_sql()[name])


def test_entry(spark):
    assert contract.entry(spark).count() == 500 * 22
