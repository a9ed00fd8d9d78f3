"""Every registered query against its reference SQL, exact values and types."""

import pytest
from compare import differences

import __spark_entry__ as contract
from tripwright.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_query_has_reference_sql():
    assert contract.queries().keys() >= QUERIES.keys()
    assert contract.oracle_sql().keys() >= QUERIES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    assert differences(spark, SF, contract.queries()[name], contract.oracle_sql()[name]) == ""


def test_entry(spark):
    assert contract.entry(spark).count() == 2210
