"""Every registered query next to its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as contract
from compare import differences

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, name):
    assert differences(spark, SF, name) is None


def test_queries_without_sql_run(spark):
    for name in set(contract.queries()) - set(contract.oracle_sql()):
        assert contract.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
