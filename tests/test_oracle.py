import os

import pytest

import __spark_entry__ as contract
from tallyfold.plans.catalog import QUERIES
from tallyfold.plans.oracle import ORACLE_SQL
from tests.oracle_check import compare

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE_SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    assert compare(spark, name, SF_DIR) > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 10
