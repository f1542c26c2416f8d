"""Each registered query against its SQL on the smallest tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from tillbook.checks import oracle, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(queries.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["item_type", "discount_type", "orders", "revenue"] and df.count() > 0
