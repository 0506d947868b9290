import pytest
from oracle_check import connect, differences

import __spark_entry__ as entry_points
from monthmill.catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"
TEXTS = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(TEXTS)
    assert set(QUERIES) | set(TEXTS) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SF), connection, TEXTS[name]) == []


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() == 10500 and "debt_to_income" in df.columns
