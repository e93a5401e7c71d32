"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(SQL) <= set(QUERIES)
    assert all(key in SQL or key == "pipeline" or key.startswith("op") for key in QUERIES)


@pytest.mark.parametrize("key", list(SQL))
def test_equal_to_sql(spark, con, key):
    diff, _ = difference(QUERIES[key](spark, SF_DIR), con, SQL[key])
    assert not diff


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "house_objectid", "housenum", "addnum1", "addnum2", "address_without_house", "full_address"
    ]
    assert df.count() > 0
