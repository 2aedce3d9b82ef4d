"""Every registered query against its SQL, on the small tables."""

import pytest

import __spark_entry__ as entry
from check_queries import compare, duck
from workload import catalog, oracle


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_query_has_its_sql():
    assert set(catalog.QUERIES) == set(oracle.SQL)
    assert set(catalog.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, sf, name):
    assert compare(spark, con, name, sf) == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "sale_date" and df.count() > 0
