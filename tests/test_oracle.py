"""Every query with SQL, against DuckDB on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from skeinwork.plans.catalogue import ORACLES, QUERIES
from tests.oracle import connect, rows

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    got, want = QUERIES[name](spark, SF).toPandas(), con.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["file1", "file2", "shared", "union", "similarity"]
    assert df.count() > 0


def test_names_of_queries_and_oracles_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
