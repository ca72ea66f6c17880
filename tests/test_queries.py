"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from check_queries import TABLES, canonical

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(driver.QUERIES) == set(driver.ORACLE)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query(spark, con, name):
    frame = driver.queries()[name](spark, SF)
    want = con.sql(driver.oracle_sql()[name])
    assert sorted(frame.columns) == sorted(want.columns)
    assert canonical(frame.toArrow()) == canonical(want.to_arrow_table())


def test_entry(spark):
    assert driver.entry(spark).count() > 0
