"""The registered queries against their SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from compare import TABLES, compare

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(contract.QUERIES))
def test_query_equals_its_sql(spark, database, name):
    verdict, count, _ = compare(spark, database, FOLDER, name)
    assert verdict == "same"
    assert count > 0


def test_contract(spark):
    assert set(contract.CHECKS) == set(contract.QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
