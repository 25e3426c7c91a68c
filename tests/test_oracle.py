"""Every catalogue query against its SQL twin."""

import os

import pytest
from oracle_check import compare, duckdb_tables

import __spark_entry__
from pulseledger import catalog

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    return duckdb_tables(SF)


@pytest.mark.parametrize("name", [n for n, q in catalog.QUERIES.items() if q.select is not None])
def test_query_equals_its_sql(spark, tables, name):
    assert compare(catalog.QUERIES[name](spark, SF), tables, catalog.QUERIES[name].sql()) is None


@pytest.mark.parametrize("name", [n for n, q in catalog.QUERIES.items() if q.select is None])
def test_query_without_sql_has_rows(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
