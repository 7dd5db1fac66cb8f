"""Every registered query against its SQL statement on the smallest test tables."""

import os

import pytest
from oracle_compare import compare, connect

import __spark_entry__ as entry
from oracles import all_sql
from tradewharf.plans.catalog import all_queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_statement_has_a_query():
    assert not set(SQL) - set(QUERIES)
    assert not set(QUERIES) - set(SQL)


def test_entry_has_them_all():
    assert not set(QUERIES) - set(entry.queries())
    assert not set(SQL) - set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(name, spark, con):
    assert compare(QUERIES[name](spark, SF_DIR), con, SQL[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
