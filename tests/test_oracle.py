"""Every registered query against its SQL on the smallest tables; those without SQL must give rows."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert not df.isEmpty()
    else:
        assert compare(df, con, sql) == ""


def test_entry(spark):
    assert not entry.entry(spark).isEmpty()


def test_sql_names_known_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
