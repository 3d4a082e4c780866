"""Every registered query beside its SQL; queries without SQL must give rows."""

import pytest
from compare import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n in SQL))
def test_matches_sql(name, spark, folder, con):
    status, note = compare(name, QUERIES[name], SQL[name], spark, folder, con)
    assert status == "ok", note


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in SQL))
def test_gives_rows(name, spark, folder):
    assert QUERIES[name](spark, folder).limit(1).count() == 1


def test_entry(spark):
    assert entry(spark).count() == 1


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
