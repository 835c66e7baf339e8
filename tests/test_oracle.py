"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from cyclewise.plans.catalog import QUERIES as OWN
from tests.compare import compare, duck

QUERIES = {name: entry.queries()[name] for name in OWN}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in OWN}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_sql_has_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), SQL[name], con) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir)
    assert rows.count() > 0
    assert rows.filter("score IS NULL OR isnan(score) OR score < 0").count() == 0


def test_entry(spark):
    assert entry.entry(spark).count() == 15
