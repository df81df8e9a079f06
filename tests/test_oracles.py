"""Every query with SQL counterpart, on the same files."""

from __future__ import annotations

import pytest
from compare import differences, duck

import __spark_entry__ as entry_module

QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, sf_dir, con):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0
