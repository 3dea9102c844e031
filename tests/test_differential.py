"""Differential tests: every registered query against its DuckDB oracle on
the smallest driver data set (the driver repeats this at sf0.01)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from oracle.compare import compare, duck_connect
from procura.queries import OPERATOR_QUERIES, REPORT_QUERIES

# the optional training-data queries have their own tests
QUERIES = {**OPERATOR_QUERIES, **REPORT_QUERIES}
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_small):
    return duck_connect(sf_small)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, sf_small, con, name):
    res = compare(QUERIES[name](spark, sf_small), con, ORACLE[name])
    assert res["columns_match"], res
    assert res["rows_match"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 107
    assert df.count() > 0
