"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck_conn

from conftest import SF_SMALL

QUERIES = entry.queries()
SQLS = entry.oracle_sql()
NO_ORACLE = {name for name in QUERIES if name not in SQLS}


@pytest.fixture(scope="module")
def con():
    return duck_conn(SF_SMALL)


def test_every_query_has_an_oracle():
    assert {n for n in NO_ORACLE if n != "pipeline" and not n.startswith("op")} == set()  # those have their tests in tests/llm


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQLS])
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, SF_SMALL, name, QUERIES[name], SQLS[name], con)
    assert res["status"] == "OK", res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["platform", "total_revenue_usd"]
    assert df.count() > 0
