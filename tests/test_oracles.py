"""Every registered query at the smallest scale against its SQL counterpart."""

import re

import pytest
from compare import compare, connect

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"
LLM = re.compile(r"op\d+_|pipeline$")
QUERIES = {k: v for k, v in driver.queries().items() if not LLM.match(k)}
ORACLES = {k: v for k, v in driver.oracle_sql().items() if not LLM.match(k)}
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_no_query_lacks_an_oracle():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    verdict, rows = compare(spark, con, SF, name, QUERIES[name], ORACLES.get(name))
    assert verdict == ("rows only" if name in ROWS_ONLY else "equal")
    assert rows >= 0


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["activity_year", "state_code", "county_code", "count"]
    assert result.count() > 0
