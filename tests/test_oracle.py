"""Every registered query against SQL on the same tables."""

import pytest

import __spark_entry__ as contract
from oracle import ORACLE
from terratally.plans.operator_queries import OPERATORS
from terratally.plans.questions import QUESTIONS
from tests.compare import connect, differences, duckdb_result, spark_result
from tests.conftest import TESTDATA

SQL = ORACLE
QUERIES = {name: query for name, query in contract.queries().items() if name in SQL}


@pytest.fixture(scope="module")
def tables():
    return connect(TESTDATA)


def test_every_query_has_sql():
    assert set(SQL) == {*QUESTIONS, *OPERATORS} == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_result_as_sql(spark, tables, name):
    found = spark_result(QUERIES[name](spark, TESTDATA))
    assert differences(found, duckdb_result(tables, SQL[name])) == ""


def test_entry_returns_rows(spark):
    assert contract.entry(spark).count() == 5
