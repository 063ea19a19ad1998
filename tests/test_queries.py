"""Every registered query equals its SQL on the smallest test set."""

import pytest
from compare import connect, difference
from conftest import SF_DIR

import __spark_entry__ as registry
from claimstar_oracle.published import PUBLISHED

# Queries of the pipeline operators, if they are there, have tests of their own.
OTHERS = {*registry.llm.queries(), "pipeline"} if registry.llm else set()
QUERIES = {name: query for name, query in registry.queries().items() if name not in OTHERS}
SQL = {name: sql for name, sql in registry.oracle_sql().items() if name not in OTHERS}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert difference(spark, duck, SF_DIR, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", sorted(PUBLISHED))
def test_published_columns_and_order(spark, name):
    frame = registry.star(spark, SF_DIR).table(name)
    assert frame.columns == PUBLISHED[name]


def test_entry(spark):
    frame = registry.entry(spark)
    assert frame.columns == PUBLISHED["fact_claims"]
    assert frame.limit(1).count() == 1
