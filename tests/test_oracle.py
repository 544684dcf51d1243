"""Every catalogue query against DuckDB on the smallest driver tables."""

import pytest

import __spark_entry__ as driver
from oracle_compare import compare, connect
from ratingloom import catalog, oracle

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.oracle_sql())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, con, name):
    result = driver.queries()[name](spark, FOLDER)
    assert compare(result, con, driver.oracle_sql()[name]) is None
    plan = result._jdf.queryExecution().executedPlan().toString()
    for product in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert product not in plan


def test_entry_returns_rows(spark):
    result = driver.entry(spark)
    assert result.columns == ["user_id", "status", "rank", "item_idx", "predicted_rating", "movieId", "title"]
    assert result.count() > 0
