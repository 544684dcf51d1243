"""The operator queries on the smallest driver tables, against SQL where there is some."""

import pytest

import __spark_entry__ as driver
from oracle_compare import compare, connect
from ratingloom.llm import queries

FOLDER = "/root/testdata/sf0.001"


def test_registered_once_per_operator():
    names = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert names == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    result = driver.queries()[name](spark, FOLDER)
    assert compare(result, connect(FOLDER), driver.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["op2_licence_scan", "op7_source_mix", "op10_quality_rules"])
def test_native_queries_run_no_python(spark, name):
    plan = driver.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
