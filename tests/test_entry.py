"""Driver contract: entry smoke, every query vs its DuckDB oracle, plan hygiene."""

import pytest

from __spark_entry__ import entry
from conftest import SF001
from oracle_compare import compare
from scrubline.plans.driver_queries import QUERIES
from scrubline.plans.oracle_sql import ORACLE_SQL

BAD_NODES = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["l_suppkey", "year", "total_quantity", "ranking"]


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    info = compare(spark, SF001, name, QUERIES[name], ORACLE_SQL[name])
    assert info["ok"], info


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_python_udf_or_cartesian(spark, name):
    df = QUERIES[name](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in BAD_NODES:
        assert node not in plan, (name, node)
