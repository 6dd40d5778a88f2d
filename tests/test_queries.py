"""The registered queries: plans, and results against DuckDB on the smallest sample."""

import os
import re

import pytest

import __spark_entry__ as contract
from checks.compare import differences, duck
from checks.oracle import ORACLE
from checks.queries import QUERIES

FOLDER = os.environ.get("SAMPLE_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no sample tables")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_contract(spark):
    assert set(ORACLE) == set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == [
        "store_id", "sku_erp", "product_name", "revenue_mxn", "cost_mxn", "margin_mxn", "margin_pct"
    ]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_result(spark, connection, name):
    found, rows = differences(spark, connection, FOLDER, name)
    assert found == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, name):
    """No cross or nested-loop join and no Python in any plan, also when nothing may be broadcast."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        df = contract.queries()[name](spark, FOLDER)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(limit, before)
    assert not re.search(r"CartesianProduct|NestedLoop|EvalPython|MapInPandas|BroadcastHashJoin", plan)
