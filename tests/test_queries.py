"""Every registered query against its SQL, and the shape of the plans behind the main ones."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare
from stratamart.plans import queries as registered

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("name", list(queries()))
def test_query_equals_its_sql(spark, name):
    outcome, _ = compare(spark, FOLDER, name, queries()[name], oracle_sql().get(name))
    assert outcome.startswith(("equal", "rows only")), outcome


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["CalendarDate", "StoreCode", "TotalOrders", "TotalQuantity", "TotalRevenueUSD", "TotalMarginUSD"]
    assert df.count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["fact_sales", "agg_daily_store", "agg_category", "clean_orders", "asof_fx", "pit_customer", "scd2_users"])
def test_plans_stay_built_in_and_never_cross(spark, name):
    plan = plan_of(queries()[name](spark, FOLDER))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas", "BatchEvalPython"):
        assert unwanted not in plan


def test_incremental_filter_reaches_the_scan(spark):
    plan = plan_of(registered.incremental_scan(spark, FOLDER))
    assert "GreaterThan(ts" in plan


def test_scans_read_only_the_columns_they_use(spark):
    plan = plan_of(registered.dim_date(spark, FOLDER))
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan


def test_daily_sales_count_orders_without_shuffling_order_ids(spark):
    plan = plan_of(registered.agg_daily_store(spark, FOLDER))
    assert "count(distinct" not in plan.lower()
