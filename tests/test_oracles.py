"""Every query against its SQL equivalent on the smallest tables, and its plan."""

from pathlib import Path

import check
import pytest

import __spark_entry__ as entry
from shopstrata.testbed.oracles import ORACLES
from shopstrata.testbed.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry.queries().keys() and entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, name):
    assert check.compare(spark, SF, name) is None


@pytest.mark.parametrize(
    "name", ["daily_summary_full", "gold_order_items", "gold_returns", "dim_products_join", "dim_customers_region"]
)
def test_plans_stay_in_the_engine(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert unwanted not in plan


def test_the_summary_shuffles_each_input_once(spark):
    """The reduction by item reuses the order partitioning of the join before it."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large to broadcast
    try:
        plan = entry.queries()["daily_summary_full"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 3  # two join sides, then the groups
