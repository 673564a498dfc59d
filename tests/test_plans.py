"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

import catalog

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def at_scale(spark):
    """Plan as for tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_flagship_plan(at_scale):
    plan = plan_of(catalog.QUERIES["panel_enriched"](at_scale, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in plan
    # Fact side: lines and orders by order, lines by customer and year, then customers; panel side: two for all windows.
    assert plan.count("Exchange hashpartitioning") == 10
    assert plan.count("partial_sum") == 3
    assert len(re.findall(r"\bWindow \[", plan)) == 3 and len(re.findall(r"Sort \[period", plan)) == 1


def test_period_bound_reaches_the_scan(spark):
    plan = plan_of(catalog.QUERIES["period_filter"](spark, SF))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate,1998-01-01", plan)


def test_range_check_reaches_the_scan(spark):
    assert "EqualTo(l_returnflag,A)" in plan_of(catalog.QUERIES["dq_range"](spark, SF))


def test_dedup_limits_groups_before_the_shuffle(spark):
    plan = plan_of(catalog.QUERIES["priority_dedup_rows"](spark, SF))
    assert re.search(r"WindowGroupLimit \[.*Final[\s\S]*Exchange[\s\S]*WindowGroupLimit \[.*Partial", plan)
    # After an aggregate on the same keys no further shuffle is needed at all.
    assert plan_of(catalog.QUERIES["priority_dedup"](spark, SF)).count("Exchange hashpartitioning(entity") == 0


def test_latest_flag_has_no_global_window(spark):
    plan = plan_of(catalog.QUERIES["latest_flag"](spark, SF))
    assert "Subquery" in plan and "Window" not in plan
