"""Every registered query against its SQL on the smallest tables.

Broadcast joins are switched off, so that the joins run as they would between
large tables, and every plan is searched for what does not scale.
"""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from tools.check import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.catalog.QUERIES, entry.catalog.ORACLES


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.fixture(autouse=True)
def large_tables(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def looks_scalable(name):
    def inspect(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        for bad in ("CartesianProduct", "NestedLoopJoin", "BroadcastHashJoin", "BatchEvalPython"):
            assert bad not in plan
        assert name.startswith("forecast_") or "Pandas" not in plan
        # A window without partition keys would pull everything into one task.
        assert not re.search(r"Window \[.*\], *\[\], *\[", plan)

    return inspect


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], ORACLES.get(name), SF, looks_scalable(name)) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows_and_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == entry.entry(spark).columns
