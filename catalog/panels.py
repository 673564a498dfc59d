"""Panels over the given fact tables, on which the registered queries run.

Facts are aggregated before anything else happens to them: each step combines
rows on the map side, so a key that holds a large share of a table arrives at
the shuffle as one row per task. Money is summed as whole cents, which makes
every later result independent of the order of addition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.spec import PanelSpec

P1 = PanelSpec("entity", "period", "value")
P2 = PanelSpec("category", "period", "value")
P3 = PanelSpec("entity", "period", "value", ("substance", "harm"))

FOCUS = "NATION_0"
ALL = "ALL"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def cents(amount: Column) -> Column:
    """Whole cents, halves up. Rounding by floor stays in generated code, where
    ``round`` of a double goes through a decimal object per row."""
    return F.floor(amount * 100 + 0.5)


def revenue_by_customer(spark: SparkSession, sf: str, first_year: int | None = None) -> DataFrame:
    """Revenue cents and line count per customer and order year.

    ``first_year`` becomes a bound on the order date, which the scan can use.

    Lines are summed per order before the join, orders per customer and year
    after it. Both sides of the join then hold one row per order, so no order
    and no customer can skew it.
    """
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    per_order = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sum(cents(net)).alias("cents"), F.count(F.lit(1)).alias("n_rows"))
    orders = table(spark, sf, "orders")
    if first_year is not None:
        orders = orders.where(F.col("o_orderdate") >= F.lit(f"{first_year}-01-01").cast("timestamp_ntz"))
    orders = orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("period"))
    joined = per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_custkey", "period").agg(F.sum("cents").alias("cents"), F.sum("n_rows").alias("n_rows"))


def nations(spark: SparkSession, sf: str) -> DataFrame:
    region = table(spark, sf, "region")
    nation = table(spark, sf, "nation")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")


def p1(spark: SparkSession, sf: str, first_year: int | None = None) -> DataFrame:
    """Revenue by nation and year; population is the number of buying customers.

    There is one row per customer and year before the last step, so counting
    rows counts customers and no distinct aggregate is needed.
    """
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    rows = revenue_by_customer(spark, sf, first_year).join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy(F.col("n_name").alias("entity"), "period").agg(
        F.sum("cents").alias("cents"), F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("population"),
    ).withColumn("value", F.col("cents").cast("double") / 100)


def p1_by_region(spark: SparkSession, sf: str) -> DataFrame:
    """P1 with the region of each nation."""
    dim = nations(spark, sf).select(F.col("n_name").alias("entity"), F.col("r_name").alias("region_group"))
    return p1(spark, sf).join(dim, "entity")


def with_total(panel: DataFrame) -> DataFrame:
    """P1 plus a benchmark entity: the mean revenue over the nations of a year.

    One grouping-sets aggregate gives both levels, so the facts behind the
    panel are read once.
    """
    both = panel.groupingSets([["period", "entity"], ["period"]], "period", "entity").agg(
        F.sum("cents").alias("cents"), F.sum("n_rows").alias("n_rows"), F.sum("population").alias("population"),
        F.count(F.lit(1)).alias("_n"), F.grouping("entity").alias("_total"))
    return both.select(
        F.when(F.col("_total") == 1, ALL).otherwise(F.col("entity")).alias("entity"), "period", "cents", "n_rows",
        "population",
        F.when(F.col("_total") == 1, F.col("cents").cast("double") / F.col("_n") / 100)
        .otherwise(F.col("cents").cast("double") / 100).alias("value"),
    )


def p2(spark: SparkSession, sf: str) -> DataFrame:
    """Events and value by type and day."""
    rows = table(spark, sf, "events").groupBy(
        F.col("event_type").alias("category"), F.to_date("ts").alias("period"),
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(cents(F.col("value"))).alias("cents"))
    return rows.withColumn("value", F.col("n").cast("double"))


def p2_by_region(spark: SparkSession, sf: str) -> DataFrame:
    """Events by type, day and region of the user; the day as a number yyyymmdd.

    Events are counted per user, type and day before the join, so a very
    active user does not skew it.
    """
    day = F.to_date("ts")
    per_user = table(spark, sf, "events").groupBy(
        "user_id", "event_type", (F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).alias("period"),
    ).agg(F.count(F.lit(1)).alias("n"))
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    dim = nations(spark, sf)
    rows = per_user.join(customer, F.col("user_id") == F.col("c_custkey")).join(
        dim, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("r_name", "event_type", "period").agg(F.sum("n").alias("n"))


def p3(spark: SparkSession, sf: str) -> DataFrame:
    """Order value by region, market segment, priority and year.

    Orders are close to unique per customer, priority and year, so summing them
    before the join would shuffle them twice and shrink nothing. A hot
    customer's rows are split by adaptive execution, and summed per task.
    """
    orders = table(spark, sf, "orders").select("o_custkey", "o_totalprice", "o_orderpriority", F.year("o_orderdate").alias("period"))
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    dim = nations(spark, sf)
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        dim, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy(
        F.col("r_name").alias("entity"), F.col("c_mktsegment").alias("substance"),
        F.col("o_orderpriority").alias("harm"), "period",
    ).agg(F.sum(cents(F.col("o_totalprice"))).alias("cents"), F.count(F.lit(1)).alias("n_rows")).withColumn(
        "value", F.col("cents").cast("double") / 100)


def p4(spark: SparkSession, sf: str) -> DataFrame:
    """Lines by ship year, line status and return flag."""
    return table(spark, sf, "lineitem").groupBy(
        F.year("l_shipdate").alias("period"), F.col("l_linestatus").alias("category"),
        F.col("l_returnflag").alias("stratum"),
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(cents(F.col("l_extendedprice"))).alias("cents"))


def year_text(period: Column) -> Column:
    """Years as publishers print them: a part of a year, an asterisk, or a span."""
    text = period.cast("string")
    return (
        F.when(period == 2001, "2001 (Jan to Aug)")
        .when(period % 2 == 0, F.concat(text, F.lit("*")))
        .otherwise(F.concat(text, F.lit("–"), (period + 1).cast("string")))
    )


def money_text(n_rows: Column, amount: Column) -> Column:
    """Cents with thousands separators, and withheld cells."""
    return (
        F.when(n_rows % 7 == 0, "Suppr.").when(n_rows % 11 == 0, "-")
        .when(n_rows % 13 != 0, F.format_number(amount, 0))
    )


def p5(spark: SparkSession, sf: str) -> DataFrame:
    """P1 as raw published text."""
    return p1(spark, sf).select(
        F.concat(F.lit("  "), "entity", F.lit(" ")).alias("geo"),
        year_text(F.col("period")).alias("time_frame"),
        money_text(F.col("n_rows"), F.col("cents")).alias("value"),
        "entity", "period", "cents", "n_rows", "population",
    )


def p6(spark: SparkSession, sf: str) -> DataFrame:
    """P1 from two sources: a series of all years, and snapshots of three.

    Each row is copied by an array of its sources, so the panel is built once.
    """
    sources = F.when(F.col("period").isin(1995, 1997, 1999), F.array(F.lit("series"), F.lit("snapshot"))).otherwise(
        F.array(F.lit("series")))
    return p1(spark, sf).withColumn("source", F.explode(sources))
