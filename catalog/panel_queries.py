"""Change, moving statistics, ranks and benchmarks on the fact panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import panels as P
from catalog.registry import query, rounded
from catalog.sql import r, sql
from panelkit.functions import classify as C
from panelkit.functions import numeric as N
from panelkit.operators import hotgroups
from panelkit.operators import windows as W
from panelkit.operators.clean import drop_incomplete, latest_flag, latest_period_rows
from panelkit.operators.link import link_population, linked_flag
from panelkit.session import materialise
from panelkit.spec import PanelSpec

OVER = "partition by entity order by period"


@query("panel_enriched", sql(f"""
select entity, period, {r('value', 2)} as value, {r('bm', 4)} as benchmark,
       {r('value - lag(value) over s', 2)} as yoy_change,
       {r('case when lag(value) over s > 0 then (value - lag(value) over s) / lag(value) over s * 100 end', 4)} as yoy_pct_change,
       {r('avg(value) over (s rows between 2 preceding and 2 following)', 4)} as rolling_avg,
       rank() over (partition by period order by value desc nulls first) as rate_rank,
       {r('value - bm', 4)} as gap, {r('value / bm', 2)} as ratio,
       case when value > lag(value) over s then 'Increasing' when value < lag(value) over s then 'Decreasing' else 'Stable' end as trend,
       case when value > bm * 1.1 then 'Significantly Above National' when value > bm then 'Above National'
            when value < bm * 0.9 then 'Significantly Below National' when value < bm then 'Below National'
            else 'At National Rate' end as comparison
from (select *, cast(sum(cents) over (partition by period) as double) / count(*) over (partition by period) / 100 as bm from p1)
window s as ({OVER})
"""))
def panel_enriched(spark, sf):
    """The flagship: two window shuffles over a panel aggregated from four tables."""
    p = P.P1
    df = W.yoy(P.p1(spark, sf), p).withColumn("rolling_avg", W.rolling(p, 2, 2))
    # The rank sorts each year by value; the totals of the year then need no sort of their own.
    df = df.withColumn("rate_rank", W.rank_desc(p.cross, "value"))
    total, n = F.sum("cents").over(p.across()), F.count(F.lit(1)).over(p.across())
    df = df.withColumn("bm", total.cast("double") / n / 100)
    return df.select(
        "entity", "period", N.round_half_up("value", 2).alias("value"), N.round_half_up("bm", 4).alias("benchmark"),
        N.round_half_up("yoy_change", 2).alias("yoy_change"), N.round_half_up("yoy_pct_change", 4).alias("yoy_pct_change"),
        N.round_half_up("rolling_avg", 4).alias("rolling_avg"), "rate_rank",
        N.gap_to_benchmark("value", "bm", 4).alias("gap"), N.ratio_to_benchmark("value", "bm").alias("ratio"),
        C.trend_direction("yoy_change").alias("trend"),
        C.ci_comparison("value", F.col("bm") * 0.9, F.col("bm") * 1.1, "bm").alias("comparison"),
    )


CUSTOMER_SQL = """
select o_custkey, cast(year(o_orderdate) as integer) as period,
       cast(sum(cast(round(l_extendedprice * (1 - l_discount) * 100) as bigint)) as bigint) as cents
from lineitem join orders on l_orderkey = o_orderkey group by 1, 2
"""
CUSTOMER = PanelSpec("o_custkey", "period", "cents")


@query("yoy_change", f"""
select o_custkey, period, lag(cents) over s as prev_value, cents - lag(cents) over s as yoy_change,
       case when lag(period) over s = period - 1 then cents - lag(cents) over s end as adjacent_change
from ({CUSTOMER_SQL}) window s as (partition by o_custkey order by period)
""")
def yoy_change(spark, sf):
    """Customers skip years: a gap is spanned by default and refused on request."""
    df = P.revenue_by_customer(spark, sf).select("o_custkey", "period", "cents")
    near = W.yoy(df, CUSTOMER, require_adjacent=True).withColumnRenamed("yoy_change", "adjacent_change")
    return W.yoy(near, CUSTOMER).select("o_custkey", "period", "prev_value", "yoy_change", "adjacent_change")


@query("yoy_pct_change", sql(f"""
select entity, period,
       {r('case when lag(v) over s > 0 then (v - lag(v) over s) / lag(v) over s * 100 end', 1)} as pct_positive,
       {r('(v - lag(v) over s) / nullif(lag(v) over s, 0) * 100', 1)} as pct_nonzero
from (select entity, period, case when n_rows % 9 = 0 then 0.0 when n_rows % 8 = 0 then -value else value end as v from p1)
window s as ({OVER})
"""))
def yoy_pct_change(spark, sf):
    v = F.when(F.col("n_rows") % 9 == 0, 0.0).when(F.col("n_rows") % 8 == 0, -F.col("value")).otherwise(F.col("value"))
    df = P.p1(spark, sf).select("entity", "period", v.alias("value"))
    out = W.yoy(df, P.P1, pct_digits=1).withColumnRenamed("yoy_pct_change", "pct_positive")
    out = out.withColumn("pct_nonzero", N.pct_change("value", "prev_value", 1, "nonzero"))
    return out.select("entity", "period", "pct_positive", "pct_nonzero")


@query("rolling_central", sql(f"""
select entity, period, {r('avg(value) over (s rows between 2 preceding and 2 following)', 1)} as rolling_avg
from p1 window s as ({OVER})
"""))
def rolling_central(spark, sf):
    return P.p1(spark, sf).select("entity", "period", W.rolling(P.P1, 2, 2, digits=1).alias("rolling_avg"))


@query("rolling_stddev", sql(f"""
select entity, period, {r('stddev_pop(value) over (s rows between 2 preceding and 2 following)', 4)} as rolling_sd
from p1 window s as ({OVER})
"""))
def rolling_stddev(spark, sf):
    return P.p1(spark, sf).select("entity", "period", W.rolling(P.P1, 2, 2, "stddev_pop", 4).alias("rolling_sd"))


@query("rolling_trailing", sql(f"""
select entity, substance, harm, period,
       {r('avg(value) over (partition by entity, substance, harm order by period rows between 2 preceding and current row)', 1)} as rolling_avg
from p3
"""))
def rolling_trailing(spark, sf):
    return P.p3(spark, sf).select(*P.P3.key, W.rolling(P.P3, 2, 0, digits=1).alias("rolling_avg"))


@query("rolling_central_long", sql(f"""
select event_id, event_type, {r('lag(value) over s', 2)} as prev_value,
       {r('avg(value) over (s rows between 2 preceding and 2 following)', 4)} as rolling_avg,
       value > avg(value) over (s rows between 5 preceding and 1 preceding)
         + 2 * stddev_pop(value) over (s rows between 5 preceding and 1 preceding) + 1e-9
         and count(value) over (s rows between 5 preceding and 1 preceding) >= 5 as trailing_alarm
from events window s as (partition by event_type order by event_id)
"""))
def rolling_central_long(spark, sf):
    """Row frames over raw events: five series that grow with the table, each
    spread over many tasks."""
    df = P.table(spark, sf, "events").select("event_id", "event_type", "value")

    def measures(w):
        past = w.rowsBetween(-5, -1)
        limit = F.avg("value").over(past) + 2.0 * F.stddev_pop("value").over(past) + 1e-9
        return {
            "prev_value": F.lag("value").over(w),
            "rolling_avg": F.avg("value").over(w.rowsBetween(-2, 2)),
            "trailing_alarm": F.coalesce(F.col("value") > limit, F.lit(False)) & (F.count("value").over(past) >= 5),
        }

    out = hotgroups.over_long_series(df, ["event_type"], "event_id", 5, 2, measures, rows_per_piece=100_000)
    return out.select("event_id", "event_type", N.round_half_up("prev_value", 2).alias("prev_value"),
                      N.round_half_up("rolling_avg", 4).alias("rolling_avg"), "trailing_alarm")


@query("rank_desc", sql("""
select entity, period, rank() over (partition by period order by v desc nulls first) as rank_nulls_first,
       rank() over (partition by period order by v desc nulls last) as rank_nulls_last
from (select entity, period, case when n_rows % 7 <> 0 then round(value / 1000000) end as v from p1)
"""))
def rank_desc(spark, sf):
    """Missing values and ties both occur here."""
    v = F.when(F.col("n_rows") % 7 != 0, F.round(F.col("value") / 1000000))
    df = P.p1(spark, sf).select("entity", "period", v.alias("value"))
    return df.select("entity", "period", W.rank_desc(["period"], "value").alias("rank_nulls_first"),
                     W.rank_desc(["period"], "value", "last").alias("rank_nulls_last"))


@query("rank_desc_wide", f"""
select o_custkey, period, rank() over (partition by period order by cents desc) as rate_rank
from ({CUSTOMER_SQL})
""")
def rank_desc_wide(spark, sf):
    """All customers of a year ranked: cross-sections that grow with the data."""
    df = materialise(P.revenue_by_customer(spark, sf).select("o_custkey", "period", "cents"), "customers")
    return hotgroups.rank_desc_hot(df, ["period"], "cents", "rate_rank").drop("cents")


@query("benchmark_gap", sql(f"""
select a.entity, a.period, {r('b.value', 4)} as benchmark, {r('a.value - b.value', 2)} as gap,
       {r('a.value - coalesce(b.value, 0)', 1)} as gap_from_zero
from p1 a left join (select * from pt where entity = 'ALL' and period <> 1997) b on a.period = b.period
"""))
def benchmark_gap(spark, sf):
    """One year lacks a benchmark on purpose."""
    df = P.with_total(P.p1(spark, sf)).where((F.col("entity") != P.ALL) | (F.col("period") != 1997))
    out = W.attach_benchmark(df, P.P1, P.ALL, {"value": "bm"}).where(F.col("entity") != P.ALL)
    return out.select("entity", "period", N.round_half_up("bm", 4).alias("benchmark"),
                      N.gap_to_benchmark("value", "bm", 2).alias("gap"),
                      N.gap_to_benchmark("value", "bm", 1, "zero").alias("gap_from_zero"))


@query("benchmark_ratio", sql(f"""
select a.entity, a.substance, a.harm, a.period, {r('a.value / b.value', 2)} as ratio
from p3 a left join p3 b on b.entity = 'ASIA' and a.substance = b.substance and a.harm = b.harm and a.period = b.period and b.value > 0
where a.entity <> 'ASIA'
"""))
def benchmark_ratio(spark, sf):
    """One region serves as the benchmark of the others, per segment and priority."""
    df = W.attach_benchmark(P.p3(spark, sf), P.P3, "ASIA", {"value": "bm"}).where("entity <> 'ASIA'")
    return df.select(*P.P3.key, N.ratio_to_benchmark("value", "bm").alias("ratio"))


@query("benchmark_join", sql(f"""
select a.entity, a.period, {r('a.value - b.value', 2)} as gap from p1 a join p1 b on b.entity = 'NATION_0' and a.period = b.period
"""))
def benchmark_join(spark, sf):
    """The benchmark as a join, for cross-sections too large for a window."""
    df = materialise(P.p1(spark, sf), "p1")
    out = W.attach_benchmark(df, P.P1, P.FOCUS, {"value": "bm"}, strategy="join")
    return out.where("bm is not null").select("entity", "period", N.gap_to_benchmark("value", "bm", 2).alias("gap"))


@query("ci_comparison", sql("""
select a.entity, a.period,
       case when a.value > b.value * 1.1 then 'Significantly Above National' when a.value > b.value then 'Above National'
            when a.value < b.value * 0.9 then 'Significantly Below National' when a.value < b.value then 'Below National'
            else 'At National Rate' end as comparison
from pt a left join (select * from pt where entity = 'ALL' and period <> 1997) b on a.period = b.period
where a.entity <> 'ALL' or a.period <> 1997
"""))
def ci_comparison(spark, sf):
    df = P.with_total(P.p1(spark, sf)).where((F.col("entity") != P.ALL) | (F.col("period") != 1997))
    df = W.attach_benchmark(df, P.P1, P.ALL, {"value": "bm"})
    return df.select("entity", "period",
                     C.ci_comparison("value", F.col("bm") * 0.9, F.col("bm") * 1.1, "bm").alias("comparison"))


@query("trend_direction", sql(f"""
select entity, period, case when d > 0 then 'Increasing' when d < 0 then 'Decreasing' else 'Stable' end as trend,
       case when d > 0 then 'Increasing' when d < 0 then 'Decreasing' when d = 0 then 'Stable' else 'Unknown' end as trend_known
from (select entity, period, value - lag(value) over ({OVER}) as d from p1)
"""))
def trend_direction(spark, sf):
    df = W.yoy(P.p1(spark, sf), P.P1)
    return df.select("entity", "period", C.trend_direction("yoy_change").alias("trend"),
                     C.trend_direction("yoy_change", "Unknown").alias("trend_known"))


@query("severity_band", sql("""
select entity, substance, harm, period,
       case when x >= 2 then 'Crisis Level' when x >= 1.5 then 'Severely Elevated' when x >= 1 then 'Above National'
            when x < 1 then 'Below National' end as band4,
       case when x >= 5 then 'Extreme' when x >= 2 then 'Crisis Level' when x >= 1.5 then 'Severely Elevated'
            when x >= 1 then 'Above National' when x < 1 then 'Below National' end as band5
from (select *, value / lag(value) over (partition by entity, substance, harm order by period) as x from p3)
"""))
def severity_band(spark, sf):
    df = W.yoy(P.p3(spark, sf), P.P3).withColumn("x", N.guarded_ratio("value", "prev_value"))
    return df.select(*P.P3.key, C.severity_band("x").alias("band4"), C.severity_band("x", 5).alias("band5"))


@query("suppression_flag", sql("""
select r_name, event_type, period, coalesce(n < 10, false) as small10, n % 6 = 0 as no_rate,
       n % 6 = 0 or n < 5 as hidden
from p2r
"""))
def suppression_flag(spark, sf):
    rate = F.when(F.col("n") % 6 != 0, F.col("n").cast("double"))
    return P.p2_by_region(spark, sf).select(
        "r_name", "event_type", "period",
        N.suppress_small_cells(F.lit(1.0), "n", 10).alias("small10"),
        N.suppress_small_cells(rate).alias("no_rate"),
        N.suppress_small_cells(rate, "n", 5).alias("hidden"))


@query("rate_per_population", sql(f"""
select a.entity, a.period, {r('cast(a.n_rows as double) / b.population * 100000', 1)} as rate
from p1 a left join pt b on b.entity = 'ALL' and a.period = b.period
"""))
def rate_per_population(spark, sf):
    """Each count over the population of the benchmark in the same period."""
    df = materialise(P.with_total(P.p1(spark, sf)), "pt")
    out = link_population(df.where(F.col("entity") != P.ALL).drop("population"), df, {"period": "period"},
                          only=F.col("entity") == P.ALL)
    return out.select("entity", "period", N.rate_per(F.col("n_rows").cast("double"), "population").alias("rate"))


@query("population_link", sql(f"""
select a.r_name, a.event_type, a.period, b.pop as population, b.pop is not null as population_linked,
       {r('cast(a.n as double) / b.pop * 100000', 1)} as rate
from p2r a left join (select r_name, event_type, count(distinct user_id) as pop
  from events join customer on user_id = c_custkey join dim on c_nationkey = n_nationkey
  where event_type <> 'error' group by 1, 2) b on a.r_name = b.r_name and a.event_type = b.event_type
"""))
def population_link(spark, sf):
    """Users per region and type as the population; one type has none."""
    customer = P.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    users = P.table(spark, sf, "events").where("event_type <> 'error'").groupBy("event_type", "user_id").agg(
        F.count(F.lit(1)).alias("_n"))
    users = users.join(customer, F.col("user_id") == F.col("c_custkey")).join(
        P.nations(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
    pop = users.groupBy("r_name", "event_type").agg(F.count(F.lit(1)).alias("population"))
    out = link_population(P.p2_by_region(spark, sf), pop, {"r_name": "r_name", "event_type": "event_type"})
    return out.select("r_name", "event_type", "period", "population", linked_flag().alias("population_linked"),
                      N.rate_per(F.col("n").cast("double"), "population").alias("rate"))


@query("caveat_note", sql("""
select entity, period, period >= 1999 as after_event,
       case when period >= 1999 then 'Interpret with care: ' || entity end as note
from p1
"""))
def caveat_note(spark, sf):
    after = C.is_after_event("period", 1999)
    return P.p1(spark, sf).select("entity", "period", after.alias("after_event"),
                                  F.when(after, F.concat(F.lit("Interpret with care: "), "entity")).alias("note"))


@query("latest_period", sql(f"select entity, {r('value', 2)} as value from p1 where period = (select max(period) from p1)"))
def latest_period(spark, sf):
    df = materialise(P.p1(spark, sf), "p1")
    return latest_period_rows(df, "period").select("entity", N.round_half_up("value", 2).alias("value"))


@query("latest_flag", sql("""
select entity, period, (select max(period) from p1) as latest_period, period = (select max(period) from p1) as is_latest from p1
"""))
def latest_flag_query(spark, sf):
    return latest_flag(materialise(P.p1(spark, sf).select("entity", "period"), "p1"), "period")


@query("latest_per_series", sql(f"""
select entity, substance, harm, period, {r('value', 2)} as value, {r('prev', 2)} as prev_value
from (select *, lag(value) over s as prev, max(period) over (partition by entity, substance, harm) as last
      from p3 window s as (partition by entity, substance, harm order by period)) where period = last
"""))
def latest_per_series(spark, sf):
    df = W.previous_per_series(P.p3(spark, sf), P.P3)
    return rounded(df.select(*P.P3.key, "value", "prev_value"), 2)


@query("trajectory", sql(f"""
select entity, first_period, {r('fv', 2)} as first_value, last_period, {r('lv', 2)} as last_value,
       {r('lv - fv', 2)} as total_change, {r('(lv - fv) / fv * 100', 4)} as total_pct_change
from (select entity, min(period) as first_period, arg_min(value, period) as fv, max(period) as last_period,
             arg_max(value, period) as lv from p1 group by entity)
"""))
def trajectory(spark, sf):
    df = W.trajectory(P.p1(spark, sf), P.P1)
    return df.select("entity", "first_period", N.round_half_up("first_value", 2).alias("first_value"), "last_period",
                     N.round_half_up("last_value", 2).alias("last_value"), N.round_half_up("total_change", 2).alias("total_change"),
                     N.round_half_up("total_pct_change", 4).alias("total_pct_change"))


CONVERGENCE_SQL = """
select entity, count(*) as common_periods, arg_min(gap, period) as gf, arg_max(gap, period) as gl
from (select a.entity, a.period, a.value - b.value as gap from p1 a join pt b on b.entity = 'ALL' and a.period = b.period)
group by entity
"""


@query("convergence", sql(f"""
select entity, common_periods, {r('gf', 2)} as gap_first, {r('gl', 2)} as gap_last, {r('gl - gf', 2)} as gap_change,
       case when gl - gf < 0 then 'Converging' else 'Diverging' end as label,
       case when abs(gl) - abs(gf) < 0 then 'Converging' else 'Diverging' end as absolute_label
from ({CONVERGENCE_SQL})
"""))
def convergence(spark, sf):
    """The signed rule, and the same by absolute distance."""
    out = W.convergence(P.with_total(P.p1(spark, sf)), P.P1, P.ALL)
    absolute = F.when(F.abs("gap_last") - F.abs("gap_first") < 0, "Converging").otherwise("Diverging")
    return rounded(out.withColumn("absolute_label", absolute), 2)


@query("convergence_absolute", sql(f"""
select entity, {r('abs(gl) - abs(gf)', 2)} as gap_change,
       case when abs(gl) - abs(gf) < 0 then 'Converging' else 'Diverging' end as label
from ({CONVERGENCE_SQL})
"""))
def convergence_absolute(spark, sf):
    out = W.convergence(P.with_total(P.p1(spark, sf)), P.P1, P.ALL, absolute=True)
    return rounded(out.select("entity", "gap_change", "label"), 2)


STATS_SQL = sql(f"""
select entity, period, {r('avg(value) over e', 4)} as mean_rate, {r('min(value) over e', 2)} as min_rate,
       {r('max(value) over e', 2)} as max_rate, count(*) over e as data_points
from p1 window e as (partition by entity)
""")


def _stats(df):
    return df.select("entity", "period", N.round_half_up("mean_rate", 4).alias("mean_rate"),
                     N.round_half_up("min_rate", 2).alias("min_rate"), N.round_half_up("max_rate", 2).alias("max_rate"), "data_points")


@query("series_stats", STATS_SQL)
def series_stats(spark, sf):
    return _stats(W.series_stats(P.p1(spark, sf), P.P1))


@query("series_stats_join", STATS_SQL)
def series_stats_join(spark, sf):
    """The same by aggregate and join, for series too long for one task."""
    return _stats(W.series_stats(materialise(P.p1(spark, sf), "p1"), P.P1, strategy="join"))


@query("peak_period_window", sql("""
select category, period::varchar as period, first_value(period) over (partition by category order by n desc nulls first, period)::varchar as peak_period
from p2
"""))
def peak_period_window(spark, sf):
    p = PanelSpec("category", "period", "n")
    df = P.p2(spark, sf).withColumn("peak_period", W.peak_period(p))
    return df.select("category", F.col("period").cast("string").alias("period"), F.col("peak_period").cast("string").alias("peak_period"))


@query("priority_dedup", sql("""
select entity, period, cents, source from p6
qualify row_number() over (partition by entity, period order by case source when 'snapshot' then 1 else 2 end) = 1
"""))
def priority_dedup(spark, sf):
    df = P.p6(spark, sf).select("entity", "period", "cents", "source")
    return W.priority_dedup(df, ["entity", "period"], "source", ["snapshot", "series"])


@query("priority_dedup_rows", """
select o_custkey, o_orderkey, o_orderstatus from orders
qualify row_number() over (partition by o_custkey order by case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end, o_orderkey) = 1
""")
def priority_dedup_rows(spark, sf):
    """One order per customer by status: copies are limited before the shuffle."""
    df = P.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return W.priority_dedup(df, ["o_custkey"], "o_orderstatus", ["F", "O", "P"], ["o_orderkey"])


@query("period_filter", sql(f"select entity, period, {r('value', 2)} as value from p1 where period >= 1998"))
def period_filter(spark, sf):
    """The bound is put on the order date, so the scan skips row groups."""
    return rounded(P.p1(spark, sf, first_year=1998).select("entity", "period", "value"), 2)


@query("drop_incomplete", f"""
select * from (select o_custkey, period, cents, cents - lag(cents) over s as yoy_change
  from ({CUSTOMER_SQL}) window s as (partition by o_custkey order by period)) where yoy_change is not null
""")
def drop_incomplete_query(spark, sf):
    """Customer years whose change is known."""
    df = W.yoy(P.revenue_by_customer(spark, sf).select("o_custkey", "period", "cents"), CUSTOMER)
    return drop_incomplete(df, ["prev_value", "yoy_change"]).select("o_custkey", "period", "cents", "yoy_change")


@query("focus_peers", sql(f"""
select entity, period, {r('value', 2)} as value from pt where entity in ('NATION_0', 'NATION_1', 'NATION_2', 'ALL')
"""))
def focus_peers(spark, sf):
    df = P.with_total(P.p1(spark, sf)).where(F.col("entity").isin("NATION_0", "NATION_1", "NATION_2", P.ALL))
    return rounded(df.select("entity", "period", "value"), 2)
