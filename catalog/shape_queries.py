"""Aggregates, pivots, summaries and snapshot reports on the fact panels."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog import panels as P
from catalog.registry import query, rounded
from catalog.sql import cte, exact, r, sql
from panelkit.functions import classify as C
from panelkit.functions import numeric as N
from panelkit.functions.text import show_number
from panelkit.operators import shape as S
from panelkit.operators import windows as W
from panelkit.operators.clean import latest_period_rows
from panelkit.session import materialise
from panelkit.spec import PanelSpec


def shown(expr: str, digits: int, signed: bool = False) -> str:
    size = f"cast(abs({exact(expr, digits)}) as varchar)"
    return f"(case when {expr} < 0 then '-' else '{'+' if signed else ''}' end || {size})"


@query("combine_strata", sql("""
select period, category, cast(sum(n) as bigint) as n, cast(sum(cents) as bigint) as cents, count(*) as strata from p4 group by 1, 2
"""))
def combine_strata(spark, sf):
    return S.combine_strata(P.p4(spark, sf), ["period", "category"], ["n", "cents"])


cte("slice", """
select a.*, r_name, (select max(value) from pt where entity = 'ALL' and period = (select max(period) from p1)) as national,
       row_number() over (order by a.value desc, a.entity) as rn, count(*) over () as members
from p1 a join dim on a.entity = n_name where a.period = (select max(period) from p1)
""")


def latest_slice(spark, sf):
    """The last year of P1 with regions and the benchmark; one row per nation."""
    panel = W.attach_benchmark(P.with_total(P.p1(spark, sf)), P.P1, P.ALL, {"value": "national"})
    panel = materialise(panel.where(F.col("entity") != P.ALL), "slice")
    dim = P.nations(spark, sf).select(F.col("n_name").alias("entity"), "r_name")
    return latest_period_rows(panel, "period").join(dim, "entity")


@query("snapshot_ranking", sql(f"""
select entity, {shown('value / 1000000', 1)} as rate_text, rn as national_rank, members + 1 - rn as outcome_rank,
       case when rn <= 3 then 'High Burden' when rn >= 11 then 'Low Burden' else 'Moderate Burden' end as burden,
       entity = 'NATION_0' as is_focus,
       {shown('(value - national) / 1000000', 1, True)} as gap_text
from slice
"""))
def snapshot_ranking(spark, sf):
    rows = latest_slice(spark, sf)
    w = Window.partitionBy("period")
    rank = F.row_number().over(w.orderBy(F.col("value").desc(), "entity")).cast("bigint")
    rows = rows.withColumns({"national_rank": rank, "members": F.count(F.lit(1)).over(w)})
    return rows.select(
        "entity", show_number(F.col("value") / 1000000, 1).alias("rate_text"), "national_rank",
        C.outcome_rank("national_rank", F.col("members")).alias("outcome_rank"),
        C.burden_category("national_rank").alias("burden"), C.flag_in("entity", [P.FOCUS]).alias("is_focus"),
        show_number((F.col("value") - F.col("national")) / 1000000, 1, signed=True).alias("gap_text"))


@query("region_average", sql(f"select r_name as region_group, {r('avg(value)', 4)} as avg_value from slice group by 1"))
def region_average(spark, sf):
    rows = latest_slice(spark, sf).withColumnRenamed("r_name", "region_group")
    return rounded(S.region_average(rows, ["region_group"], "value"))


@query("gap_list", sql(f"""
select entity, {r('value - national', 2)} as gap,
       case when value - national > 2000000 then 'substantially above' when value - national > 0 then 'above' else 'at or below' end as narrative
from slice
"""))
def gap_list(spark, sf):
    rows = latest_slice(spark, sf).withColumn("gap", N.gap_to_benchmark("value", "national"))
    return rounded(rows.select("entity", "gap", C.gap_narrative("gap", 2_000_000).alias("narrative")).orderBy("gap"), 2)


@query("pre_post", sql(f"""
select entity, {r('avg(value) filter (period between 1996 and 1998)')} as pre_avg,
       {r('avg(rk) filter (period between 1996 and 1998)')} as pre_rank,
       count(*) filter (period between 1996 and 1998) as pre_periods,
       {r('avg(value) filter (period >= 1999)')} as post_avg, {r('avg(rk) filter (period >= 1999)')} as post_rank,
       count(*) filter (period >= 1999) as post_periods,
       {r('(avg(value) filter (period >= 1999) - avg(value) filter (period between 1996 and 1998)) / avg(value) filter (period between 1996 and 1998) * 100')} as pct_change
from (select *, rank() over (partition by period order by value desc) as rk from p1) group by entity
"""))
def pre_post(spark, sf):
    df = P.p1(spark, sf).withColumn("rk", W.rank_desc(["period"], "value"))
    return rounded(S.pre_post(df, P.P1, "rk", (1996, 1998), 1999))


@query("peak_period", sql(f"""
select category, n as peak_value, period::varchar as peak_period from p2
qualify row_number() over (partition by category order by n desc, period) = 1
"""))
def peak_period(spark, sf):
    p = PanelSpec("category", "day", "n")
    df = P.p2(spark, sf).withColumn("day", F.unix_date("period"))
    return S.peak_per_series(df, p).select("category", "peak_value", F.date_from_unix_date("peak_period").cast("string").alias("peak_period"))


YEARS = list(range(1995, 2002))


@query("pivot_heatmap", sql(f"""
select entity, {', '.join(f"{r(f'avg(value) filter (period = {t})', 2)} as p{t}" for t in YEARS)} from p1 group by entity
"""))
def pivot_heatmap(spark, sf):
    return rounded(S.pivot_heatmap(P.p1(spark, sf), P.P1, YEARS), 2)


@query("pivot_gap", sql(f"""
select a.period, {r('a.value', 2)} as focus_value, {r('b.value', 2)} as benchmark_value, {r('a.value - b.value', 2)} as gap
from pt a join pt b on a.period = b.period and b.entity = 'ALL' where a.entity = 'NATION_0'
"""))
def pivot_gap(spark, sf):
    return rounded(S.pivot_gap(P.with_total(P.p1(spark, sf)), P.P1, P.FOCUS, P.ALL), 2)


@query("coverage", sql("""
select r_name, event_type, count(*) as n_rows, count(distinct period) as n_periods, min(period) as first_period,
       max(period) as last_period, bool_or(n > 12) as has_large
from p2r group by 1, 2
"""))
def coverage(spark, sf):
    df = P.p2_by_region(spark, sf).withColumn("large", F.when(F.col("n") > 12, F.col("n")))
    return S.coverage(df, PanelSpec("r_name", "period", "n", ("event_type",)), ["large"])


@query("coverage_grid", sql("""
select distinct o_custkey, cast(year(o_orderdate) as integer) as period from orders
"""))
def coverage_grid(spark, sf):
    df = P.table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("period"))
    return S.coverage_grid(df, PanelSpec("o_custkey", "period", "o_custkey"))


@query("selector_values", "select distinct c_mktsegment from customer where c_mktsegment is not null")
def selector_values(spark, sf):
    return S.sorted_values(P.table(spark, sf, "customer"), "c_mktsegment")


@query("level_counts", """
select 'o_orderpriority' as "column", o_orderpriority as level, count(*) as n from orders group by 2
union all select 'o_orderstatus', o_orderstatus, count(*) from orders group by 2
union all select 'year', cast(year(o_orderdate) as varchar), count(*) from orders group by 2
""")
def level_counts(spark, sf):
    df = P.table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    return S.level_counts(df, ["o_orderpriority", "o_orderstatus", "year"])


PROFILED = ("l_quantity", "l_extendedprice", "l_discount")


@query("profile", " union all ".join(f"""
select '{c}' as "column", {r(f'min({c})')} as min, {r(f'quantile_cont({c}, 0.25)')} as q1,
       {r(f'quantile_cont({c}, 0.5)')} as median, {r(f'avg({c})')} as mean, {r(f'quantile_cont({c}, 0.75)')} as q3,
       {r(f'max({c})')} as max, count({c}) as n, count(*) - count({c}) as n_missing
from lineitem""" for c in PROFILED))
def profile(spark, sf):
    """Exact quartiles of whole fact columns, without holding a column in one task."""
    return rounded(S.profile(P.table(spark, sf, "lineitem"), PROFILED))


def box_sql(key: str, value: str, table: str) -> str:
    return f"""
select {key}, {r('lo')} as low, {r('a')} as q1, {r('m')} as median, {r('b')} as q3, {r('hi')} as high,
       {r('a - (b - a) * 1.5')} as lower_fence, {r('b + (b - a) * 1.5')} as upper_fence
from (select {key}, min({value}) as lo, quantile_cont({value}, 0.25) as a, quantile_cont({value}, 0.5) as m,
             quantile_cont({value}, 0.75) as b, max({value}) as hi from {table} group by {key})
"""


@query("box_stats", sql(box_sql("entity", "value", "p1")))
def box_stats(spark, sf):
    return rounded(S.box_stats(P.p1(spark, sf), ["entity"], "value"))


@query("box_stats_hot", box_sql("event_type", "value", "events"))
def box_stats_hot(spark, sf):
    """Five groups that hold the whole event table."""
    return rounded(S.box_stats(P.table(spark, sf, "events"), ["event_type"], "value", strategy="hot"))


@query("ordered_list_hot", sql("""
select event_type, count(*) as n, length(string_agg(event_id || ': ' || user_id, ' | ' order by value desc nulls last, event_id || ': ' || user_id desc)) as n_chars,
       md5(string_agg(event_id || ': ' || user_id, ' | ' order by value desc nulls last, event_id || ': ' || user_id desc)) as digest
from events group by event_type
"""))
def ordered_list_hot(spark, sf):
    """The digest of all events of a type in order of their value: five lines that hold the whole table."""
    df = P.table(spark, sf, "events").withColumn("key", F.col("event_id").cast("string"))
    lists = S.ordered_list(df, ["event_type"], "key", "value", F.col("user_id").cast("string"), strategy="hot")
    counts = df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(lists, "event_type").select(
        "event_type", "n", F.length("listing").cast("bigint").alias("n_chars"), F.md5(F.col("listing").cast("binary")).alias("digest"))


@query("ordered_list", sql(f"""
select period, string_agg(entity || ': ' || {shown('value / 1000000', 1)}, ' | ' order by value desc) as listing
from p1 where entity in ('NATION_0', 'NATION_1', 'NATION_2') group by period
"""))
def ordered_list(spark, sf):
    """The peer entities' values of each year in one line."""
    df = P.p1(spark, sf).where(F.col("entity").isin("NATION_0", "NATION_1", "NATION_2"))
    return S.ordered_list(df, ["period"], "entity", "value", show_number(F.col("value") / 1000000, 1))


@query("series_mean", sql(f"select period, {r('avg(value)')} as mean_value from p3 group by period"))
def series_mean(spark, sf):
    return rounded(S.series_mean(P.p3(spark, sf), "period", "value"))


@query("discrete_bins", sql(f"""
select entity, period, {r('width', 2)} as bin_width,
       case when v < 0 then 4 else (v >= width)::int + (v >= 2 * width)::int + (v >= 3 * width)::int + (v >= 4 * width)::int end::bigint as bin
from (select *, greatest(1.0, round_even(raw / mag, 0) * mag) as width
      from (select *, 10 ** (length(cast(floor(raw) as bigint)::varchar) - 1) as mag
            from (select entity, period, value / 1000000 as v, max(value / 1000000) over (partition by period) / 5 as raw from p1)))
"""))
def discrete_bins(spark, sf):
    df = materialise(P.p1(spark, sf).select("entity", "period", (F.col("value") / 1000000).alias("v")), "p1")
    return rounded(S.equal_width_bins(df, ["period"], "v").drop("v"), 2)


@query("stack_indicators", sql(f"""
select 'Revenue' as indicator, 'money' as unit, entity, cast(period as varchar) as period, {r('value', 2)} as value, n_rows, cast(null as varchar) as category from p1
union all select 'Events', 'count', 'ALL', period::varchar, {r('value', 2)}, n, category from p2
union all select 'Orders', 'money', entity, cast(period as varchar), {r('value', 2)}, n_rows, substance || ' / ' || harm from p3
"""))
def stack_indicators(spark, sf):
    """Three panels of different shape; a column one of them lacks is NULL there."""
    text = F.col("period").cast("string")
    rows = S.stack_indicators([
        (P.p1(spark, sf), {"entity": "entity", "period": text, "value": "value", "n_rows": "n_rows"},
         {"indicator": "Revenue", "unit": "money"}),
        (P.p2(spark, sf), {"entity": F.lit(P.ALL), "period": text, "value": "value", "n_rows": "n", "category": "category"},
         {"indicator": "Events", "unit": "count"}),
        (P.p3(spark, sf), {"entity": "entity", "period": text, "value": "value", "n_rows": "n_rows",
                           "category": F.concat("substance", F.lit(" / "), "harm")}, {"indicator": "Orders", "unit": "money"}),
    ])
    return rounded(rows, 2)


@query("series_label", sql("select distinct substance || ' — ' || nullif(harm, '3-MEDIUM') as label, harm from p3"))
def series_label(spark, sf):
    """A label with a missing part is missing."""
    harm = F.when(F.col("harm") != "3-MEDIUM", F.col("harm"))
    return P.p3(spark, sf).select(F.concat("substance", F.lit(" — "), harm).alias("label"), "harm").distinct()
