"""Linked and enriched panels, marts, reports and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import panels as P
from catalog.forecast_queries import T975, tail_sql
from catalog.registry import query, rounded
from catalog.shape_queries import shown
from catalog.sql import cte, exact, r, sql
from panelkit.operators import quality as Q
from panelkit.operators.windows import attach_benchmark
from panelkit.plans import enriched as E
from panelkit.plans import marts as M
from panelkit.plans import reports as R
from panelkit.plans.domain import Domain
from panelkit.session import materialise
from panelkit.spec import PanelSpec

GROUPS = {
    "Territories": ("N0", "N1", "N2"),
    "Western": tuple(f"N{i}" for i in range(3, 10)),
    "Central": tuple(f"N{i}" for i in range(10, 16)),
}

TRADE = Domain(
    codes={}, focus="N0", focus_name="Nation zero", territories=("N0", "N1", "N2"), regions=GROUPS, members=25,
    event_pre=(1996, 1998), event_from=1999, event_note="After the event.", access_note="A floor estimate.",
    indicators=("Revenue", "Activity", "Spending"), headline_harm=("BUILDING", "Urgent"), headline_name="Building (Urgent)",
    disease_groups={"Traffic": ("view", "click"), "Money": ("purchase",)},
)

HARMS = Domain(codes={}, focus="AS", territories=("AS", "AM"), members=5, event_pre=(1996, 1998), event_from=1999)

# --- staged panels ------------------------------------------------------------


def base(spark, sf):
    """P1 in millions with its total under entity codes, written once because three indicators read it."""
    e = F.col("entity")
    rows = P.with_total(P.p1(spark, sf)).select(
        F.when(e == P.ALL, "CA").otherwise(F.replace(e, F.lit("NATION_"), F.lit("N"))).alias("prov_code"),
        F.when(e == P.ALL, "Canada").otherwise(e).alias("province_name"),
        "period", "cents", "n_rows", "population", (F.col("value") / 1000000).alias("value"), F.col("period").cast("string").alias("label"))
    return materialise(rows, "base")


cte("base", """
select case when entity = 'ALL' then 'CA' else replace(entity, 'NATION_', 'N') end as prov_code,
       case when entity = 'ALL' then 'Canada' else entity end as province_name,
       period, cents, n_rows, population, value / 1000000 as value, period::varchar as label from pt
""")


def level():
    return F.when(F.col("prov_code") == "CA", "National").otherwise("Province/territory").alias("reporting_level")


def admissions(rows):
    rate = F.when(F.col("n_rows") % 7 != 0, F.col("value"))
    return rows.select(
        "prov_code", "province_name", F.col("period").alias("fiscal_year"), F.col("label").alias("fiscal_year_label"),
        level(), F.lit("Revenue").alias("indicator_name"), rate.alias("age_standardized_rate"),
        (rate * 0.95).alias("ci_lower"), (rate * 1.05).alias("ci_upper"), (F.col("n_rows") % 50).cast("double").alias("numerator"),
        F.col("population").cast("double").alias("denominator"), (rate / 8).alias("crude_rate"))


def readmissions(rows):
    # Lines per customer; missing where the line count divides by six.
    rate = F.when(F.col("n_rows") % 6 != 0, F.col("n_rows").cast("double") / F.col("population"))
    return rows.select(
        "prov_code", "province_name", F.col("period").alias("fiscal_year"), F.col("label").alias("fiscal_year_label"),
        level(), F.lit("Activity").alias("indicator_name"), rate.alias("risk_adjusted_rate"),
        (rate * 0.95).alias("ci_lower"), (rate * 1.05).alias("ci_upper"), (F.col("n_rows") % 40).cast("double").alias("numerator"),
        F.col("population").cast("double").alias("denominator"), (rate / 8).alias("crude_rate"))


def incidence(rows):
    rate = F.col("cents").cast("double") / F.col("population") / 1000000
    return rows.where("period <> 1995").select(
        "prov_code", "province_name", F.col("period").alias("fiscal_year"), F.col("label").alias("fiscal_year_label"),
        F.lit("Spending").alias("indicator_name"), rate.alias("age_standardized_rate"), (rate * 0.95).alias("ci_lower"),
        (rate * 1.05).alias("ci_upper"), (F.col("n_rows") % 30).alias("case_counts"), F.col("population").alias("phac_population"))


def population(rows):
    return rows.where("population % 9 <> 0").select(
        "prov_code", F.col("period").alias("ref_year"), (F.col("population") * 1000).cast("double").alias("population"))


cte("adm", """
select prov_code, province_name, period as fiscal_year, label as fiscal_year_label,
       case when prov_code = 'CA' then 'national' else 'province' end as geo_level,
       case when n_rows % 7 <> 0 then value end as rate, cast(n_rows % 50 as double) as numerator,
       cast(population as double) as denominator,
       case when population % 9 <> 0 then cast(population * 1000 as double) end as pop
from base
""")
cte("mh", """
select prov_code, province_name, period as fiscal_year, label as fiscal_year_label,
       case when n_rows % 6 <> 0 then cast(n_rows as double) / population end as rate, cast(n_rows % 40 as double) as numerator,
       cast(population as double) as denominator, case when population % 9 <> 0 then cast(population * 1000 as double) end as pop
from base
""")
cte("inc", """
select prov_code, province_name, period as fiscal_year, label as fiscal_year_label, cast(cents as double) / population / 1000000 as rate,
       n_rows % 30 as case_counts, population as phac_population,
       case when population % 9 <> 0 then cast(population * 1000 as double) end as pop
from base where period <> 1995
""")


def enrich_sql(source: str, keep: str) -> str:
    """Benchmark, change, moving average and rank of the member rows of a staged panel."""
    return f"""
select a.*, b.rate as nat, b.rate * 0.95 as nat_lo, b.rate * 1.05 as nat_hi, a.rate - lag(a.rate) over s as d,
       lag(a.rate) over s as prev,
       case when lag(a.rate) over s > 0 then (a.rate - lag(a.rate) over s) / lag(a.rate) over s * 100 end as pct,
       avg(a.rate) over (s rows between 2 preceding and 2 following) as roll,
       rank() over (partition by a.fiscal_year order by a.rate desc nulls first) as rk
from {source} a left join {source} b on b.prov_code = 'CA' and a.fiscal_year = b.fiscal_year
where a.prov_code <> 'CA' and {keep} window s as (partition by a.prov_code order by a.fiscal_year)
"""


cte("adm_e", enrich_sql("adm", "a.rate is not null"))
cte("mh_e", enrich_sql("mh", "true"))
cte("inc_e", enrich_sql("inc", "true"))


# --- linked and enriched ------------------------------------------------------

@query("linked_indicators", sql(f"""
select prov_code, province_name, fiscal_year, fiscal_year_label, 'Revenue' as indicator_name, {r('rate')} as age_standardized_rate,
       {r('rate * 0.95')} as ci_lower, {r('rate * 1.05')} as ci_upper, numerator, denominator as cihi_denominator, {r('rate / 8')} as crude_rate,
       pop as statscan_population, geo_level, {r('numerator / pop * 100000', 1)} as calculated_rate_per_100k,
       rate is null or numerator < 5 as is_suppressed, pop is not null as population_linked
from adm
"""))
def linked_indicators(spark, sf):
    rows = base(spark, sf)
    return rounded(E.link_admissions(admissions(rows), population(rows), TRADE))


def admissions_e(rows):
    return E.admissions_change(E.link_admissions(admissions(rows), population(rows), TRADE), TRADE)


def readmissions_e(rows):
    return E.readmissions_enriched(readmissions(rows), population(rows), TRADE)


def incidence_e(rows):
    return E.incidence_enriched(incidence(rows), population(rows), TRADE)


@query("panel_enriched_change", sql(f"""
select prov_code, province_name, fiscal_year, {r('rate')} as age_standardized_rate, pop as statscan_population, geo_level,
       {r('prev')} as prev_year_rate, {r('d', 1)} as yoy_change, {r('pct', 1)} as yoy_pct_change, {r('roll', 1)} as rolling_avg_5yr_central,
       {r('nat')} as national_rate, {r('nat_lo')} as national_ci_lower, {r('nat_hi')} as national_ci_upper,
       {r('rate - coalesce(nat, 0)', 1)} as gap_to_national, numerator < 5 as is_suppressed, rk as rate_rank_desc
from adm_e
"""))
def panel_enriched_change(spark, sf):
    return rounded(admissions_e(base(spark, sf)))


@query("panel_enriched_event", sql(f"""
select prov_code, province_name, fiscal_year, fiscal_year_label, 'Activity' as indicator_name, {r('rate')} as risk_adjusted_rate,
       {r('rate * 0.95')} as ci_lower, {r('rate * 1.05')} as ci_upper, numerator, denominator, {r('rate / 8')} as crude_rate,
       pop as statscan_population, {r('nat')} as national_rate, {r('nat_lo')} as national_ci_lower, {r('nat_hi')} as national_ci_upper,
       {r('rate - nat')} as gap_to_national, {r('d')} as yoy_change, {r('pct')} as yoy_pct_change, {r('roll')} as rolling_avg_5yr_central,
       rk as rate_rank_desc, rate is null or numerator < 5 as is_suppressed, fiscal_year >= 1999 as is_emergency_overlap_period,
       case when fiscal_year >= 1999 then 'After the event.' end as interpretation_note
from mh_e
"""))
def panel_enriched_event(spark, sf):
    return rounded(readmissions_e(base(spark, sf)))


@query("panel_enriched_caveat", sql(f"""
select prov_code, province_name, fiscal_year, fiscal_year_label, 'Spending' as indicator_name, {r('rate')} as age_standardized_rate,
       {r('rate * 0.95')} as ci_lower, {r('rate * 1.05')} as ci_upper, case_counts, phac_population, pop as statscan_population,
       {r('nat')} as national_rate, {r('nat_lo')} as national_ci_lower, {r('nat_hi')} as national_ci_upper,
       {r('rate - nat')} as gap_to_national, {r('d')} as yoy_change, {r('pct')} as yoy_pct_change, {r('roll')} as rolling_avg_5yr_central,
       rk as rate_rank_desc, case_counts < 10 as is_suppressed, prov_code = 'N0' as apply_remote_access_caveat,
       case when prov_code = 'N0' then 'A floor estimate.' end as remote_access_interpretation_note
from inc_e
"""))
def panel_enriched_caveat(spark, sf):
    return rounded(incidence_e(base(spark, sf)))


def staged_harms(spark, sf):
    """P3 with the mean over regions as the benchmark, from one grouping-sets aggregate."""
    keys = ["entity", "substance", "harm", "period"]
    both = P.p3(spark, sf).groupingSets([keys, keys[1:]], *keys).agg(
        F.sum("cents").alias("cents"), F.count(F.lit(1)).alias("_n"), F.grouping("entity").alias("_total"))
    total = F.col("_total") == 1
    label = F.when(F.col("harm") == "1-URGENT", "Urgent").when(F.col("harm") == "2-HIGH", "High").when(
        F.col("harm") != "5-LOW", F.col("harm"))
    return both.select(
        F.when(total, "CA").otherwise(F.left("entity", F.lit(2))).alias("prov_code"),
        F.when(total, "Canada").otherwise(F.col("entity")).alias("region_name"), F.col("period").alias("ref_year"),
        F.col("period").cast("string").alias("year_label"), "substance", F.col("harm").alias("harm_type"),
        label.alias("harm_type_label"), (F.col("cents").cast("double") / F.col("_n") / 100).alias("crude_rate_per_100k"),
        (F.col("period") == 2001).alias("is_partial_year"))


def region_population(spark, sf):
    customer, dim = P.table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n")), P.nations(spark, sf)
    heads = customer.join(dim, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.left("r_name", F.lit(2)).alias("prov_code")).agg(
        F.sum("n").cast("double").alias("population"))
    return heads.withColumn("ref_year", F.explode(F.sequence(F.lit(1996), F.lit(2000))))


cte("harms", """
select case when entity = 'CA' then 'CA' else left(entity, 2) end as prov_code,
       case when entity = 'CA' then 'Canada' else entity end as region_name, period as ref_year, substance, harm as harm_type,
       case harm when '1-URGENT' then 'Urgent' when '2-HIGH' then 'High' when '5-LOW' then null else harm end as harm_type_label, rate
from (select entity, substance, harm, period, cast(cents as double) / 1 / 100 as rate from p3
      union all select 'CA', substance, harm, period, cast(sum(cents) as double) / count(*) / 100 from p3 group by 2, 3, 4)
where period <> 2001
""")
cte("heads", """
select left(r_name, 2) as prov_code, cast(count(*) as double) as pop from customer join dim on c_nationkey = n_nationkey group by 1
""")
cte("harms_e", """
select a.*, pop, b.rate as nat, a.rate - lag(a.rate) over s as d,
       case when lag(a.rate) over s > 0 then (a.rate - lag(a.rate) over s) / lag(a.rate) over s * 100 end as pct,
       avg(a.rate) over (s rows between 2 preceding and current row) as roll,
       rank() over (partition by a.ref_year, a.substance, a.harm_type order by a.rate desc nulls first) as rk,
       case when b.rate > 0 then a.rate / b.rate end as ratio
from harms a left join harms b on b.prov_code = 'CA' and a.ref_year = b.ref_year and a.substance = b.substance and a.harm_type = b.harm_type
     left join heads h on a.prov_code = h.prov_code and a.ref_year between 1996 and 2000
where a.prov_code <> 'CA' window s as (partition by a.prov_code, a.substance, a.harm_type order by a.ref_year)
""")


def harms_e(spark, sf):
    return E.harms_enriched(staged_harms(spark, sf), region_population(spark, sf), HARMS)


@query("panel_enriched_multikey", sql(f"""
select prov_code, region_name, ref_year, ref_year::varchar as year_label, substance, harm_type, harm_type_label,
       {r('rate')} as crude_rate_per_100k, false as is_partial_year, pop as statscan_population, {r('nat')} as national_rate,
       {r('rate - nat')} as gap_to_national, {r('ratio', 2)} as benchmark_ratio, {r('d')} as yoy_change, {r('pct', 1)} as yoy_pct_change,
       {r('roll', 1)} as rolling_avg_3yr, rk as rate_rank_desc, ref_year >= 1999 as is_emergency_period, false as is_suppressed
from harms_e
"""))
def panel_enriched_multikey(spark, sf):
    return rounded(harms_e(spark, sf))


def staged_surveillance(spark, sf):
    """Daily events per type: all regions as the benchmark series, regions as members."""
    keys = ["r_name", "event_type", "period"]
    both = P.p2_by_region(spark, sf).groupingSets([keys, keys[1:]], *keys).agg(
        F.sum("n").alias("n"), F.grouping("r_name").alias("_total"))
    total = F.col("_total") == 1
    cases = F.col("n").cast("double")
    return both.select(
        F.col("event_type").alias("disease"), F.col("period").alias("ref_year"),
        F.when(total, "CA").otherwise(F.left("r_name", F.lit(2))).alias("prov_code"),
        F.when(total, "Canada").otherwise(F.col("r_name")).alias("region_name"), cases.alias("total_cases"),
        F.when(total, cases / 5).otherwise(cases).alias("rate_per_100k"),
        F.when(total, "national_time_series").otherwise("provincial_snapshot").alias("data_source"), F.lit("calendar").alias("year_type"))


cte("surv", """
select event_type as disease, period as ref_year, left(r_name, 2) as prov_code, r_name as region_name, cast(n as double) as cases,
       cast(n as double) as rate, 'provincial_snapshot' as data_source from p2r
union all
select event_type, period, 'CA', 'Canada', cast(sum(n) as double), cast(sum(n) as double) / 5, 'national_time_series' from p2r group by 1, 2
""")
cte("surv_n", f"""
select *, lag(rate) over s as prev, rate - lag(rate) over s as d, (rate - lag(rate) over s) / nullif(lag(rate) over s, 0) * 100 as pct,
       avg(rate) over (s rows between 2 preceding and 2 following) as roll,
       stddev_pop(rate) over (s rows between 2 preceding and 2 following) as sd,
       rank() over (partition by ref_year order by rate desc) as rk
from surv where prov_code = 'CA' window s as (partition by disease order by ref_year)
""")
cte("surv_e", f"""
select a.disease, a.ref_year, a.prov_code, a.region_name, a.cases, a.rate, a.data_source, n.rate as nat,
       coalesce(n.rate > n.roll + 2 * n.sd, false) as nat_signal,
       case when a.prov_code = 'CA' then n.prev end as prev, case when a.prov_code = 'CA' then n.d end as d,
       case when a.prov_code = 'CA' then n.pct end as pct, case when a.prov_code = 'CA' then n.roll end as roll,
       case when a.prov_code = 'CA' then n.sd end as sd,
       case when a.prov_code = 'CA' then case when n.sd > 0 then {r('(a.rate - n.roll) / n.sd', 2)} else 0 end end as z,
       case when a.prov_code = 'CA' then n.rk
            else rank() over (partition by a.disease, a.ref_year, a.prov_code = 'CA' order by a.rate desc) end as rk,
       case when a.prov_code <> 'CA' then a.rate - n.rate end as gap,
       case when a.prov_code <> 'CA' and n.rate > 0 then a.rate / n.rate end as ratio
from surv a left join surv_n n on a.disease = n.disease and a.ref_year = n.ref_year
""")

SURVEILLANCE_COLUMNS = f"""
disease, ref_year, prov_code, region_name, cases as total_cases, {r('rate')} as rate_per_100k, data_source, 'calendar' as year_type,
{r('d')} as yoy_change, {r('pct', 1)} as yoy_pct_change, {r('roll', 2)} as rolling_avg_5yr_central, {r('sd')} as rolling_stddev_5yr,
prov_code = 'CA' and nat_signal as is_outbreak_signal, z as outbreak_z_score, rk as disease_rank_by_rate, cases < 5 as is_suppressed,
{r('nat')} as national_rate, {r('gap', 2)} as gap_to_national, {r('ratio', 2)} as prov_vs_national_ratio, nat_signal as national_outbreak_active
"""


@query("surveillance_enriched", sql(f"select {SURVEILLANCE_COLUMNS}, {r('prev')} as prev_year_rate from surv_e"))
def surveillance_enriched(spark, sf):
    return rounded(E.surveillance_enriched(staged_surveillance(spark, sf), HARMS))


# --- marts ----------------------------------------------------------------------

def trend_sql(d: str) -> str:
    return f"case when {d} > 0 then 'Increasing' when {d} < 0 then 'Decreasing' else 'Stable' end"


def compare_sql(x: str) -> str:
    return (f"case when {x}rate > {x}nat_hi then 'Significantly Above National' when {x}rate > {x}nat then 'Above National' "
            f"when {x}rate < {x}nat_lo then 'Significantly Below National' when {x}rate < {x}nat then 'Below National' else 'At National Rate' end")


def block_sql(x: str, prefix: str, rate_name: str, digits: tuple, gap: str, hidden: str) -> str:
    d, pct, roll = digits
    return f"""{r(f'{x}.rate')} as {rate_name}, {r(f'{x}.nat')} as {prefix}_national_rate, {gap} as {prefix}_gap_to_national,
       {r(f'{x}.d', d)} as {prefix}_yoy_change, {r(f'{x}.pct', pct)} as {prefix}_yoy_pct_change, {r(f'{x}.roll', roll)} as {prefix}_rolling_avg_5yr,
       {x}.rk as {prefix}_national_rank, {hidden} as {prefix}_is_suppressed, {trend_sql(f'{x}.d')} as {prefix}_trend_direction,
       {compare_sql(f'{x}.')} as {prefix}_national_comparison"""


cte("overview", f"""
select a.prov_code, a.province_name, a.fiscal_year, a.pop as population, true as cross_year_type_join_flag,
       max(a.fiscal_year) over () as latest_data_year, a.fiscal_year = max(a.fiscal_year) over () as is_latest,
       {block_sql('a', 'acsc', 'acsc_rate', (1, 1, 1), r('a.rate - coalesce(a.nat, 0)', 1), 'a.numerator < 5')},
       {block_sql('m', 'mh', 'mh_readmission_rate', (4, 4, 4), r('m.rate - m.nat'), '(m.fiscal_year is not null and m.rate is null) or m.numerator < 5')},
       {block_sql('i', 'diabetes', 'diabetes_incidence_rate', (4, 4, 4), r('i.rate - i.nat'), 'i.case_counts < 10')}
from adm_e a left join mh_e m on m.prov_code = 'N0' and a.fiscal_year = m.fiscal_year
     left join inc_e i on i.prov_code = 'N0' and a.fiscal_year = i.fiscal_year
where a.prov_code = 'N0'
""")


def overview(rows):
    return M.focus_overview(admissions_e(rows), readmissions_e(rows), incidence_e(rows), TRADE)


@query("focus_overview", sql("select * from overview"))
def focus_overview(spark, sf):
    return rounded(overview(base(spark, sf)))


def compared_sql(source: str, name: str, unit: str, year_type: str, digits: tuple, gap: str, hidden: str) -> str:
    d, pct, roll = digits
    return f"""
select prov_code, province_name, fiscal_year, {r('nat')} as national_rate, {r('nat_lo')} as national_ci_lower, {r('nat_hi')} as national_ci_upper,
       {gap} as gap_to_national, {r('d', d)} as yoy_change, {r('pct', pct)} as yoy_pct_change, {r('roll', roll)} as rolling_avg_5yr_central,
       rk as national_rank, {hidden} as is_suppressed, pop as population, {r('rate')} as rate_value, '{name}' as indicator_name,
       '{unit}' as rate_unit, '{year_type}' as year_type,
       case when prov_code in ('N0', 'N1', 'N2') then 'Territories'
            when cast(substr(prov_code, 2) as integer) < 10 then 'Western'
            when cast(substr(prov_code, 2) as integer) < 16 then 'Central' else 'National' end as region_group,
       {compare_sql('')} as national_comparison, prov_code = 'N0' as is_focus, prov_code in ('N0', 'N1', 'N2') as is_territory,
       'lower_is_better' as rank_polarity, 26 - rk as outcome_rank,
       case when rk <= 3 then 'High Burden' when rk >= 23 then 'Low Burden' else 'Moderate Burden' end as burden_category
from {source}"""


cte("compared", " union all ".join((
    compared_sql("adm_e", "Revenue", "per 100,000", "fiscal", (1, 1, 1), r("rate - coalesce(nat, 0)", 1), "numerator < 5"),
    compared_sql("mh_e", "Activity", "%", "fiscal", (4, 4, 4), r("rate - nat"), "rate is null or numerator < 5"),
    compared_sql("inc_e", "Spending", "per 100,000", "calendar", (4, 4, 4), r("rate - nat"), "case_counts < 10"))))


def comparison(rows):
    return M.entity_comparison(admissions_e(rows), readmissions_e(rows), incidence_e(rows), TRADE)


@query("mart_comparison", sql("select * from compared"))
def mart_comparison(spark, sf):
    return rounded(comparison(base(spark, sf)))


cte("trends", """
select fiscal_year, rate, rate * 0.95 as lo, rate * 1.05 as hi, numerator < 5 as hidden, pop, prov_code, province_name,
       'Revenue' as indicator_name, 'per 100,000' as rate_unit, 'fiscal' as year_type from adm
union all select fiscal_year, rate, rate * 0.95, rate * 1.05, numerator < 5, pop, prov_code, province_name, 'Activity', '%', 'fiscal' from mh where prov_code <> 'CA'
union all select fiscal_year, rate, rate * 0.95, rate * 1.05, case_counts < 10, pop, prov_code, province_name, 'Spending', 'per 100,000', 'calendar' from inc where prov_code <> 'CA'
""")


def trends(rows):
    linked = E.link_admissions(admissions(rows), population(rows), TRADE)
    return M.trend_series(linked, readmissions_e(rows), incidence_e(rows), TRADE)


@query("mart_trend", sql(f"""
select fiscal_year, {r('rate')} as rate_value, {r('lo')} as ci_lower, {r('hi')} as ci_upper, hidden as is_suppressed, pop as population,
       case prov_code when 'N0' then 'Nation zero' when 'CA' then 'Canada (National)' else province_name end as series_name,
       prov_code, indicator_name, rate_unit, year_type, {r('avg(rate) over e')} as mean_rate, {r('min(rate) over e')} as min_rate,
       {r('max(rate) over e')} as max_rate, count(*) over e as data_points
from trends where prov_code in ('N0', 'N1', 'N2', 'CA') and rate is not null window e as (partition by indicator_name, prov_code)
"""))
def mart_trend(spark, sf):
    return rounded(trends(base(spark, sf)))


SEVERITY = ("when {0} >= 2 then 'Crisis Level' when {0} >= 1.5 then 'Severely Elevated' "
            "when {0} >= 1 then 'Above National' when {0} < 1 then 'Below National' end")

cte("harms_m", f"""
select prov_code, region_name, ref_year, ref_year::varchar as year_label, substance, harm_type, harm_type_label,
       {r('rate')} as crude_rate_per_100k, {r('nat')} as national_rate, {r('rate - nat')} as gap_to_national, {r('ratio', 2)} as benchmark_ratio,
       {r('d')} as yoy_change, {r('pct', 1)} as yoy_pct_change, {r('roll', 1)} as rolling_avg_3yr, rk as national_rank,
       ref_year >= 1999 as is_emergency_period, false as is_suppressed, pop as statscan_population,
       substance || ' — ' || harm_type_label as indicator_label, {trend_sql('d')} as trend_direction,
       case {SEVERITY.format(exact('ratio', 2))} as severity_vs_national,
       case when ref_year between 1996 and 1998 then 'Pre-Emergency' when ref_year >= 1999 then 'Post-Emergency' else 'Baseline' end as emergency_period_label,
       'calendar' as year_type, {r('avg(rate) over e')} as mean_rate, {r('min(rate) over e')} as min_rate, {r('max(rate) over e')} as max_rate,
       count(*) over e as data_points
from harms_e window e as (partition by prov_code, substance, harm_type)
""")


@query("mart_harms", sql("select * from harms_m"))
def mart_harms(spark, sf):
    return rounded(M.harms_report(harms_e(spark, sf), HARMS))


@query("slice_reference", sql(f"""
select 'cases per year' as rate_unit, {r("max(value)")} as national_rate from pt where entity = 'ALL' and period = 1998
"""))
def slice_reference(spark, sf):
    """The benchmark that all rows of one year's slice show."""
    panel = attach_benchmark(P.with_total(P.p1(spark, sf)), P.P1, P.ALL, {"value": "national_rate"})
    rows = panel.where((F.col("period") == 1998) & (F.col("entity") != P.ALL)).withColumn("rate_unit", F.lit("cases per year"))
    return rounded(R.slice_reference(rows))


cte("surv_m", f"""
select {SURVEILLANCE_COLUMNS}, {trend_sql('d')} as trend_direction,
       case when prov_code = 'CA' and nat_signal and z >= 3 then 'Severe Outbreak' when prov_code = 'CA' and nat_signal then 'Outbreak Detected'
            when z >= 1 then 'Elevated' else 'Normal Range' end as outbreak_status_label,
       case when disease in ('view', 'click') then 'Traffic' when disease = 'purchase' then 'Money' else 'Other' end as disease_category,
       prov_code = 'AS' as is_focus, prov_code in ('AS', 'AM') as is_territory,
       case when {exact('ratio', 2)} >= 5 then 'Extreme' {SEVERITY.format(exact('ratio', 2))} as severity_vs_national,
       {r('avg(rate) over e')} as mean_rate, {r('min(rate) over e')} as min_rate, {r('max(rate) over e')} as max_rate, count(*) over e as data_points,
       first_value(ref_year) over (partition by prov_code, disease order by rate desc, ref_year) as peak_year
from surv_e where not cases < 5 window e as (partition by prov_code, disease)
""")

EVENTS = Domain(codes={}, focus="AS", territories=("AS", "AM"), members=5, disease_groups=TRADE.disease_groups,
                event_pre=(1996, 1998), event_from=1999)


def surveillance(spark, sf):
    return M.surveillance_report(E.surveillance_enriched(staged_surveillance(spark, sf), EVENTS), EVENTS)


@query("mart_surveillance", sql("select * from surv_m"))
def mart_surveillance(spark, sf):
    """Suppressed cells leave before the summary columns are computed."""
    return rounded(surveillance(spark, sf))


# --- reports --------------------------------------------------------------------

def status_line_sql(name: str, prefix: str, rate: str, digits: int, suffix: str, where: str) -> str:
    comp = f"{prefix}_national_comparison"
    gap = f"{prefix}_gap_to_national"
    return f"""
select '{name}' as domain, fiscal_year as period, {rate} as value, {shown(rate, digits)} || '{suffix}' as latest_rate, {comp} as comparison,
       {prefix}_trend_direction as trend, '#' || {prefix}_national_rank || '/25' as rank_text,
       coalesce({shown(gap, digits, True)}, 'N/A') as gap_text,
       case when contains(lower({comp}), 'significantly above') then 'red' when contains(lower({comp}), 'above') then 'yellow' else 'green' end as light
from overview where {rate} is not null and {where}"""


cte("worst", """
select disease, ref_year, rate_per_100k, outbreak_status_label from surv_m
where prov_code = 'CA' and ref_year = (select max(ref_year) from surv_m where prov_code = 'CA')
order by case outbreak_status_label when 'Severe Outbreak' then 0 when 'Outbreak Detected' then 1 when 'Elevated' then 2 else 3 end, disease limit 1
""")
cte("lines", f"""
{status_line_sql('Revenue', 'acsc', 'acsc_rate', 0, ' per 100k', 'is_latest')}
union all {status_line_sql('Activity', 'mh', 'mh_readmission_rate', 1, '%', 'is_latest')}
union all {status_line_sql('Spending', 'diabetes', 'diabetes_incidence_rate', 0, ' per 100k',
                           'fiscal_year = (select max(fiscal_year) from overview where diabetes_incidence_rate is not null)')}
union all
select 'Building (Urgent)', ref_year, crude_rate_per_100k, {shown('crude_rate_per_100k', 1)} || ' per 100k', coalesce(severity_vs_national, 'N/A'),
       trend_direction, 'N/A', 'N/A', case when severity_vs_national = 'Crisis Level' then 'red'
         when severity_vs_national in ('Severely Elevated', 'Above National') then 'yellow' else 'green' end
from harms_m where prov_code = 'AS' and substance = 'BUILDING' and harm_type_label = 'Urgent' and ref_year = 2000
union all
select 'Communicable Disease', ref_year, rate_per_100k, {shown('rate_per_100k', 1)} || ' per 100k (' || disease || ')', outbreak_status_label,
       'National surveillance', 'N/A', 'N/A', case outbreak_status_label when 'Normal Range' then 'green' when 'Elevated' then 'yellow' else 'red' end
from worst
""")


def status(spark, sf):
    """The overview's focus is a nation, the harms' focus a region; everything else is shared."""
    harms = M.harms_report(harms_e(spark, sf), HARMS)
    harms = harms.withColumn("prov_code", F.when(F.col("prov_code") == HARMS.focus, TRADE.focus).otherwise(F.col("prov_code")))
    wide = materialise(rounded(overview(base(spark, sf))), "overview")
    return R.status_table(wide, rounded(harms), rounded(surveillance(spark, sf)), TRADE)


@query("status_table", sql(f"""
select domain, period, {r('value')} as value, latest_rate, comparison, trend, rank_text, gap_text, light,
       case light when 'red' then 'Needs Attention' when 'yellow' then 'Monitor' else 'On Track' end as status from lines
"""))
def status_table(spark, sf):
    return rounded(status(spark, sf))


@query("status_counts", sql("""
select count(*) filter (light = 'red') as red_count, count(*) filter (light = 'yellow') as yellow_count,
       count(*) filter (light = 'green') as green_count from lines
"""))
def status_counts(spark, sf):
    return R.status_counts(status(spark, sf))


@query("worst_status", sql("select * from worst"))
def worst_status(spark, sf):
    return R.worst_status(rounded(surveillance(spark, sf)), EVENTS)


@query("ranking_table", sql(f"""
select prov_code, province_name, {shown('rate_value', 1)} as rate_text, national_rank, outcome_rank, burden_category, national_comparison,
       coalesce({shown('gap_to_national', 1, True)}, 'N/A') as gap_text
from compared where indicator_name = 'Activity' and rate_value is not null and fiscal_year = (select max(fiscal_year) from compared where indicator_name = 'Activity')
"""))
def ranking_table(spark, sf):
    mart = materialise(rounded(comparison(base(spark, sf))), "comparison")
    return R.ranking_table(R.slice_of(mart, "Activity", benchmark="CA").where("rate_value is not null"))


@query("region_table", sql(f"""
select region_group, {r('avg(rate_value)')} as avg_value from compared where indicator_name = 'Spending' and fiscal_year = 2000 group by 1
"""))
def region_table(spark, sf):
    mart = rounded(comparison(base(spark, sf)))
    return rounded(R.region_table(R.slice_of(mart, "Spending", 2000)))


@query("findings", sql(f"""
select l.indicator, l.latest_period, {r('focus_value', 3)} as focus_value, {r('benchmark_value', 3)} as benchmark_value,
       {r('focus_value - benchmark_value', 3)} as gap, (last_t + 3)::integer as forecast_period, {r('mv + b * (last_t + 3 - mt)', 3)} as yhat, {r('b', 3)} as slope,
       {r('mv + b * (last_t + 3 - mt) - half', 3)} as lo95, {r('mv + b * (last_t + 3 - mt) + half', 3)} as hi95,
       {r(tail_sql('th', '(n - 2)'), 3)} as p_value, case when b > 0 then 'increasing' else 'decreasing' end as direction,
       'Latest ' || latest_period || ': ' || {shown('focus_value', 1)} || ', benchmark ' || {shown('benchmark_value', 1)} || ' (gap '
         || {shown('focus_value - benchmark_value', 1)} || '); trend ' || case when b > 0 then 'increasing' else 'decreasing' end || ' at ' || {shown('b', 2)} || ' per period' as sentence
from (select *, [{', '.join(map(str, T975))}][n - 2] * sqrt(sse / (n - 2)) * sqrt(1 + 1 / n + (last_t + 3 - mt) ** 2 / sxx) as half,
             atan(abs(b / sqrt(sse / (n - 2) / sxx)) / sqrt(n - 2)) as th
      from (select *, greatest(syy - b * sxy, 0) as sse from (select indicator, max(period) filter (entity = 'N0') as latest_period, arg_max(v, period) filter (entity = 'N0') as focus_value,
             arg_max(v, period) filter (entity = 'CA') as benchmark_value,
             max(period) filter (entity = 'N0') as last_t, regr_slope(v, period) filter (entity = 'N0') as b,
             avg(v) filter (entity = 'N0') as mv, avg(period) filter (entity = 'N0') as mt, count(v) filter (entity = 'N0') as n,
             regr_sxx(v, period) filter (entity = 'N0') as sxx, regr_syy(v, period) filter (entity = 'N0') as syy,
             regr_sxy(v, period) filter (entity = 'N0') as sxy
      from (select prov_code as entity, period, 'Revenue' as indicator, value as v from base
            union all select prov_code, period, 'Activity', cast(n_rows as double) / population from base) group by indicator))) l
"""))
def findings(spark, sf):
    rows = base(spark, sf)
    stacked = M.stack_indicators([
        (rows, {"entity": "prov_code", "period": "period", "value": "value"}, {"indicator": "Revenue"}),
        (rows, {"entity": "prov_code", "period": "period", "value": F.col("n_rows").cast("double") / F.col("population")}, {"indicator": "Activity"}),
    ])
    out = R.findings(stacked, PanelSpec("entity", "period", "value", ("indicator",)), "N0", "CA")
    return rounded(out, 3)


# --- quality --------------------------------------------------------------------

def mart_tables(spark, sf):
    rows = base(spark, sf)
    return {"overview": overview(rows), "comparison": comparison(rows), "trends": trends(rows)}


@query("dq_not_null", sql("""
select 'not_null:comparison.prov_code' as "check", count(*) filter (prov_code is null) as failures from compared
union all select 'not_null:comparison.rate_value', count(*) filter (rate_value is null) from compared
union all select 'not_null:comparison.population', count(*) filter (population is null) from compared
"""))
def dq_not_null(spark, sf):
    checks = [Q.NotNull("comparison", c) for c in ("prov_code", "rate_value", "population")]
    return Q.run_checks({"comparison": comparison(base(spark, sf))}, checks)


@query("dq_accepted", sql("""
select 'accepted:comparison.indicator_name' as "check", count(*) filter (indicator_name not in ('Revenue', 'Activity')) as failures from compared
union all select 'accepted:comparison.burden_category', count(*) filter (burden_category not in ('High Burden', 'Moderate Burden', 'Low Burden')) from compared
"""))
def dq_accepted(spark, sf):
    """The first check lists too few indicators, so it fails."""
    checks = [Q.Accepted("comparison", "indicator_name", ("Revenue", "Activity")),
              Q.Accepted("comparison", "burden_category", ("High Burden", "Moderate Burden", "Low Burden"))]
    return Q.run_checks({"comparison": comparison(base(spark, sf))}, checks)


@query("dq_unique", "select o_custkey, count(*) as n from orders group by 1 having count(*) > 1")
def dq_unique(spark, sf):
    """The customers that break uniqueness among orders."""
    return Q.failing_rows({"orders": P.table(spark, sf, "orders")}, Q.Unique("orders", ("o_custkey",)))


@query("dq_range", "select l_orderkey, l_linenumber, l_quantity from lineitem where l_returnflag = 'A' and (l_quantity < 3 or l_quantity > 48)")
def dq_range(spark, sf):
    check = Q.InRange("lineitem", "l_quantity", 3, 48, "l_returnflag = 'A'")
    return Q.failing_rows({"lineitem": P.table(spark, sf, "lineitem")}, check).select("l_orderkey", "l_linenumber", "l_quantity")


@query("dq_presence", sql("""
select 'present:overview' as "check", (count(*) = 0)::integer::bigint as failures from overview
union all select 'present:comparison', (count(*) filter (prov_code = 'N99') = 0)::integer::bigint from compared
union all select 'present:trends', 0
"""))
def dq_presence(spark, sf):
    """One of the three tables lacks the entity that is looked for."""
    checks = [Q.Present("overview"), Q.Present("comparison", "prov_code = 'N99'"), Q.Present("trends", "series_name = 'Nation zero'")]
    return Q.run_checks(mart_tables(spark, sf), checks)


@query("dq_single_latest", sql("""
select 'exactly_one:overview' as "check", (count(*) filter (is_latest) <> 1)::integer::bigint as failures from overview
union all select 'exactly_one:comparison', (count(*) filter (is_focus) <> 1)::integer::bigint from compared
"""))
def dq_single_latest(spark, sf):
    checks = [Q.ExactlyOne("overview", "is_latest"), Q.ExactlyOne("comparison", "is_focus")]
    return Q.run_checks(mart_tables(spark, sf), checks)
