"""Parsing, coding and staging of published text, rendered from the fact panels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import panels as P
from catalog.registry import query
from catalog.sql import cte, r, sql
from panelkit.functions import text as X
from panelkit.functions.classify import lookup
from panelkit.operators import clean
from panelkit.plans import staging
from panelkit.plans.domain import Domain
from panelkit.session import materialise
from panelkit.sources import csv

TOKENS = "('-', '–', 'Suppressed', 'Suppr.', 'N/A', '')"


def number_sql(c: str) -> str:
    return f"case when trim({c}) not in {TOKENS} then try_cast(replace(trim({c}), ',', '') as double) end"


def period_sql(c: str) -> str:
    return f"try_cast(left(regexp_replace({c}, '[^0-9]', '', 'g'), 4) as integer)"


@query("parse_number", sql(f"""
select entity, period, {number_sql('value')} as value, value is not null and {number_sql('value')} is null as withheld from p5
"""))
def parse_number(spark, sf):
    v = X.parse_number("value")
    return P.p5(spark, sf).select("entity", "period", v.alias("value"), (F.col("value").isNotNull() & v.isNull()).alias("withheld"))


@query("parse_period", sql(f"""
select entity, time_frame, {period_sql('time_frame')} as year, try_cast(left(trim(time_frame), 4) as integer) as leading_year from p5
"""))
def parse_period(spark, sf):
    return P.p5(spark, sf).select("entity", "time_frame", X.parse_period("time_frame").alias("year"),
                                  X.parse_leading_year("time_frame").alias("leading_year"))


@query("partial_period", sql("select entity, period, cents from p5 where not time_frame like '%(%)%'"))
def partial_period(spark, sf):
    """Only whole years."""
    return P.p5(spark, sf).where(~X.partial_period_flag("time_frame")).select("entity", "period", "cents")


@query("unparsed_counts", sql("""
select 'value' as "column", count(*) filter (value is not null and value not in ('-', 'Suppr.') and try_cast(replace(value, ',', '') as double) is null) as unparsed from p5
union all select 'time_frame', count(*) filter (try_cast(time_frame as double) is null) from p5
"""))
def unparsed_counts(spark, sf):
    return staging.unparsed_counts(P.p5(spark, sf), ["value", "time_frame"])


def nation_codes(spark, sf, benchmark: str) -> DataFrame:
    codes = P.table(spark, sf, "nation").select("n_name", F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code"))
    return codes.unionByName(spark.createDataFrame([(benchmark, "CA")], "n_name string, code string"))


@query("map_code", sql("""
select geo, period, 'N' || n_nationkey as code, case trim(geo) when 'NATION_0' then 'Zero' when 'NATION_1' then 'One' else trim(geo) end as label
from p5 left join nation on trim(geo) = n_name and n_nationkey <> 7
"""))
def map_code(spark, sf):
    """A dimension join with one code missing, and a literal lookup that keeps other names."""
    codes = nation_codes(spark, sf, "-").where("code <> 'N7'")
    df = clean.map_code(P.p5(spark, sf).select("geo", "period"), "geo", "code", codes)
    name = F.trim("geo")
    return df.withColumn("label", lookup(name, {"NATION_0": "Zero", "NATION_1": "One"}, name))


@query("map_code_folded", """
select case when n_nationkey % 2 = 1 then replace(n_name, 'A', 'Á') when n_nationkey % 4 = 0 then replace(n_name, 'O', 'Ö') else n_name end as name,
       'N' || n_nationkey as code, cast(null as varchar) as distrusted
from nation
""")
def map_code_folded(spark, sf):
    """Accented spellings find their code; the match is not trusted when too few do."""
    nation, key = P.table(spark, sf, "nation"), F.col("n_nationkey")
    name = (F.when(key % 2 == 1, F.replace("n_name", F.lit("A"), F.lit("Á")))
            .when(key % 4 == 0, F.replace("n_name", F.lit("O"), F.lit("Ö"))).otherwise(F.col("n_name")))
    df = nation.select(name.alias("name"))
    aliases = nation_codes(spark, sf, "-")
    df = clean.map_code_folded(df, "name", "code", aliases, min_matches=10)
    return clean.map_code_folded(df, "name", "distrusted", aliases, min_matches=1000)


@query("null_out", sql("""
select entity, period, case when value not in ('Suppr.', '-') then value end as value,
       case when n_rows % 5 <> 0 then cast(cents as double) end as amount
from p5
"""))
def null_out(spark, sf):
    nan = F.when(F.col("n_rows") % 5 == 0, F.lit("NaN").cast("double")).otherwise(F.col("cents").cast("double"))
    df = P.p5(spark, sf).select("entity", "period", "value", nan.alias("amount"))
    return csv.null_out(df, ["value", "amount"], ["Suppr.", "-"])


@query("filter_levels", sql("""
select geo, period from p5 where trim(geo) in ('NATION_1', 'NATION_2', 'NATION_3') and trim(value) = 'Suppr.'
"""))
def filter_levels(spark, sf):
    df = clean.keep_levels(P.p5(spark, sf), {"geo": ["nation_1", "nation_2", "Nation_3"]}, ignore_case=True)
    return clean.keep_levels(df, {"value": ["Suppr."]}).select("geo", "period")


@query("filter_exclude", sql("select geo, period, value from p5 where trim(value) not in ('Suppr.', '-')"))
def filter_exclude(spark, sf):
    """A missing value is excluded as well."""
    return clean.drop_levels(P.p5(spark, sf), {"value": ["Suppr.", "-"]}).select("geo", "period", "value")


@query("filter_totals", """
select o_orderkey, case o_orderstatus when 'F' then ' Both sexes ' when 'O' then 'Total - gender' else 'Male' end as "Gender",
       case when o_orderpriority = '1-URGENT' then 'All ages' else 'Total, all ages' end as "Age group"
from orders where o_orderstatus in ('F', 'O') and o_orderpriority in ('1-URGENT', '2-HIGH')
""")
def filter_totals(spark, sf):
    gender = lookup("o_orderstatus", {"F": " Both sexes ", "O": "Total - gender"}, "Male")
    age = lookup("o_orderpriority", {"1-URGENT": "All ages", "2-HIGH": "Total, all ages"}, "0 to 4")
    df = P.table(spark, sf, "orders").select("o_orderkey", gender.alias("Gender"), age.alias("Age group"))
    return csv.filter_total_rows(df)


@query("clean_names", """
select n_nationkey as nation_key_pct, n_name as "rate:_lower", n_regionkey as per_100000 from nation
""")
def clean_names(spark, sf):
    df = P.table(spark, sf, "nation").toDF("Nation Key (%)", "Rate: Lower", "Per-100,000 ")
    return csv.clean_column_names(df)


# --- staging ----------------------------------------------------------------

TEXT = Domain(
    codes={}, first_period=1996, sub_regions=("Territories",), indicators=("Revenue", "Readmissions", "Incidence"),
    harm_labels={"1-URGENT": "Urgent", "2-HIGH": "High", "3-MEDIUM": "Medium", "4-NOT SPECIFIED": "Not specified"},
    disease_names={"signup": "registration"},
)


def grouped(c):
    return F.format_number(c, 0)


def raw_admissions(spark, sf):
    """The panel as a published hospital table, with rows of another level."""
    e, n, c = F.col("entity"), F.col("n_rows"), F.col("cents")
    total = e == P.ALL
    return P.with_total(P.p1(spark, sf)).select(
        F.when(total, "-").otherwise(F.concat(F.lit("  "), e, F.lit(" "))).alias("province_territory"),
        F.when(total, " National ").when(n % 5 == 0, "Health region").when(F.col("period") % 2 == 0, "PROVINCE/TERRITORY")
        .otherwise("Province/territory").alias("reporting_level"),
        P.year_text(F.col("period")).alias("time_frame"), F.lit(" Revenue ").alias("indicator"),
        P.money_text(n, c).alias("age_standardized_rate"),
        grouped(c - 1000).alias("confidence_interval_lower_limit"), grouped(c + 1000).alias("confidence_interval_upper_limit"),
        F.when(n % 3 == 0, "Suppressed").otherwise(n.cast("string")).alias("numerator"),
        F.col("population").cast("string").alias("denominator"),
        F.when(n % 4 != 0, F.concat(n.cast("string"), F.lit(".5"))).otherwise("").alias("crude_rate"),
    )


cte("raw_levels", """
select case when entity = 'ALL' then '-' else '  ' || entity || ' ' end as province_territory,
       case when entity = 'ALL' then ' National ' when n_rows % 5 = 0 then 'Health region'
            when period % 2 = 0 then 'PROVINCE/TERRITORY' else 'Province/territory' end as reporting_level,
       case when period = 2001 then '2001 (Jan to Aug)' when period % 2 = 0 then period::varchar || '*'
            else period::varchar || '–' || (period + 1)::varchar end as time_frame,
       case when n_rows % 7 = 0 then 'Suppr.' when n_rows % 11 = 0 then '-'
            when n_rows % 13 = 0 then null else format('{:,}', cents) end as rate,
       format('{:,}', cents - 1000) as lo, format('{:,}', cents + 1000) as hi,
       case when n_rows % 3 = 0 then 'Suppressed' else n_rows::varchar end as numerator, population::varchar as denominator,
       case when n_rows % 4 <> 0 then n_rows::varchar || '.5' else '' end as crude_rate
from pt
""")


def levels_sql(rate: str) -> str:
    return sql(f"""
select trim(province_territory) as province_name, case when trim(province_territory) = '-' then 'CA' else 'N' || n_nationkey end as prov_code,
       {period_sql('time_frame')} as fiscal_year, trim(time_frame) as fiscal_year_label, trim(reporting_level) as reporting_level,
       'Revenue' as indicator_name, {number_sql('rate')} as {rate}, {number_sql('lo')} as ci_lower, {number_sql('hi')} as ci_upper,
       {number_sql('numerator')} as numerator, {number_sql('denominator')} as denominator, {number_sql('crude_rate')} as crude_rate,
       'fiscal' as year_type
from raw_levels left join nation on trim(province_territory) = n_name
where lower(trim(reporting_level)) in ('province/territory', 'national')
""")


@query("stage_levels", levels_sql("age_standardized_rate"))
def stage_levels(spark, sf):
    return staging.stage_admissions(raw_admissions(spark, sf), TEXT, nation_codes(spark, sf, "-"))


@query("stage_overall", levels_sql("risk_adjusted_rate").replace("trim(province_territory) as province_name",
       "case when trim(province_territory) = '-' then 'N/A' else trim(province_territory) end as province_name"))
def stage_overall(spark, sf):
    """Two breakdowns of every row, of which one is overall; the benchmark is spelled N/A."""
    prefix = "risk_adjusted_rate:_confidence_interval"
    raw = raw_admissions(spark, sf).withColumnsRenamed({
        "age_standardized_rate": "risk_adjusted_rate",
        "confidence_interval_lower_limit": f"{prefix}_lower_limit", "confidence_interval_upper_limit": f"{prefix}_upper_limit"})
    raw = raw.withColumn("level_1_breakdown", F.explode(F.array(F.lit("Not applicable "), F.lit("Age group"))))
    name = F.when(F.trim("province_territory") == "-", "N/A").otherwise(F.col("province_territory"))
    return staging.stage_readmissions(raw.withColumn("province_territory", name), TEXT, nation_codes(spark, sf, "N/A"))


@query("stage_allowlist", sql("""
select case when entity = 'ALL' then 'Canada' else entity end as province_name,
       case when entity = 'ALL' then 'CA' else 'N' || n_nationkey end as prov_code, period as fiscal_year,
       period::varchar || (period + 1)::varchar || case when period % 2 = 0 then '*' else '' end as fiscal_year_label,
       'Incidence' as indicator_name, cast(cents as double) / 100 as age_standardized_rate,
       cast(cents - 1000 as double) / 100 as ci_lower, cast(cents + 1000 as double) / 100 as ci_upper,
       cast(n_rows as double) / 8 as standard_error, n_rows as case_counts, population as phac_population, 'calendar' as year_type
from pt left join nation on entity = n_name where n_rows % 7 <> 0 and (entity = 'ALL' or n_rows % 10 <> 0)
"""))
def stage_allowlist(spark, sf):
    """Footnote rows carry no known geography and fall out."""
    e, c, n, t = F.col("entity"), F.col("cents"), F.col("n_rows"), F.col("period")
    money = (lambda x: x.cast("double") / 100)
    raw = P.with_total(P.p1(spark, sf)).select(
        F.when(e == P.ALL, "Canada").when(n % 10 == 0, F.concat(F.lit("Note: "), e)).otherwise(F.concat(F.lit(" "), e)).alias("geography"),
        F.explode(F.array(F.lit(" Both sexes"), F.lit("Males"))).alias("sex"), F.lit("Total").alias("age_group_type"),
        F.concat(t.cast("string"), (t + 1).cast("string"), F.when(t % 2 == 0, "*").otherwise("")).alias("fiscal_year"),
        F.when(n % 7 != 0, money(c)).alias("rate_per_100000"), money(c - 1000).alias("lower_95pct_ci"),
        money(c + 1000).alias("upper_95pct_ci"), (n.cast("double") / 8).alias("standard_error"),
        n.alias("case_counts"), "population")
    return staging.stage_incidence(raw, TEXT, nation_codes(spark, sf, "Canada"))


@query("stage_harms", sql(f"""
select substance, harm as harm_type, case harm when '1-URGENT' then 'Urgent' when '2-HIGH' then 'High' when '3-MEDIUM' then 'Medium'
         when '4-NOT SPECIFIED' then 'Not specified' end as harm_type_label,
       entity as region_name, left(entity, 2) as prov_code, period as ref_year, period = 2001 as is_partial_year,
       case when period = 2001 then '2001 (Jan to Aug)' else period::varchar end as year_label,
       cast(cents as double) as crude_rate_per_100k, 'calendar' as year_type
from p3 where entity <> 'MIDDLE EAST' and n_rows % 7 <> 0
"""))
def stage_harms(spark, sf):
    e, t = F.col("entity"), F.col("period")
    raw = P.p3(spark, sf).select(
        F.concat(F.lit(" "), "substance").alias("substance"), F.concat("harm", F.lit(" ")).alias("source"),
        F.explode(F.array(F.lit("Overall numbers"), F.lit("By sex"))).alias("specific_measure"),
        F.lit("Crude rate").alias("unit"), F.lit("By year").alias("time_period"),
        F.when(e == "MIDDLE EAST", "Territories").otherwise(e).alias("region"),
        F.when(t == 2001, "2001 (Jan to Aug)").otherwise(t.cast("string")).alias("year_quarter"),
        F.when(F.col("n_rows") % 7 == 0, "Suppr.").otherwise(F.col("cents").cast("string")).alias("value"))
    codes = P.table(spark, sf, "region").select("r_name", F.left("r_name", F.lit(2)).alias("code"))
    return staging.stage_harms(raw, TEXT, codes)


@query("stage_population", sql("""
select case when entity = 'ALL' then 'Canada' else entity end as province_name,
       case when entity = 'ALL' then 'CA' else 'N' || n_nationkey end as prov_code, period as ref_year,
       cast(population as double) as population, 'calendar' as year_type
from pt left join nation on entity = n_name where population % 13 <> 0 and period >= 1996
"""))
def stage_population(spark, sf):
    e, n = F.col("entity"), F.col("population")
    raw = P.with_total(P.p1(spark, sf)).select(
        F.when(e == P.ALL, "Canada").otherwise(e).alias("geo"),
        F.concat(F.col("period").cast("string"), F.lit("-07-01")).alias("ref_date"), F.when(n % 13 != 0, n).alias("value"))
    return staging.stage_population(raw, TEXT, nation_codes(spark, sf, "Canada"))


@query("stage_two_sources", sql(f"""
select case event_type when 'signup' then 'registration' else event_type end as disease, a.period as ref_year, 'CA' as prov_code,
       'Canada' as region_name, cast(sum(n) as double) as total_cases, {r('cast(sum(n) as double) / any_value(pop) * 100000', 2)} as rate_per_100k,
       'national_time_series' as data_source, 'calendar' as year_type
from p2r a join (select period, cast(sum(n) as double) * 10 as pop from p2r group by period) b on a.period = b.period
where a.period >= 20240105 group by event_type, a.period
union all
select event_type, period, left(r_name, 2), r_name, cast(n as double), n * 1.5::double, 'provincial_snapshot', 'calendar'
from p2r where r_name not in ('EUROPE', 'AFRICA') and n % 9 <> 0
"""))
def stage_two_sources(spark, sf):
    """A national series by stratum and entity snapshots, some of them published twice."""
    days = materialise(P.p2_by_region(spark, sf), "days")
    r_name, n = F.col("r_name"), F.col("n")
    national = days.select(
        F.col("period").alias("year"), F.concat(F.lit(" "), "event_type").alias("disease"), F.lit(" All ").alias("age_group"),
        r_name.alias("sex"), n.alias("number_of_reported_cases"))
    copies = F.when(r_name == "ASIA", F.array(F.lit(2.0), F.lit(1.5))).otherwise(F.array(F.lit(1.5)))
    snapshots = days.select(
        F.col("event_type").alias("disease"), F.col("period").alias("year"), r_name.alias("region"),
        F.when(r_name == "EUROPE", " CA").when(r_name == "AFRICA", " ").otherwise(F.concat(F.lit(" "), F.left(r_name, F.lit(2)))).alias("prov_code"),
        n.alias("cases"), F.explode(copies).alias("_factor"))
    snapshots = snapshots.withColumn("rate_per_100k", F.when(F.col("cases") % 9 != 0, F.col("cases") * F.col("_factor"))).drop("_factor")
    population = days.groupBy(F.col("period").alias("ref_year")).agg((F.sum("n").cast("double") * 10).alias("population"))
    population = population.withColumn("prov_code", F.lit("CA"))
    domain = Domain(first_period=20240105, disease_names=TEXT.disease_names)
    return staging.stage_surveillance(national, snapshots, population, domain)
