"""Raw text tables to typed, coded panels: one function per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.classify import lookup
from panelkit.functions.numeric import rate_per
from panelkit.functions.text import (
    is_unparsed, parse_leading_year, parse_number, parse_period, partial_period_flag, tidy,
)
from panelkit.operators.clean import drop_incomplete, drop_levels, keep_levels, map_code
from panelkit.operators.link import link_population
from panelkit.operators.shape import combine_strata
from panelkit.operators.windows import priority_dedup
from panelkit.plans.domain import DEFAULT, Domain

REPORTED = ("province/territory", "national")


def _reported(raw: DataFrame, numbers: dict[str, str], names) -> DataFrame:
    """The steps the two hospital tables share: level filter, code, period, numbers."""
    rows = keep_levels(raw, {"reporting_level": REPORTED}, ignore_case=True)
    rows = map_code(rows, "province_territory", "prov_code", names)
    rows = rows.select(
        tidy("province_territory").alias("province_name"),
        "prov_code",
        parse_period("time_frame").alias("fiscal_year"),
        F.trim("time_frame").alias("fiscal_year_label"),
        F.trim("reporting_level").alias("reporting_level"),
        F.trim("indicator").alias("indicator_name"),
        *[parse_number(F.col(f"`{source}`")).alias(name) for name, source in numbers.items()],
        F.lit("fiscal").alias("year_type"),
    )
    return drop_incomplete(rows, ["prov_code", "fiscal_year"])


def stage_admissions(raw: DataFrame, domain: Domain = DEFAULT, names=None) -> DataFrame:
    """Avoidable admissions; the benchmark row is spelled '-'."""
    numbers = {
        "age_standardized_rate": "age_standardized_rate",
        "ci_lower": "confidence_interval_lower_limit",
        "ci_upper": "confidence_interval_upper_limit",
        "numerator": "numerator", "denominator": "denominator", "crude_rate": "crude_rate",
    }
    return _reported(raw, numbers, domain.names_with("-") if names is None else names)


def stage_readmissions(raw: DataFrame, domain: Domain = DEFAULT, names=None) -> DataFrame:
    """Readmissions, overall rows only; the benchmark row is spelled 'N/A'."""
    prefix = "risk_adjusted_rate:_confidence_interval"
    numbers = {
        "risk_adjusted_rate": "risk_adjusted_rate",
        "ci_lower": f"{prefix}_lower_limit", "ci_upper": f"{prefix}_upper_limit",
        "numerator": "numerator", "denominator": "denominator", "crude_rate": "crude_rate",
    }
    overall = keep_levels(raw, {"level_1_breakdown": ["Not applicable"]})
    return _reported(overall, numbers, domain.names_with("N/A") if names is None else names)


def stage_incidence(raw: DataFrame, domain: Domain = DEFAULT, names=None) -> DataFrame:
    """Incidence of both sexes and all ages. Rows whose geography has no code are
    footnotes, so the code lookup is the allow-list."""
    rows = keep_levels(raw, {"sex": ["Both sexes"], "age_group_type": ["Total"]})
    rows = map_code(rows, "geography", "prov_code", domain.names_with(domain.benchmark_name) if names is None else names)
    rows = rows.select(
        tidy("geography").alias("province_name"),
        "prov_code",
        parse_period("fiscal_year").alias("_year"),
        F.trim("fiscal_year").alias("fiscal_year_label"),
        F.lit(domain.indicators[2]).alias("indicator_name"),
        F.col("rate_per_100000").alias("age_standardized_rate"),
        F.col("lower_95pct_ci").alias("ci_lower"), F.col("upper_95pct_ci").alias("ci_upper"),
        "standard_error", "case_counts",
        F.col("population").alias("phac_population"),
        F.lit("calendar").alias("year_type"),
    ).withColumnRenamed("_year", "fiscal_year")
    return drop_incomplete(rows, ["prov_code", "fiscal_year", "age_standardized_rate"])


def stage_harms(raw: DataFrame, domain: Domain = DEFAULT, names=None) -> DataFrame:
    """Substance harms: overall crude yearly rates of whole entities."""
    rows = keep_levels(raw, {"specific_measure": ["Overall numbers"], "unit": ["Crude rate"], "time_period": ["By year"]})
    rows = drop_levels(rows, {"region": domain.sub_regions})
    rows = map_code(rows, "region", "prov_code", domain.names_with(domain.benchmark_name) if names is None else names)
    rows = rows.select(
        F.trim("substance").alias("substance"),
        F.trim("source").alias("harm_type"),
        lookup(F.trim("source"), domain.harm_labels).alias("harm_type_label"),
        tidy("region").alias("region_name"),
        "prov_code",
        parse_leading_year("year_quarter").alias("ref_year"),
        partial_period_flag("year_quarter").alias("is_partial_year"),
        F.trim("year_quarter").alias("year_label"),
        parse_number("value").alias("crude_rate_per_100k"),
        F.lit("calendar").alias("year_type"),
    )
    return drop_incomplete(rows, ["prov_code", "ref_year", "crude_rate_per_100k"])


def stage_population(raw: DataFrame, domain: Domain = DEFAULT, names=None) -> DataFrame:
    """Population by entity and year, from the first period of interest on."""
    rows = map_code(raw.where(F.col("value").isNotNull()), "geo", "prov_code",
                    domain.names_with(domain.benchmark_name) if names is None else names)
    rows = rows.select(
        tidy("geo").alias("province_name"), "prov_code",
        parse_leading_year("ref_date").alias("ref_year"),
        F.col("value").cast("double").alias("population"),
        F.lit("calendar").alias("year_type"),
    )
    return drop_incomplete(rows, ["prov_code"]).where(F.col("ref_year") >= domain.first_period)


SURVEILLANCE_COLUMNS = ("disease", "ref_year", "prov_code", "region_name", "total_cases", "rate_per_100k",
                        "data_source", "year_type")


def stage_surveillance(national: DataFrame, snapshots: DataFrame, population: DataFrame,
                       domain: Domain = DEFAULT) -> DataFrame:
    """Disease counts from a national series by sex and from entity snapshots.

    The national strata are summed and divided by the benchmark population;
    the snapshots carry published rates, and win where both have a key.
    """
    by = keep_levels(national, {"age_group": ["All"]}).where(F.col("year") >= domain.first_period)
    by = by.select(F.col("year").cast("int").alias("ref_year"), F.trim("disease").alias("disease"),
                   F.col("number_of_reported_cases").alias("total_cases"))
    totals = combine_strata(by, ["ref_year", "disease"], ["total_cases"], "sex_count")
    totals = link_population(totals, population, {"ref_year": "ref_year"}, only=F.col("prov_code") == domain.benchmark)
    cases = F.col("total_cases").cast("double")
    series = totals.select(
        lookup("disease", domain.disease_names, F.col("disease")).alias("disease"),
        "ref_year",
        F.lit(domain.benchmark).alias("prov_code"), F.lit(domain.benchmark_name).alias("region_name"),
        cases.alias("total_cases"), rate_per(cases, "population", digits=2).alias("rate_per_100k"),
        F.lit("national_time_series").alias("data_source"),
    )
    code = F.trim("prov_code")
    members = snapshots.where((code != "") & (code != domain.benchmark)).select(
        F.trim("disease").alias("disease"), F.col("year").cast("int").alias("ref_year"),
        code.alias("prov_code"), F.trim("region").alias("region_name"),
        F.col("cases").cast("double").alias("total_cases"), F.col("rate_per_100k").cast("double").alias("rate_per_100k"),
        F.lit("provincial_snapshot").alias("data_source"),
    )
    both = drop_incomplete(series.unionByName(members), ["ref_year", "rate_per_100k"])
    best = priority_dedup(both, ["disease", "ref_year", "prov_code"], "data_source",
                          ["provincial_snapshot", "national_time_series"], tiebreak=["rate_per_100k", "total_cases"])
    return best.withColumn("year_type", F.lit("calendar")).select(*SURVEILLANCE_COLUMNS)


def unparsed_counts(raw: DataFrame, cols: list[str]) -> DataFrame:
    """How many texts of each column are neither numbers nor suppression tokens."""
    def bad(name: str) -> Column:
        return F.count_if(is_unparsed(F.col(f"`{name}`"))).alias(name)

    counts = raw.agg(*[bad(c) for c in cols])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("unparsed")) for c in cols])))
