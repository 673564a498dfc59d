"""Staged panels to enriched panels: population, benchmark, change, ranks.

Every plan makes the comparisons across entities first and the statistics over
time second, so that a panel is shuffled twice however many columns are added,
and a filter on entities reaches the second shuffle. Benchmark rows stay in the
panel until their values were read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.classify import is_after_event
from panelkit.functions.numeric import (
    gap_to_benchmark, rate_per, ratio_to_benchmark, suppress_small_cells,
)
from panelkit.operators import alarm
from panelkit.operators.link import link_population, linked_flag
from panelkit.operators.windows import attach_benchmark, rank_desc, rolling, yoy
from panelkit.plans.domain import DEFAULT, Domain
from panelkit.spec import PanelSpec

NATIONAL = {"ci_lower": "national_ci_lower", "ci_upper": "national_ci_upper"}


def link_admissions(staged: DataFrame, population: DataFrame, domain: Domain = DEFAULT) -> DataFrame:
    """Link the population. Members and benchmark differ only in tags, so one
    pass and one join on code and year serve both."""
    level = F.lower("reporting_level")
    national = level == "national"
    rows = staged.where(level.isin("province/territory", "national")).withColumns({
        "prov_code": F.when(national, domain.benchmark).otherwise(F.col("prov_code")),
        "province_name": F.when(national, domain.benchmark_name).otherwise(F.col("province_name")),
        "geo_level": F.when(national, "national").otherwise("province"),
    })
    rows = link_population(rows, population, {"prov_code": "prov_code", "fiscal_year": "ref_year"}, out="statscan_population")
    return rows.select(
        "prov_code", "province_name", "fiscal_year", "fiscal_year_label", "indicator_name",
        "age_standardized_rate", "ci_lower", "ci_upper", "numerator",
        F.col("denominator").alias("cihi_denominator"), "crude_rate", "statscan_population", "geo_level",
        rate_per("numerator", "statscan_population").alias("calculated_rate_per_100k"),
        suppress_small_cells("age_standardized_rate", "numerator", 5).alias("is_suppressed"),
        linked_flag("statscan_population").alias("population_linked"),
    )


def _enrich(rows: DataFrame, p: PanelSpec, domain: Domain, members: Column, rolled: tuple[str, Column],
            change_digits: int | None = None, pct_digits: int | None = None, bounds: bool = True) -> DataFrame:
    """Benchmark and rank across entities, then change and moving average of the members over time.

    A member's series has no benchmark rows, so these may go before its windows;
    entities are a key of those, so a filter on them goes below.
    """
    read = {p.value: "national_rate", **(NATIONAL if bounds else {})}
    rows = attach_benchmark(rows, p, domain.benchmark, read)
    rows = rows.where(members).withColumn("rate_rank_desc", rank_desc(p.cross, p.value))
    return yoy(rows, p, change_digits, pct_digits).withColumn(*rolled)


def admissions_change(linked: DataFrame, domain: Domain = DEFAULT, missing_benchmark: str = "zero") -> DataFrame:
    p = PanelSpec("prov_code", "fiscal_year", "age_standardized_rate")
    rows = linked.where(F.col(p.value).isNotNull())
    rows = _enrich(rows, p, domain, F.col("geo_level") == "province",
                   ("rolling_avg_5yr_central", rolling(p, 2, 2, digits=1)), 1, 1)
    return rows.select(
        "prov_code", "province_name", "fiscal_year", "age_standardized_rate", "statscan_population", "geo_level",
        F.col("prev_value").alias("prev_year_rate"), "yoy_change", "yoy_pct_change", "rolling_avg_5yr_central",
        "national_rate", "national_ci_lower", "national_ci_upper",
        gap_to_benchmark("age_standardized_rate", "national_rate", 1, missing_benchmark).alias("gap_to_national"),
        "is_suppressed", "rate_rank_desc",
    )


def readmissions_enriched(staged: DataFrame, population: DataFrame, domain: Domain = DEFAULT) -> DataFrame:
    p = PanelSpec("prov_code", "fiscal_year", "risk_adjusted_rate")
    member = F.col("reporting_level") == "Province/territory"
    rows = staged.where(member | (F.col("prov_code") == domain.benchmark))
    rows = _enrich(rows, p, domain, member, ("rolling_avg_5yr_central", rolling(p, 2, 2)))
    rows = link_population(rows, population, {"prov_code": "prov_code", "fiscal_year": "ref_year"}, out="statscan_population")
    after = is_after_event("fiscal_year", domain.event_from)
    return rows.select(
        "prov_code", "province_name", "fiscal_year", "fiscal_year_label", "indicator_name",
        "risk_adjusted_rate", "ci_lower", "ci_upper", "numerator", "denominator", "crude_rate", "statscan_population",
        "national_rate", "national_ci_lower", "national_ci_upper",
        gap_to_benchmark("risk_adjusted_rate", "national_rate").alias("gap_to_national"),
        "yoy_change", "yoy_pct_change", "rolling_avg_5yr_central", "rate_rank_desc",
        suppress_small_cells("risk_adjusted_rate", "numerator", 5).alias("is_suppressed"),
        after.alias("is_emergency_overlap_period"),
        F.when(after, domain.event_note).alias("interpretation_note"),
    )


def incidence_enriched(staged: DataFrame, population: DataFrame, domain: Domain = DEFAULT) -> DataFrame:
    p = PanelSpec("prov_code", "fiscal_year", "age_standardized_rate")
    rows = _enrich(staged, p, domain, F.col("prov_code") != domain.benchmark,
                   ("rolling_avg_5yr_central", rolling(p, 2, 2)))
    rows = link_population(rows, population, {"prov_code": "prov_code", "fiscal_year": "ref_year"}, out="statscan_population")
    remote = F.col("prov_code") == domain.focus
    return rows.select(
        "prov_code", "province_name", "fiscal_year", "fiscal_year_label", "indicator_name",
        "age_standardized_rate", "ci_lower", "ci_upper", "case_counts", "phac_population", "statscan_population",
        "national_rate", "national_ci_lower", "national_ci_upper",
        gap_to_benchmark("age_standardized_rate", "national_rate").alias("gap_to_national"),
        "yoy_change", "yoy_pct_change", "rolling_avg_5yr_central", "rate_rank_desc",
        suppress_small_cells("age_standardized_rate", "case_counts", 10).alias("is_suppressed"),
        remote.alias("apply_remote_access_caveat"),
        F.when(remote, domain.access_note).alias("remote_access_interpretation_note"),
    )


def harms_enriched(staged: DataFrame, population: DataFrame, domain: Domain = DEFAULT) -> DataFrame:
    p = PanelSpec("prov_code", "ref_year", "crude_rate_per_100k", ("substance", "harm_type"))
    rows = staged.where(~F.col("is_partial_year"))
    rows = _enrich(rows, p, domain, F.col("prov_code") != domain.benchmark,
                   ("rolling_avg_3yr", rolling(p, 2, 0, digits=1)), None, 1, bounds=False)
    rows = link_population(rows, population, {"prov_code": "prov_code", "ref_year": "ref_year"}, out="statscan_population")
    return rows.select(
        "prov_code", "region_name", "ref_year", "year_label", "substance", "harm_type", "harm_type_label",
        "crude_rate_per_100k", "is_partial_year", "statscan_population", "national_rate",
        gap_to_benchmark("crude_rate_per_100k", "national_rate").alias("gap_to_national"),
        ratio_to_benchmark("crude_rate_per_100k", "national_rate").alias("benchmark_ratio"),
        "yoy_change", "yoy_pct_change", "rolling_avg_3yr", "rate_rank_desc",
        is_after_event("ref_year", domain.event_from).alias("is_emergency_period"),
        suppress_small_cells("crude_rate_per_100k").alias("is_suppressed"),
    )


def surveillance_enriched(staged: DataFrame, domain: Domain = DEFAULT, baseline: str = "central") -> DataFrame:
    """Alarms on the benchmark series, and each member against the benchmark.

    Member series are sparse snapshots: their columns over time stay NULL.
    Both kinds of rows go through the same windows, which avoids a union and a
    self-join.
    """
    p = PanelSpec("prov_code", "ref_year", "rate_per_100k", ("disease",))
    national = F.col("prov_code") == domain.benchmark
    rows = yoy(staged, p, pct_digits=1, guard="nonzero").withColumns({
        "rolling_avg_5yr_central": rolling(p, 2, 2, digits=2),
        "rolling_stddev_5yr": rolling(p, 2, 2, "stddev_pop"),
        "outbreak_z_score": alarm.outbreak_zscore(p, baseline=baseline),
        "is_outbreak_signal": alarm.outbreak_signal(p, baseline=baseline),
    })
    over_time = ["prev_value", "yoy_change", "yoy_pct_change", "rolling_avg_5yr_central", "rolling_stddev_5yr", "outbreak_z_score"]
    rows = rows.withColumns({c: F.when(national, F.col(c)) for c in over_time})
    rows = rows.withColumns({
        "is_outbreak_signal": national & F.col("is_outbreak_signal"),
        "_national": national,
    })
    rows = attach_benchmark(rows, p, domain.benchmark, {
        p.value: "national_rate", "is_outbreak_signal": "national_outbreak_active"})
    rows = rows.withColumn("_member_rank", rank_desc(["disease", "ref_year", "_national"], p.value))
    # Only benchmark rows need this rank; members are spread, so that no task holds those of a period.
    rows = rows.withColumn("_alone", F.when(~F.col("_national"), F.concat_ws("|", "prov_code", "disease")))
    rows = rows.withColumn("_national_rank", rank_desc(["ref_year", "_alone"], p.value))
    member = ~F.col("_national")
    return rows.select(
        "disease", "ref_year", "prov_code", "region_name", "total_cases", "rate_per_100k", "data_source", "year_type",
        F.col("prev_value").alias("prev_year_rate"), "yoy_change", "yoy_pct_change",
        "rolling_avg_5yr_central", "rolling_stddev_5yr", "is_outbreak_signal", "outbreak_z_score",
        F.when(member, F.col("_member_rank")).otherwise(F.col("_national_rank")).alias("disease_rank_by_rate"),
        suppress_small_cells("rate_per_100k", "total_cases", 5).alias("is_suppressed"),
        "national_rate",
        F.when(member, gap_to_benchmark("rate_per_100k", "national_rate", 2)).alias("gap_to_national"),
        F.when(member, ratio_to_benchmark("rate_per_100k", "national_rate")).alias("prov_vs_national_ratio"),
        "national_outbreak_active",
    )
