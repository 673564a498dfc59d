"""Enriched panels to the wide tables that reports read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.classify import (
    burden_category, ci_comparison, event_period, flag_in, groups_of, lookup, outbreak_status, outcome_rank,
    severity_band, trend_direction,
)
from panelkit.functions.text import show_number
from panelkit.operators.clean import latest_flag
from panelkit.operators.shape import stack_indicators
from panelkit.operators.windows import peak_period, series_stats
from panelkit.plans.domain import DEFAULT, Domain
from panelkit.spec import PanelSpec


def _indicator_block(df: DataFrame, focus: str, prefix: str, rate: str, rate_name: str) -> DataFrame:
    """The focus entity's row per period under prefixed names."""
    return df.where(F.col("prov_code") == focus).select(
        "prov_code", "province_name", "fiscal_year", "statscan_population",
        F.col(rate).alias(rate_name),
        *[F.col(c).alias(f"{prefix}_{name}") for c, name in (
            ("national_rate", "national_rate"), ("gap_to_national", "gap_to_national"), ("yoy_change", "yoy_change"),
            ("yoy_pct_change", "yoy_pct_change"), ("rolling_avg_5yr_central", "rolling_avg_5yr"),
            ("rate_rank_desc", "national_rank"), ("is_suppressed", "is_suppressed"))],
        trend_direction("yoy_change").alias(f"{prefix}_trend_direction"),
        ci_comparison(rate, "national_ci_lower", "national_ci_upper", "national_rate").alias(f"{prefix}_national_comparison"),
    )


def focus_overview(admissions: DataFrame, readmissions: DataFrame, incidence: DataFrame,
                   domain: Domain = DEFAULT) -> DataFrame:
    """One row per period of the focus entity over three indicators.

    The first indicator decides the periods. Where another has no row, its
    labels still read as an unknown change and comparison do.
    """
    first = _indicator_block(admissions, domain.focus, "acsc", "age_standardized_rate", "acsc_rate").withColumnRenamed(
        "statscan_population", "population")
    shared = ("prov_code", "province_name", "statscan_population")
    second = _indicator_block(readmissions, domain.focus, "mh", "risk_adjusted_rate", "mh_readmission_rate").drop(*shared)
    third = _indicator_block(incidence, domain.focus, "diabetes", "age_standardized_rate", "diabetes_incidence_rate").drop(*shared)
    wide = first.join(second, "fiscal_year", "left").join(third, "fiscal_year", "left")
    wide = wide.withColumns({
        **{f"{x}_trend_direction": F.coalesce(F.col(f"{x}_trend_direction"), F.lit("Stable")) for x in ("mh", "diabetes")},
        **{f"{x}_national_comparison": F.coalesce(F.col(f"{x}_national_comparison"), F.lit("At National Rate"))
           for x in ("mh", "diabetes")},
        "cross_year_type_join_flag": F.lit(True),
    })
    return latest_flag(wide, "fiscal_year", "latest_data_year")


COMPARED = {
    "prov_code": "prov_code", "province_name": "province_name", "fiscal_year": "fiscal_year",
    "national_rate": "national_rate", "national_ci_lower": "national_ci_lower", "national_ci_upper": "national_ci_upper",
    "gap_to_national": "gap_to_national", "yoy_change": "yoy_change", "yoy_pct_change": "yoy_pct_change",
    "rolling_avg_5yr_central": "rolling_avg_5yr_central", "national_rank": "rate_rank_desc",
    "is_suppressed": "is_suppressed", "population": "statscan_population",
}


def _tags(domain: Domain) -> list[dict[str, str]]:
    units, years = ("per 100,000", "%", "per 100,000"), ("fiscal", "fiscal", "calendar")
    return [{"indicator_name": n, "rate_unit": u, "year_type": y} for n, u, y in zip(domain.indicators, units, years)]


RATES = ("age_standardized_rate", "risk_adjusted_rate", "age_standardized_rate")


def entity_comparison(admissions: DataFrame, readmissions: DataFrame, incidence: DataFrame,
                      domain: Domain = DEFAULT) -> DataFrame:
    """All entities and three indicators in one table, with ranks and labels."""
    frames = (admissions, readmissions, incidence)
    rows = stack_indicators([(df, {**COMPARED, "rate_value": rate}, tags)
                             for df, rate, tags in zip(frames, RATES, _tags(domain))])
    return rows.withColumns({
        "region_group": lookup("prov_code", groups_of(domain.regions), "National"),
        "national_comparison": ci_comparison("rate_value", "national_ci_lower", "national_ci_upper", "national_rate"),
        "is_focus": flag_in("prov_code", [domain.focus]),
        "is_territory": flag_in("prov_code", domain.territories),
        "rank_polarity": F.lit("lower_is_better"),
        "outcome_rank": outcome_rank("national_rank", domain.members),
        "burden_category": burden_category("national_rank", 3, domain.members - 2),
    })


def trend_series(linked: DataFrame, readmissions: DataFrame, incidence: DataFrame, domain: Domain = DEFAULT) -> DataFrame:
    """Series of the focus entity, its peers and the benchmark, with summary columns."""
    name = (
        F.when(F.col("prov_code") == domain.focus, domain.focus_name)
        .when(F.col("prov_code") == domain.benchmark, domain.benchmark_label)
        .otherwise(F.col("province_name"))
    )
    parts = []
    for df, rate, tags in zip((linked, readmissions, incidence), RATES, _tags(domain)):
        rows = df.where(F.col("prov_code").isin(domain.peers) & F.col(rate).isNotNull())
        parts.append((rows, {
            "fiscal_year": "fiscal_year", "rate_value": rate, "ci_lower": "ci_lower", "ci_upper": "ci_upper",
            "is_suppressed": "is_suppressed", "population": "statscan_population", "series_name": name,
            "prov_code": "prov_code"}, tags))
    p = PanelSpec("prov_code", "fiscal_year", "rate_value", ("indicator_name",))
    return series_stats(stack_indicators(parts), p)


def harms_report(enriched: DataFrame, domain: Domain = DEFAULT) -> DataFrame:
    p = PanelSpec("prov_code", "ref_year", "crude_rate_per_100k", ("substance", "harm_type"))
    rows = enriched.select(
        "prov_code", "region_name", "ref_year", "year_label", "substance", "harm_type", "harm_type_label",
        "crude_rate_per_100k", "national_rate", "gap_to_national", "benchmark_ratio", "yoy_change", "yoy_pct_change",
        "rolling_avg_3yr", F.col("rate_rank_desc").alias("national_rank"), "is_emergency_period", "is_suppressed",
        "statscan_population",
        F.concat("substance", F.lit(" — "), "harm_type_label").alias("indicator_label"),
        trend_direction("yoy_change").alias("trend_direction"),
        severity_band("benchmark_ratio", 4).alias("severity_vs_national"),
        event_period("ref_year", domain.event_pre, domain.event_from).alias("emergency_period_label"),
        F.lit("calendar").alias("year_type"),
    )
    return series_stats(rows, p)


def surveillance_report(enriched: DataFrame, domain: Domain = DEFAULT) -> DataFrame:
    """Suppressed rows leave before the summary columns are computed."""
    p = PanelSpec("prov_code", "ref_year", "rate_per_100k", ("disease",))
    rows = enriched.where(~F.col("is_suppressed")).drop("prev_year_rate").withColumns({
        "trend_direction": trend_direction("yoy_change"),
        "outbreak_status_label": outbreak_status("is_outbreak_signal", "outbreak_z_score"),
        "disease_category": lookup("disease", groups_of(domain.disease_groups), "Other"),
        "is_focus": flag_in("prov_code", [domain.focus]),
        "is_territory": flag_in("prov_code", domain.territories),
        "severity_vs_national": severity_band("prov_vs_national_ratio", 5),
    })
    return series_stats(rows, p).withColumn("peak_year", peak_period(p))


def unit_rate(unit: Column | str, rate: Column | str) -> Column:
    """A rate as text: one decimal for percentages, none otherwise."""
    unit = F.col(unit) if isinstance(unit, str) else unit
    return F.when(unit == "%", show_number(rate, 1)).otherwise(show_number(rate, 0))
