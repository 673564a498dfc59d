"""Tables behind the pages of a report, computed from the marts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.classify import alarm_light, gap_narrative, light_label, traffic_light
from panelkit.functions.text import show_number
from panelkit.operators.clean import latest_period_rows, map_code_folded
from panelkit.operators.forecast import trend_test
from panelkit.operators.shape import region_average
from panelkit.plans.domain import DEFAULT, ENTITY_ALIASES, ENTITY_CODES, Domain
from panelkit.plans.marts import unit_rate
from panelkit.spec import PanelSpec

# Outbreak labels from worst to best.
STATUS_ORDER = ("Severe Outbreak", "Outbreak Detected", "Elevated", "Normal Range")

STATUS_COLUMNS = ("domain", "period", "value", "latest_rate", "comparison", "trend", "rank_text", "gap_text", "light", "status")


def status_severity(status: Column | str) -> Column:
    """Position in the worst-to-best order; unknown labels sort last."""
    status = F.col(status) if isinstance(status, str) else status
    out = F.lit(len(STATUS_ORDER))
    for i, label in reversed(list(enumerate(STATUS_ORDER))):
        out = F.when(status == label, i).otherwise(out)
    return out


def _overview_line(overview: DataFrame, name: str, prefix: str, rate: str, digits: int, suffix: str,
                   last_own: bool, members: int) -> DataFrame:
    """One line for an indicator: its row in the latest period, or its own last row."""
    rows = overview.where(F.col(rate).isNotNull())
    if not last_own:
        rows = rows.where("is_latest")
    picked = {
        "period": "fiscal_year", "value": rate, "comparison": f"{prefix}_national_comparison",
        "trend": f"{prefix}_trend_direction", "rank": f"{prefix}_national_rank", "gap": f"{prefix}_gap_to_national",
    }
    row = F.max_by(F.struct(*[F.col(c).alias(k) for k, c in picked.items()]), "fiscal_year")
    line = rows.agg(row.alias("r")).where("r is not null").select("r.*")
    return line.select(
        F.lit(name).alias("domain"), F.col("period").cast("int").alias("period"), "value",
        F.concat(show_number("value", digits), F.lit(suffix)).alias("latest_rate"),
        F.coalesce("comparison", F.lit("N/A")).alias("comparison"), "trend",
        F.coalesce(F.concat(F.lit("#"), F.col("rank").cast("string"), F.lit(f"/{members}")), F.lit("N/A")).alias("rank_text"),
        show_number("gap", digits, signed=True).alias("gap_text"),
        traffic_light("comparison").alias("light"),
    )


def worst_status(surveillance: DataFrame, domain: Domain = DEFAULT) -> DataFrame:
    """The benchmark's disease with the worst status in its latest period, in one pass."""
    order = F.struct(-F.col("ref_year"), status_severity("outbreak_status_label"), F.col("disease"))
    row = F.min_by(F.struct("disease", "ref_year", "rate_per_100k", "outbreak_status_label"), order)
    national = surveillance.where(F.col("prov_code") == domain.benchmark)
    return national.agg(row.alias("r")).where("r is not null").select("r.*")


def status_table(overview: DataFrame, harms: DataFrame, surveillance: DataFrame, domain: Domain = DEFAULT) -> DataFrame:
    """One line per domain: latest value, comparison, trend, rank and light."""
    lines = [
        _overview_line(overview, domain.indicators[0], "acsc", "acsc_rate", 0, " per 100k", False, domain.members),
        _overview_line(overview, domain.indicators[1], "mh", "mh_readmission_rate", 1, "%", False, domain.members),
        _overview_line(overview, domain.indicators[2], "diabetes", "diabetes_incidence_rate", 0, " per 100k", True, domain.members),
    ]
    substance, label = domain.headline_harm
    own = harms.where((F.col("prov_code") == domain.focus) & (F.col("substance") == substance) & (F.col("harm_type_label") == label))
    row = F.max_by(F.struct("ref_year", "crude_rate_per_100k", "severity_vs_national", "trend_direction"), "ref_year")
    harm = own.agg(row.alias("r")).where("r is not null").select("r.*")
    lines.append(harm.select(
        F.lit(domain.headline_name).alias("domain"), F.col("ref_year").cast("int").alias("period"),
        F.col("crude_rate_per_100k").alias("value"),
        F.concat(show_number("crude_rate_per_100k", 1), F.lit(" per 100k")).alias("latest_rate"),
        F.coalesce("severity_vs_national", F.lit("N/A")).alias("comparison"), F.col("trend_direction").alias("trend"),
        F.lit("N/A").alias("rank_text"), F.lit("N/A").alias("gap_text"),
        traffic_light("severity_vs_national").alias("light"),
    ))
    worst = worst_status(surveillance, domain)
    lines.append(worst.select(
        F.lit("Communicable Disease").alias("domain"), F.col("ref_year").cast("int").alias("period"),
        F.col("rate_per_100k").alias("value"),
        F.concat(show_number("rate_per_100k", 1), F.lit(" per 100k ("), "disease", F.lit(")")).alias("latest_rate"),
        F.col("outbreak_status_label").alias("comparison"), F.lit("National surveillance").alias("trend"),
        F.lit("N/A").alias("rank_text"), F.lit("N/A").alias("gap_text"),
        alarm_light("outbreak_status_label").alias("light"),
    ))
    table = reduce(lambda a, b: a.unionByName(b), lines)
    return table.withColumn("status", light_label("light")).select(*STATUS_COLUMNS)


def status_counts(status: DataFrame) -> DataFrame:
    return status.agg(*[F.count_if(F.col("light") == c).alias(f"{c}_count") for c in ("red", "yellow", "green")])


def slice_of(comparison: DataFrame, indicator: str, period: int | None = None, benchmark: str | None = None) -> DataFrame:
    """Rows of one indicator and period (by default its last) without the benchmark."""
    rows = comparison.where(F.col("indicator_name") == indicator)
    if benchmark is not None:
        rows = rows.where(F.col("prov_code") != benchmark)
    return latest_period_rows(rows, "fiscal_year") if period is None else rows.where(F.col("fiscal_year") == period)


def ranking_table(rows: DataFrame) -> DataFrame:
    """The ranking of a slice with display texts."""
    return rows.select(
        "prov_code", "province_name", unit_rate("rate_unit", "rate_value").alias("rate_text"),
        "national_rank", "outcome_rank", "burden_category", "national_comparison",
        show_number("gap_to_national", 1, signed=True).alias("gap_text"),
    )


def region_table(rows: DataFrame) -> DataFrame:
    return region_average(rows, ["region_group"], "rate_value")


def gap_list(rows: DataFrame) -> DataFrame:
    """Entities with a benchmark by the size of their gap, with its words."""
    return rows.where(F.col("gap_to_national").isNotNull()).select(
        "prov_code", "gap_to_national", gap_narrative("gap_to_national").alias("narrative")).orderBy("gap_to_national")


def geo_codes(shapes: DataFrame, name: str, out: str = "prov_code", min_matches: int = 10) -> DataFrame:
    """Codes of the names a map file uses: published names and their aliases, with or without accents."""
    spellings = shapes.sparkSession.createDataFrame([*ENTITY_CODES.items(), *ENTITY_ALIASES.items()], "name string, code string")
    return map_code_folded(shapes, name, out, spellings, min_matches)


def slice_reference(rows: DataFrame) -> DataFrame:
    """The unit and the benchmark value that all rows of a slice share."""
    return rows.agg(F.max("rate_unit").alias("rate_unit"), F.max("national_rate").alias("national_rate"))


def findings(df: DataFrame, p: PanelSpec, focus: str, benchmark: str, h: int = 3) -> DataFrame:
    """Per category: latest focus and benchmark value, gap, forecast end and trend, as numbers and a sentence."""
    if not p.category:
        df, p = df.withColumn("indicator", F.lit("all")), PanelSpec(p.entity, p.period, p.value, ("indicator",))
    category: Sequence[str] = p.category

    def last(name: str) -> Column:
        here = F.col(p.entity) == name
        return F.max_by(F.when(here, F.col(p.value)), F.when(here, F.col(p.period)))

    latest = df.where(F.col(p.entity).isin(focus, benchmark)).groupBy(*category).agg(
        F.max(F.when(F.col(p.entity) == focus, F.col(p.period))).alias("latest_period"),
        last(focus).alias("focus_value"), last(benchmark).alias("benchmark_value"))
    ends = trend_test(df.where(F.col(p.entity) == focus), p, h).where(F.col("step") == h).select(
        *category, F.col("period").alias("forecast_period"), "yhat", "lo95", "hi95", "slope", "p_value", "direction")
    rows = latest.join(ends, list(category), "left")
    rows = rows.withColumn("gap", F.col("focus_value") - F.col("benchmark_value"))
    text = F.concat(
        F.lit("Latest "), F.col("latest_period").cast("string"), F.lit(": "), show_number("focus_value", 1),
        F.lit(", benchmark "), show_number("benchmark_value", 1), F.lit(" (gap "), show_number("gap", 1), F.lit(")"),
        F.lit("; trend "), F.coalesce("direction", F.lit("N/A")), F.lit(" at "), show_number("slope", 2), F.lit(" per period"))
    return rows.withColumn("sentence", text)
