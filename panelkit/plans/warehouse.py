"""The whole refresh: published CSV files to raw, staged, enriched and mart tables, and their checks.

Every table is written once and read back by the tables that build on it, so
no step repeats the work of an earlier one. ``load`` and ``run`` can be repeated:
each rebuilds its tables whole.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from panelkit.operators import quality as Q
from panelkit.operators.forecast import forecast_auto
from panelkit.plans import enriched, marts, reports, staging
from panelkit.plans.domain import DEFAULT, Domain
from panelkit.sources.csv import TOTAL_LABELS, filter_total_rows, read_csv_table
from panelkit.sources.tables import path_exists, read_table, write_measured, write_table
from panelkit.spec import PanelSpec

log = logging.getLogger(__name__)

TEXT, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()


@dataclass(frozen=True)
class Source:
    """Columns read from one published file, after header cleaning."""

    columns: Mapping[str, T.DataType]
    skip_rows: int = 0
    encoding: str = "UTF-8"
    totals_only: bool = False

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t) for n, t in self.columns.items()])


def _texts(*names: str) -> dict[str, T.DataType]:
    return dict.fromkeys(names, TEXT)


# The columns and peculiarities of the seven published files.
SOURCES = {
    "admissions": Source(_texts(
        "province_territory", "reporting_level", "time_frame", "indicator", "age_standardized_rate",
        "confidence_interval_lower_limit", "confidence_interval_upper_limit", "numerator", "denominator", "crude_rate")),
    "readmissions": Source(_texts(
        "province_territory", "reporting_level", "level_1_breakdown", "time_frame", "indicator", "risk_adjusted_rate",
        "risk_adjusted_rate:_confidence_interval_lower_limit", "risk_adjusted_rate:_confidence_interval_upper_limit",
        "numerator", "denominator", "crude_rate"), skip_rows=1),
    "incidence": Source({
        **_texts("geography", "sex", "age_group_type", "fiscal_year"),
        "rate_per_100000": DOUBLE, "lower_95pct_ci": DOUBLE, "upper_95pct_ci": DOUBLE, "standard_error": DOUBLE,
        "case_counts": DOUBLE, "population": DOUBLE}, skip_rows=1, encoding="ISO-8859-1"),
    "harms": Source(_texts("substance", "source", "specific_measure", "unit", "time_period", "region", "year_quarter", "value")),
    "population": Source({**_texts("geo", "ref_date"), "value": DOUBLE}, totals_only=True),
    "national_cases": Source({
        "year": LONG, **_texts("disease", "age_group", "sex"), "number_of_reported_cases": LONG, "rate_per_100000": DOUBLE}),
    "snapshots": Source({
        **_texts("disease"), "year": LONG, **_texts("region", "prov_code"), "cases": DOUBLE, "rate_per_100k": DOUBLE,
        **_texts("source_report")}),
}


def scan(spark: SparkSession, name: str, path: str) -> DataFrame:
    """One published file as a typed table; an empty one when the file is missing."""
    source = SOURCES[name]
    df = read_csv_table(spark, path, source.schema(), source.skip_rows, source.encoding,
                        optional=list(TOTAL_LABELS) if source.totals_only else ())
    return filter_total_rows(df).select(*source.columns) if source.totals_only else df


def load(spark: SparkSession, paths: Mapping[str, str], out: str) -> dict[str, int | None]:
    """Write the raw tables; returns the rows of each.

    A missing file leaves the raw table of an earlier load as it is and is
    reported as None. Only where there is none an empty table is written.
    """
    rows: dict[str, int | None] = {}
    for name, path in paths.items():
        target = f"{out}/raw/{name}"
        if not path_exists(spark, path) and path_exists(spark, target):
            log.warning("no file at %s, keeping the table %s", path, target)
            rows[name] = None
        else:
            rows[name] = write_table(scan(spark, name, path), target)
    return rows


def run(spark: SparkSession, out: str, domain: Domain = DEFAULT, failures: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """Build staged, enriched and mart tables from the raw ones under ``out``.

    With ``failures`` the standard checks are made on the way, and their failures put
    there by name: those of rows are summed up while a table is written, keys are
    counted in one pass over the written table.
    """
    tables: dict[str, DataFrame] = {}
    checks = [] if failures is None else standard_checks(domain)

    def raw(name: str) -> DataFrame:
        return read_table(spark, f"{out}/raw/{name}")

    def put(name: str, df: DataFrame) -> DataFrame:
        own = [c for c in checks if c.table == name]
        keys = [c for c in own if isinstance(c, Q.Unique)]
        scalars = [c for c in own if not isinstance(c, Q.Unique)]
        found = write_measured(df, f"{out}/{name}", {f"c{i}": Q.measured(c) for i, c in enumerate(scalars)})
        tables[name] = read_table(spark, f"{out}/{name}")
        if failures is not None:
            failures.update({c.name: failures.get(c.name, 0) + found[f"c{i}"] for i, c in enumerate(scalars)})
            if keys:
                failures.update({r["check"]: r["failures"] for r in Q.unique_counts(tables[name], keys).collect()})
        return tables[name]

    people = put("staging/population", staging.stage_population(raw("population"), domain))
    admissions = put("staging/admissions", staging.stage_admissions(raw("admissions"), domain))
    readmissions = put("staging/readmissions", staging.stage_readmissions(raw("readmissions"), domain))
    incidence = put("staging/incidence", staging.stage_incidence(raw("incidence"), domain))
    harms = put("staging/harms", staging.stage_harms(raw("harms"), domain))
    diseases = put("staging/surveillance", staging.stage_surveillance(raw("national_cases"), raw("snapshots"), people, domain))

    linked = put("enriched/linked_admissions", enriched.link_admissions(admissions, people, domain))
    change = put("enriched/admissions_change", enriched.admissions_change(linked, domain))
    readmissions = put("enriched/readmissions", enriched.readmissions_enriched(readmissions, people, domain))
    incidence = put("enriched/incidence", enriched.incidence_enriched(incidence, people, domain))
    harms = put("enriched/harms", enriched.harms_enriched(harms, people, domain))
    diseases = put("enriched/surveillance", enriched.surveillance_enriched(diseases, domain))

    put("marts/focus_overview", marts.focus_overview(change, readmissions, incidence, domain))
    put("marts/entity_comparison", marts.entity_comparison(change, readmissions, incidence, domain))
    put("marts/trend_series", marts.trend_series(linked, readmissions, incidence, domain))
    put("marts/harms_report", marts.harms_report(harms, domain))
    put("marts/surveillance_report", marts.surveillance_report(diseases, domain))
    return tables


def report(tables: Mapping[str, DataFrame], domain: Domain = DEFAULT, h: int = 3) -> dict[str, DataFrame]:
    """The summary tables and forecasts computed from the marts."""
    status = reports.status_table(tables["marts/focus_overview"], tables["marts/harms_report"],
                                  tables["marts/surveillance_report"], domain)
    p = PanelSpec("prov_code", "fiscal_year", "rate_value", ("indicator_name",))
    series = tables["marts/trend_series"]
    return {
        "status": status,
        "status_counts": reports.status_counts(status),
        "forecast": forecast_auto(series, p, h),
        "findings": reports.findings(series, p, domain.focus, domain.benchmark, h),
    }


def standard_checks(domain: Domain = DEFAULT) -> list[Q.Check]:
    """What must hold after a refresh."""
    codes = (*domain.codes.values(), domain.benchmark)
    levels = ("Province/territory", "National")
    substances = ("Opioids", "Stimulants")
    diseases = tuple(d for group in domain.disease_groups.values() for d in group)
    present = {
        "staging/admissions": ("prov_code", "fiscal_year"),
        "staging/population": ("prov_code", "ref_year", "population"),
        "staging/readmissions": ("prov_code", "fiscal_year"),
        "staging/incidence": ("prov_code", "fiscal_year", "age_standardized_rate"),
        "staging/harms": ("prov_code", "ref_year", "substance", "harm_type", "crude_rate_per_100k"),
        "staging/surveillance": ("disease", "ref_year", "prov_code", "rate_per_100k"),
        "enriched/linked_admissions": ("prov_code", "fiscal_year"),
        "enriched/admissions_change": ("prov_code", "fiscal_year", "age_standardized_rate"),
        "enriched/readmissions": ("prov_code", "fiscal_year"),
        "enriched/incidence": ("prov_code", "fiscal_year"),
        "enriched/harms": ("prov_code", "ref_year", "substance", "harm_type"),
        "enriched/surveillance": ("disease", "ref_year", "prov_code", "rate_per_100k"),
        "marts/focus_overview": ("prov_code", "fiscal_year"),
        "marts/entity_comparison": ("prov_code", "fiscal_year", "indicator_name"),
        "marts/trend_series": ("prov_code", "fiscal_year", "rate_value", "indicator_name"),
        "marts/harms_report": ("prov_code", "ref_year", "substance", "harm_type_label", "indicator_label", "crude_rate_per_100k"),
        "marts/surveillance_report": ("disease", "ref_year", "prov_code", "rate_per_100k", "outbreak_status_label", "disease_category"),
    }
    accepted = [
        ("staging/admissions", "prov_code", codes), ("staging/admissions", "reporting_level", levels),
        ("staging/readmissions", "prov_code", codes), ("staging/readmissions", "reporting_level", levels),
        ("staging/incidence", "prov_code", codes), ("staging/harms", "prov_code", codes),
        ("staging/harms", "substance", substances), ("staging/surveillance", "disease", diseases),
        ("marts/focus_overview", "prov_code", (domain.focus,)),
        ("marts/focus_overview", "acsc_trend_direction", ("Increasing", "Decreasing", "Stable")),
        ("marts/entity_comparison", "indicator_name", domain.indicators),
        ("marts/entity_comparison", "burden_category", ("High Burden", "Moderate Burden", "Low Burden")),
        ("marts/harms_report", "substance", substances), ("marts/surveillance_report", "disease", diseases),
        ("marts/surveillance_report", "outbreak_status_label", reports.STATUS_ORDER),
    ]
    focus = f"prov_code = '{domain.focus}'"
    return [
        *[Q.NotNull(table, column) for table, columns in present.items() for column in columns],
        *[Q.Accepted(table, column, tuple(values)) for table, column, values in accepted],
        Q.Unique("staging/population", ("prov_code", "ref_year")),
        Q.Unique("marts/focus_overview", ("fiscal_year",)),
        Q.InRange("marts/focus_overview", "acsc_rate", 150, 1000, focus),
        Q.InRange("marts/focus_overview", "mh_readmission_rate", 0, 100),
        Q.InRange("marts/harms_report", "crude_rate_per_100k", 0),
        Q.Present("marts/focus_overview"),
        Q.Present("marts/entity_comparison", focus),
        Q.Present("marts/trend_series", f"series_name = '{domain.focus_name}'"),
        Q.ExactlyOne("marts/focus_overview", "is_latest"),
    ]


def check(tables: Mapping[str, DataFrame], domain: Domain = DEFAULT) -> DataFrame:
    """One row per check with its failures."""
    return Q.run_checks(tables, standard_checks(domain))
