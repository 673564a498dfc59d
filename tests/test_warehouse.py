"""A whole refresh from small files in the published formats."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from panelkit.plans import warehouse
from panelkit.plans.domain import DEFAULT, ENTITY_CODES

YEARS = range(2018, 2024)
NAMES = list(ENTITY_CODES)


def rate(name, year, base):
    return base + 10 * NAMES.index(name) + 3 * (year - 2018) if name in ENTITY_CODES else base + 55 + 2 * (year - 2018)


def write_files(folder):
    rows = []
    for y in YEARS:
        for n in [*NAMES, "-"]:
            level = "National" if n == "-" else "Province/territory"
            v = "Suppressed" if (n, y) == ("Nunavut", 2020) else f"{rate(n, y, 1300) / 3:,.1f}"
            rows.append(f'"{n}",{level},{y}–{y + 1},ACSC,"{v}",{rate(n, y, 1300) / 3 - 20:.1f},{rate(n, y, 1300) / 3 + 20:.1f},"1,200",90000,5')
        rows.append(f"Some Region,Health region,{y}–{y + 1},ACSC,1,1,1,1,1,1")
    head = ("Province/Territory,Reporting level,Time frame,Indicator,Age-standardized rate,Confidence interval lower limit,"
            "Confidence interval upper limit,Numerator,Denominator,Crude rate")
    (folder / "admissions.csv").write_text("\n".join([head, *rows]) + "\n", encoding="utf-8")

    rows = []
    for y in YEARS:
        for n in [*NAMES, "N/A"]:
            level = "National" if n == "N/A" else "Province/territory"
            v = rate(n, y, 80) / 10
            for kind in ("Not applicable", "Sex"):
                rows.append(f"{n},{level},{kind},{y}–{y + 1},30-day,{v:.1f},{v - 1:.1f},{v + 1:.1f},{3 if n == 'Yukon' else 50},900,{v:.1f}")
    head = ("Province/Territory,Reporting level,Level 1 breakdown,Time frame,Indicator,Risk-adjusted rate,"
            "Risk-adjusted rate: confidence interval lower limit,Risk-adjusted rate: confidence interval upper limit,Numerator,Denominator,Crude rate")
    (folder / "readmissions.csv").write_text('"Table 1 Readmission, all"\n' + "\n".join([head, *rows]) + "\n", encoding="utf-8")

    rows = []
    for y in YEARS:
        star = "*" if y == 2020 else ""
        for n in [*NAMES, "Canada"]:
            v = rate(n, y, 600)
            rows += [f"{n},{sex},Total,{y}{y + 1}{star},{v},{v - 5},{v + 5},2.5,400,90000" for sex in ("Both sexes", "Males")]
    rows.append("Note: counts below ten are suppressed\xa0.,,,,,,,,,")
    head = "Geography,Sex,Age group\xa0type,Fiscal year,\"Rate per 100,000\",Lower 95% CI,Upper 95% CI,Standard error,Case counts,Population"
    (folder / "incidence.csv").write_bytes(("Incidence\n" + "\n".join([head, *rows]) + "\n").encode("latin-1"))

    rows = []
    for substance in ("Opioids", "Stimulants"):
        for source in ("Deaths", "Hospitalizations"):
            for y in range(2016, 2026):
                year = "2025 (Jan to Sep)" if y == 2025 else str(y)
                for n in [*NAMES, "Canada", "Winnipeg, Manitoba"]:
                    v = "Suppr." if n == "Nunavut" else f"{rate(n, y, 10) / 4:.2f}"
                    rows += [f'{substance},{source},Overall numbers,{unit},By year,"{n}",{year},{v}' for unit in ("Crude rate", "Number")]
    (folder / "harms.csv").write_text("\n".join(["Substance,Source,Specific measure,Unit,Time period,Region,Year Quarter,Value", *rows]) + "\n")

    rows = [f"{y},{n},{g},{a},{(NAMES.index(n) + 1) * 100000 if n in ENTITY_CODES else 30000000}" for y in range(1998, 2024) for n in [*NAMES, "Canada"]
            for g in ("Total - gender", "Men+") for a in ("All ages", "0 to 4 years")]
    (folder / "population.csv").write_text("\n".join(["REF_DATE,GEO,Gender,Age group,VALUE", *rows]) + "\n")

    rows = [f'"{y}","{d}","All","{s}",{1000 + 37 * (y % 7) + 10 * i},1.0' for y in range(1996, 2024)
            for i, d in enumerate(("Chlamydia", "Giardiasis", "Syphilis")) for s in ("Male", "Female")]
    (folder / "national_cases.csv").write_text(
        "\n".join(['"Year","Disease","Age group","Sex","Number of reported cases","Rate per 100,000"', *rows]) + "\n")
    rows = [f"Chlamydia,{y},{n},{c},{'' if c == 'NT' else 4 if c == 'PE' else 500},{20 + 3 * i},Report" for y in (2019, 2021, 2023)
            for i, (n, c) in enumerate(ENTITY_CODES.items())] + ["Chlamydia,2019,Canada,CA,99,99.0,Report"] * 2
    (folder / "snapshots.csv").write_text("\n".join(["Disease,Year,Region,Prov_Code,Cases,Rate_per_100k,Source_Report", *rows]) + "\n")


@pytest.fixture(scope="module")
def refreshed(spark, tmp_path_factory):
    folder, out = tmp_path_factory.mktemp("raw"), str(tmp_path_factory.mktemp("out"))
    write_files(folder)
    loaded = warehouse.load(spark, {n: f"{folder}/{n}.csv" for n in warehouse.SOURCES}, out)
    return loaded, warehouse.run(spark, out)


def test_loaded_rows(refreshed):
    loaded, tables = refreshed
    assert loaded["admissions"] == 6 * 15 and loaded["readmissions"] == 6 * 14 * 2 and loaded["incidence"] == 6 * 28 + 1
    assert loaded["population"] == 26 * 14 and loaded["snapshots"] == 41
    assert sum(1 for t in tables if t.startswith("staging/")) == 6
    assert sum(1 for t in tables if t.startswith("enriched/")) == 6
    assert sum(1 for t in tables if t.startswith("marts/")) == 5


def test_all_78_checks(refreshed):
    # The comparison with the focus entity counts as one check over three tables.
    checks = warehouse.standard_checks()
    # One more than published: that no entity and year has two populations.
    assert len(checks) == 57 + 15 + 1 + 5 + 2 + 1
    failed = {r["check"]: r["failures"] for r in warehouse.check(refreshed[1]).collect() if r["failures"]}
    assert failed == {}


def test_checks_while_writing(spark, refreshed, tmp_path):
    """The same results as by reading every table again, and the failures of a rule that does not hold."""
    import shutil

    source = next(iter(refreshed[1].values())).inputFiles()[0].removeprefix("file://").split("/staging/")[0]
    shutil.copytree(f"{source}/raw", tmp_path / "raw")
    failures = {}
    tables = warehouse.run(spark, str(tmp_path), failures=failures)
    again = {r["check"]: 0 for r in warehouse.check(tables).collect()}
    assert failures == again and len(failures) >= 79


def test_overview(refreshed):
    rows = refreshed[1]["marts/focus_overview"].orderBy("fiscal_year").collect()
    assert [r.fiscal_year for r in rows] == list(YEARS)
    assert [r.is_latest for r in rows] == [False] * 5 + [True]
    last = rows[-1]
    assert last.prov_code == "YT" and last.population == 1_100_000 and last.cross_year_type_join_flag
    assert last.acsc_rate == pytest.approx(471.7) and last.acsc_national_rate == pytest.approx(455.0)
    assert last.acsc_gap_to_national == pytest.approx(16.7) and last.acsc_national_comparison == "Above National"
    assert last.acsc_trend_direction == "Increasing" and last.acsc_national_rank == 3
    assert last.mh_is_suppressed and last.mh_national_comparison == "Significantly Above National"
    assert last.diabetes_incidence_rate == 715 and last.diabetes_gap_to_national == 50


def test_comparison_and_trends(refreshed):
    rows = refreshed[1]["marts/entity_comparison"]
    assert rows.count() == 6 * 13 * 3 - 1
    top = rows.where("indicator_name = 'Diabetes Incidence' and fiscal_year = 2020").orderBy("national_rank").collect()
    assert (top[0].prov_code, top[0].outcome_rank, top[0].burden_category, top[0].region_group) == ("NU", 13, "High Burden", "Territories")
    assert top[-1].burden_category == "Low Burden" and {r.is_territory for r in top[:3]} == {True}
    names = {(r.indicator_name, r.series_name) for r in refreshed[1]["marts/trend_series"].select("indicator_name", "series_name").distinct().collect()}
    assert ("ACSC Hospitalizations", "Canada (National)") in names and ("Diabetes Incidence", "Canada (National)") not in names


def test_harms(refreshed):
    rows = refreshed[1]["marts/harms_report"]
    assert rows.where("prov_code in ('NU', 'CA') or ref_year = 2025").count() == 0
    r = rows.where("prov_code = 'YT' and substance = 'Opioids' and harm_type = 'Deaths' and ref_year = 2024").first()
    assert r.indicator_label == "Opioids — Apparent Toxicity Deaths" and r.emergency_period_label == "Post-Emergency"
    assert r.benchmark_ratio == pytest.approx(round(128 / 77, 2)) and r.severity_vs_national == "Severely Elevated"
    assert r.data_points == 9 and r.statscan_population is None


def test_surveillance(refreshed):
    rows = refreshed[1]["marts/surveillance_report"]
    assert {r.disease for r in rows.select("disease").distinct().collect()} == {"Chlamydia", "Giardiasis", "Infectious Syphilis"}
    assert rows.where("prov_code = 'PE'").count() == 0 and rows.where("prov_code = 'NT'").count() == 3
    national = rows.where("prov_code = 'CA' and disease = 'Chlamydia'").orderBy("ref_year").collect()
    assert [r.ref_year for r in national] == list(range(2000, 2024)) and not any(r.is_outbreak_signal for r in national)
    assert national[0].rate_per_100k == pytest.approx(round(2 * (1000 + 37 * (2000 % 7)) / 30000000 * 100000, 2))
    member = rows.where("prov_code = 'YT' and ref_year = 2021").first()
    assert member.yoy_change is None and member.trend_direction == "Stable" and member.disease_rank_by_rate == 3
    assert member.severity_vs_national == "Extreme" and member.peak_year == 2019


def test_report(refreshed):
    out = warehouse.report(refreshed[1])
    status = {r.domain: r for r in out["status"].collect()}
    assert set(status) == {*DEFAULT.indicators, "Substance Use (Opioid Deaths)", "Communicable Disease"}
    assert status["ACSC Hospitalizations"].rank_text == "#3/13" and status["ACSC Hospitalizations"].status == "Monitor"
    assert status["Mental Health Readmissions"].light == "red"
    counts = out["status_counts"].first()
    assert counts.red_count + counts.yellow_count + counts.green_count == 5
    ahead = out["forecast"].where("prov_code = 'YT' and indicator_name = 'Diabetes Incidence'").orderBy("step").collect()
    assert [r.yhat for r in ahead] == pytest.approx([718, 721, 724], abs=0.01)
    assert out["findings"].where(F.col("direction") == "increasing").count() == 3


def test_missing_source_gives_empty_tables(spark, tmp_path):
    assert warehouse.scan(spark, "harms", str(tmp_path / "none.csv")).count() == 0


def test_missing_file_keeps_the_earlier_table(spark, tmp_path):
    csv, out = tmp_path / "population.csv", str(tmp_path / "out")
    csv.write_text("GEO,REF_DATE,VALUE\nManitoba,2020,5\n")
    assert warehouse.load(spark, {"population": str(csv)}, out) == {"population": 1}
    assert warehouse.load(spark, {"population": str(tmp_path / "none.csv")}, out) == {"population": None}
    assert spark.read.parquet(f"{out}/raw/population").count() == 1
    assert warehouse.load(spark, {"harms": str(tmp_path / "none.csv")}, out) == {"harms": 0}


def test_population_keys_are_checked_for_copies():
    assert warehouse.Q.Unique("staging/population", ("prov_code", "ref_year")) in warehouse.standard_checks()
