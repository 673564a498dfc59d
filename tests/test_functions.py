from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.functions import classify as C
from panelkit.functions import numeric as N
from panelkit.functions import text as X


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {t(v)}" for k, v in values.items())) if values else spark.range(1)
    return df.select(expr.alias("x")).first()["x"]


def t(v):
    return {str: "string", int: "bigint", float: "double", bool: "boolean", type(None): "double"}[type(v)]


@pytest.mark.parametrize("text, number", [
    ("-", None), ("–", None), ("Suppr.", None), ("", None), ("N/A", None), (" 1,234 ", 1234.0), (" 12.5", 12.5),
    ("abc", None), ("1e3", 1000.0), ("1d", None), ("NaN", None), ("-7", -7.0),
])
def test_parse_number(spark, text, number):
    assert one(spark, X.parse_number("s"), s=text) == number


def test_parse_number_of_null_and_unparsed(spark):
    df = spark.createDataFrame([(None,), ("abc",), ("-",), ("5",)], "s string")
    got = df.select("s", X.parse_number("s").alias("v"), X.is_unparsed("s").alias("bad")).collect()
    assert [(r.s, r.v, r.bad) for r in got] == [(None, None, False), ("abc", None, True), ("-", None, False), ("5", 5.0, False)]


@pytest.mark.parametrize("text, year", [("2022–2023", 2022), ("20202021*", 2020), ("n/a", None), ("2025 (Jan to Sep)", 2025)])
def test_parse_period(spark, text, year):
    assert one(spark, X.parse_period("s"), s=text) == year


def test_partial_period(spark):
    assert one(spark, X.partial_period_flag("s"), s="2025 (Jan to Sep)") is True
    assert one(spark, X.partial_period_flag("s"), s="2025") is False
    df = spark.createDataFrame([(None,)], "s string")
    assert df.select(X.partial_period_flag("s")).first()[0] is False


def test_fold_accents(spark):
    assert one(spark, X.fold_accents("s"), s="Québec Île é Åland") == "Quebec Ile e Aland"


@pytest.mark.parametrize("value, digits, signed, text", [
    (1.25, 1, False, "1.3"), (-0.04, 1, True, "-0.0"), (12.0, 0, True, "+12"), (-3.46, 1, True, "-3.5"), (None, 1, True, "N/A"),
    (1e29, 0, False, "1" + "0" * 29), (1.00499999999999, 2, False, "1.00"), (float("nan"), 0, False, "N/A")])
def test_show_number(spark, value, digits, signed, text):
    assert one(spark, X.show_number("v", digits, signed), v=value) == text


@pytest.mark.parametrize("value, digits, result", [(1.005, 2, 1.01), (-2.5, 0, -3.0), (2.675, 2, 2.68), (None, 1, None),
    (1.00499999999999, 2, 1.0), (1e29, 2, 1e29), (1e300, 0, 1e300), (-0.005, 2, -0.01), (float("nan"), 1, None), (0.1 + 0.2, 15, 0.3)])
def test_round_half_up(spark, value, digits, result):
    assert one(spark, N.round_half_up("v", digits), v=value) == result


@pytest.mark.parametrize("v, prev, guard, pct", [
    (5.0, 0.0, "positive", None), (5.0, 0.0, "nonzero", None), (5.0, -10.0, "positive", None), (5.0, -10.0, "nonzero", -150.0),
    (11.0, 10.0, "positive", 10.0), (None, 10.0, "positive", None)])
def test_pct_change(spark, v, prev, guard, pct):
    got = one(spark, N.pct_change("v", "p", 4, guard), v=v, p=prev)
    assert got == pct


def test_rate_and_suppression(spark):
    assert one(spark, N.rate_per("n", "p"), n=3.0, p=200.0) == 1500.0
    assert one(spark, N.rate_per("n", "p"), n=3.0, p=0.0) is None
    assert one(spark, N.suppress_small_cells("r", "n", 5), r=1.0, n=4.0) is True
    assert one(spark, N.suppress_small_cells("r", "n", 5), r=1.0, n=None) is False
    assert one(spark, N.suppress_small_cells("r", "n", 5), r=None, n=50.0) is True


def test_gap_and_ratio(spark):
    assert one(spark, N.gap_to_benchmark("v", "b"), v=5.0, b=None) is None
    assert one(spark, N.gap_to_benchmark("v", "b", 1, "zero"), v=5.0, b=None) == 5.0
    assert one(spark, N.ratio_to_benchmark("v", "b"), v=5.0, b=0.0) is None
    with pytest.raises(ValueError):
        N.gap_to_benchmark(F.lit(1), F.lit(1), missing="other")


def tail(stat, dof):
    """The two-sided tail by numerical integration of the density."""
    x = np.linspace(-stat, stat, 200_001)
    scale = math.exp(math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2)) / math.sqrt(dof * math.pi)
    return 1 - np.trapezoid(scale * (1 + x * x / dof) ** (-(dof + 1) / 2), x)


@pytest.mark.parametrize("dof", [1, 2, 3, 4, 5, 6, 11, 40, 301, 400, 401, 5000, 1_000_000])
def test_t_distribution(spark, dof):
    for stat in (0.0, 0.3, 2.0, 6.5):
        assert one(spark, N.two_sided_p("s", "d"), s=stat, d=dof) == pytest.approx(tail(stat, dof), abs=1e-8)
    point = one(spark, N.t_quantile(0.95, F.col("d")), d=dof)
    assert tail(point, dof) == pytest.approx(0.05, abs=1e-6)


def test_t_of_few_and_of_very_many_degrees(spark):
    assert one(spark, N.t_quantile(0.9999, F.col("d")), d=1) == pytest.approx(6366.1977, abs=1e-3)
    assert one(spark, N.t_quantile(0.95, F.col("d")), d=3_000_000_000) == pytest.approx(1.959964, abs=1e-6)
    # The normal tail: 2 * (1 - Phi(4)) and 2 * (1 - Phi(8)).
    for z, p in ((4.0, 6.334248366623996e-05), (8.0, 1.2441921148543572e-15), (0.0, 1.0)):
        assert one(spark, N.normal_tail(F.col("z")), z=z) == pytest.approx(p, rel=1e-9)


def test_fold_accents_of_all_scripts(spark):
    assert one(spark, X.fold_accents("s"), s="Hà Nội Ệ Ǻ Ёж e\u0301") == "Ha Noi E A Еж e"


def test_ci_comparison_order_and_unknown(spark):
    df = spark.createDataFrame(
        [(12.0, 9.0, 11.0, 10.0), (10.5, 9.0, 11.0, 10.0), (8.0, 9.0, 11.0, 10.0), (9.5, 9.0, 11.0, 10.0), (10.0, 9.0, 11.0, 10.0),
         (10.0, None, None, None), (None, 9.0, 11.0, 10.0)], "v double, lo double, hi double, b double")
    got = [r[0] for r in df.select(C.ci_comparison("v", "lo", "hi", "b")).collect()]
    assert got == ["Significantly Above National", "Above National", "Significantly Below National", "Below National",
                   "At National Rate", "At National Rate", "At National Rate"]
    assert [r[0] for r in df.select(C.ci_comparison("v", "lo", "hi", "b", None)).collect()][-2:] == [None, None]


@pytest.mark.parametrize("ratio, four, five", [
    (5.0, "Crisis Level", "Extreme"), (2.0, "Crisis Level", "Crisis Level"), (1.5, "Severely Elevated", "Severely Elevated"),
    (1.0, "Above National", "Above National"), (0.99, "Below National", "Below National"), (None, None, None)])
def test_severity(spark, ratio, four, five):
    assert one(spark, C.severity_band("r"), r=ratio) == four
    assert one(spark, C.severity_band("r", 5), r=ratio) == five


def test_other_labels(spark):
    assert one(spark, C.trend_direction("d"), d=None) == "Stable"
    assert one(spark, C.trend_direction("d", None), d=None) is None
    assert [one(spark, C.burden_category("k"), k=k) for k in (3, 4, 11)] == ["High Burden", "Moderate Burden", "Low Burden"]
    assert one(spark, C.outcome_rank("k", 13), k=1) == 13
    assert [one(spark, C.event_period("y"), y=y) for y in (2018, 2019, 2021, 2022)] == [
        "Baseline", "Pre-Emergency", "Pre-Emergency", "Post-Emergency"]
    assert [one(spark, C.outbreak_status("s", "z"), s=s, z=z) for s, z in ((True, 3.0), (True, 2.5), (False, 1.0), (False, None))] == [
        "Severe Outbreak", "Outbreak Detected", "Elevated", "Normal Range"]
    assert [one(spark, C.traffic_light("c"), c=c) for c in ("Significantly Above National", "Crisis Level", "Above National",
            "Severely Elevated", "Below National")] == ["red", "red", "yellow", "yellow", "green"]
    df = spark.createDataFrame([(None,)], "c string")
    assert df.select(C.traffic_light("c")).first()[0] == "green"
    assert [one(spark, C.gap_narrative("g"), g=g) for g in (100.5, 100.0, 0.0)] == ["substantially above", "above", "at or below"]


def test_central_z_is_bounded(spark):
    """The bound that keeps the central alarm from firing with width 5 and k 2."""
    from panelkit.operators import alarm
    from panelkit.spec import PanelSpec

    p = PanelSpec("e", "t", "v")
    df = spark.range(20000).select((F.col("id") % 40).alias("e"), F.col("id").alias("t"), F.exp(F.randn(7) * 3).alias("v"))
    z = df.select(alarm.outbreak_zscore(p, digits=9).alias("z")).agg(F.max("z")).first()[0]
    assert z <= 2 + 1e-9 and math.isclose(z, 2.0, abs_tol=1e-3)
