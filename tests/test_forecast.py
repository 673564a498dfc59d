from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelkit.operators import forecast as O
from panelkit.operators import smoothing as S
from panelkit.operators.regression import ols_coefficients
from panelkit.spec import PanelSpec

p = PanelSpec("e", "t", "v")


def frame(spark, **series):
    rows = [(e, 2000 + i, None if v is None else float(v)) for e, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "e string, t int, v double")


MODELS = {"linear": O.forecast_linear, "arima": O.forecast_arima110, "ets": O.forecast_ets, "auto": O.forecast_auto}


@pytest.mark.parametrize("name", MODELS)
def test_straight_line_continues(spark, name):
    got = MODELS[name](frame(spark, a=[2 * t + 1 for t in range(8)]), p).orderBy("step").collect()
    assert [r.period for r in got] == [2008, 2009, 2010]
    assert [r.yhat for r in got] == pytest.approx([17, 19, 21], abs=1e-3)
    assert all(r.success for r in got)


@pytest.mark.parametrize("name", MODELS)
def test_short_series_fails_without_forecast(spark, name):
    got = MODELS[name](frame(spark, a=[1, 2, 3], b=[1, None, 2, 3], c=[float("nan"), 1, 2, 3]), p).collect()
    assert {(r.e, r.success, r.yhat) for r in got} == {("a", False, None), ("b", False, None), ("c", False, None)}


@pytest.mark.parametrize("name", MODELS)
def test_intervals_nest_and_grow(spark, name):
    got = MODELS[name](frame(spark, a=[3, 8, 5, 9, 4, 11, 7, 12]), p).orderBy("step").collect()
    assert all(r.lo95 < r.lo80 < r.yhat < r.hi80 < r.hi95 for r in got)
    widths = [r.hi95 - r.lo95 for r in got]
    assert widths == sorted(widths)


def test_linear_equals_numpy(spark):
    y = np.array([3.0, 8, 5, 9, 4, 11])
    x = np.arange(2000, 2006, dtype=float)
    slope, level = np.polyfit(x - 2000, y, 1)
    sigma = np.std(y - (slope * (x - 2000) + level), ddof=2)
    got = O.forecast_linear(frame(spark, a=y), p).orderBy("step").collect()
    for k, r in enumerate(got, 1):
        yhat = slope * (5 + k) + level
        assert r.yhat == pytest.approx(yhat) and r.hi95 == pytest.approx(yhat + 1.96 * sigma * np.sqrt(1 + k / 6))


def test_arima_both_ways(spark):
    y = np.array([3.0, 8, 5, 9, 4, 11, 6])
    got = O.forecast_arima110(frame(spark, a=y), p, h=4).orderBy("step").collect()
    yhat, spread = O.arima_steps(y, 4)
    assert [r.yhat for r in got] == pytest.approx(list(yhat))
    assert [(r.hi95 - r.yhat) / 1.96 for r in got] == pytest.approx(list(spread))


def test_best_smooth_beats_any_pair():
    rng = np.random.default_rng(1)
    y = np.cumsum(rng.normal(1, 2, 20))
    best = O.best_smooth(y, trend=True)
    alpha, beta = rng.uniform(0, 1, 400), rng.uniform(0, 1, 400)
    assert best["sse"] <= O.smooth(y, alpha, beta)[0].min() + 1e-6


def test_smooth_follows_the_recursion():
    y, a, b = np.array([3.0, 8, 5, 9, 4]), 0.4, 0.3
    sse, fitted, level, slope = O.smooth(y, np.array([a]), np.array([b]))
    resid = O.residuals(y, a, b, fitted[0])
    # Recover the start from the first two errors, then run the textbook recursion.
    design = []
    for start in ((0.0, 0.0), (1.0, 0.0), (0.0, 1.0)):
        l, s, errs = *start, []
        for v in (y if start == (0.0, 0.0) else 0 * y):
            errs.append(v - l - s)
            new = a * v + (1 - a) * (l + s)
            s = b * (new - l) + (1 - b) * s
            l = new
        design.append(errs)
    base, d1, d2 = map(np.array, design)
    start, *_ = np.linalg.lstsq(-np.column_stack([d1, d2]), base, rcond=None)
    assert resid == pytest.approx(base + d1 * start[0] + d2 * start[1], abs=1e-6)
    assert sse[0] == pytest.approx(resid @ resid, abs=1e-6)


def test_chain_falls_back(monkeypatch):
    def broken(*_):
        raise ArithmeticError

    t, y = np.arange(6.0), np.array([1.0, 3, 2, 5, 4, 6])
    assert O.forecast_one(t, y, 3, "chain")[0] == O.ETS_NAME
    monkeypatch.setattr(O, "ets_steps", broken)
    assert O.forecast_one(t, y, 3, "chain")[0] == O.ARIMA_NAME
    monkeypatch.setattr(O, "arima_steps", broken)
    assert O.forecast_one(t, y, 3, "chain")[0] == O.LINEAR_NAME
    monkeypatch.setattr(O, "linear_steps", broken)
    assert O.forecast_one(t, y, 3, "chain") is None


def test_aicc_prefers_the_right_model(spark):
    rng = np.random.default_rng(5)
    flat, steep = 50 + rng.normal(0, 1, 30), 5 * np.arange(30) + rng.normal(0, 1, 30)
    got = {r.e: r.model for r in O.forecast_auto(frame(spark, flat=flat, steep=steep), p, choose="aicc").collect()}
    assert got == {"flat": "ETS(A,N,N)", "steep": "ETS(A,A,N)"}
    with pytest.raises(ValueError):
        O.forecast_auto(frame(spark, a=[1, 2, 3, 4]), p, choose="best")


def test_several_rows_per_period_are_averaged(spark):
    df = frame(spark, a=[1, 2, 3, 4, 5]).unionByName(frame(spark, a=[3, 4, 5, 6, 7]))
    got = O.forecast_ets(df, p).orderBy("step").collect()
    assert [r.yhat for r in got] == pytest.approx([7, 8, 9], abs=1e-3)


def test_trend_test(spark):
    got = O.trend_test(frame(spark, a=[1, 2.5, 2, 4, 5.5, 5, 7.5]), p).orderBy("step").first()
    assert got.direction == "increasing" and got.slope == pytest.approx(1.0, abs=0.05)
    assert got.p_value < 0.001 and got.lo95 < got.yhat < got.hi95


def test_compare_and_history(spark):
    df = frame(spark, a=[3, 8, 5, 9, 4, 11, 7, 12, 8], b=range(9))
    got = O.forecast_compare(df, p).collect()
    assert len(got) == 6 and all(r.ets_lo95 <= r.ets_lo80 for r in got)
    both = O.bind_history(df, O.forecast_linear(df, p), p)
    assert {(r.type, r["count"]) for r in both.groupBy("type").count().collect()} == {("Historical", 18), ("Forecast", 6)}


def test_ols_equals_numpy(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"a": rng.normal(size=60), "b": rng.normal(size=60)})
    pdf["y"] = 3 + 2 * pdf["a"] - pdf["b"] + rng.normal(size=60)
    got = ols_coefficients(spark.createDataFrame(pdf), "y", ["a", "b"]).toPandas().set_index("term")
    x = np.column_stack([pdf["a"], pdf["b"], np.ones(60)])
    beta, rss, *_ = np.linalg.lstsq(x, pdf["y"], rcond=None)
    se = np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * rss[0] / 57)
    assert list(got.loc[["a", "b", "(Intercept)"], "estimate"]) == pytest.approx(list(beta))
    assert list(got.loc[["a", "b", "(Intercept)"], "std_error"]) == pytest.approx(list(se))
    assert (got["conf_low"] < got["estimate"]).all()
    assert ols_coefficients(spark.createDataFrame(pdf.head(10)), "y", ["a", "b"]).count() == 0


def test_group_is_one_row_per_period(spark):
    plan = O.forecast_ets(frame(spark, a=[1, 2, 3, 4]), p)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" in plan and "HashAggregate" in plan
    assert F is not None


def test_memory_of_smoothing_does_not_grow_with_the_series():
    import tracemalloc

    y = np.cumsum(np.random.default_rng(0).normal(0.1, 1, 4000))
    peaks = []
    for n in (400, 4000):
        tracemalloc.start()
        O.smooth(y[:n], np.full(441, 0.3), np.full(441, 0.1))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.5 * peaks[0]


def test_too_short_series_name_no_model(spark):
    p = PanelSpec("e", "t", "v")
    short = spark.createDataFrame([("a", i, float(i)) for i in range(3)], "e string, t int, v double")
    for fn in (O.forecast_linear, O.forecast_arima110, O.forecast_auto):
        assert [(r.model, r.success, r.yhat) for r in fn(short, p).collect()] == [("None", False, None)]


def test_autoregression_merges_copies_of_a_period(spark):
    p = PanelSpec("e", "t", "v")
    data = [("a", i, v) for i, v in enumerate([1.0, 3.0, 2.0, 5.0, 4.0, 7.0])]
    plain = O.forecast_arima110(spark.createDataFrame(data, "e string, t int, v double"), p).collect()
    doubled = O.forecast_arima110(spark.createDataFrame([*data, ("a", 3, 4.0), ("a", 3, 6.0)], "e string, t int, v double"), p).collect()
    assert plain == doubled


def test_exact_likelihood_is_highest(spark):
    """No coefficient of a fine grid is likelier than the one of the cubic, and the spread is that of the likelihood."""
    rng = np.random.default_rng(8)
    series = {f"s{i}": np.cumsum(rng.normal(0, 1, 4 + i % 9)) for i in range(30)} | {"line": np.arange(8.0) * 2, "flat": np.ones(6), "zigzag": [0, 1, 0, 1, 0, 1, 0.0]}
    got = {r.e: r for r in O.forecast_arima110(frame(spark, **series), p, h=2).where("step = 1").collect()}
    grid = np.linspace(-0.99999, 0.99999, 200_001)
    for e, y in series.items():
        d = np.diff(np.asarray(y, float))
        m, total, cross, inside = len(d), d @ d, d[1:] @ d[:-1], d[1:-1] @ d[1:-1]
        if not total:
            assert got[e].yhat == y[-1]
            continue
        with np.errstate(divide="ignore"):
            gain = -m / 2 * np.log(np.maximum(total - 2 * grid * cross + grid ** 2 * inside, 1e-300) / m) + np.log(1 - grid ** 2) / 2
        phi = grid[np.argmax(gain)]
        assert got[e].yhat == pytest.approx(y[-1] + d[-1] * phi, abs=1e-4 * max(1, abs(d[-1])))
        yhat, spread = O.arima_steps(np.asarray(y, float), 2)
        assert got[e].yhat == pytest.approx(yhat[0], abs=1e-7) and (got[e].hi95 - got[e].yhat) / 1.96 == pytest.approx(spread[0], abs=1e-6)


def test_least_squares_stays_an_option(spark):
    y = np.array([3.0, 8, 5, 9, 4, 11, 6])
    d = np.diff(y)
    got = O.forecast_arima110(frame(spark, a=y), p, h=1, method="least_squares").first()
    assert got.yhat == pytest.approx(y[-1] + d[-1] * (d[1:] @ d[:-1]) / (d[:-1] @ d[:-1]))
    with pytest.raises(ValueError):
        O.forecast_arima110(frame(spark, a=y), p, method="moments")


def test_aliased_regressors(spark):
    """A constant, a copy, a sum and a scaled copy have empty rows; the others are those of a fit without them."""
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.normal(size=50), "b": rng.normal(size=50) * 1e6})
    pdf["y"] = 1 + pdf["a"] - 2e-6 * pdf["b"] + rng.normal(size=50)
    pdf = pdf.assign(one=3.3, copy=pdf["a"], total=pdf["a"] + 1e-6 * pdf["b"], scaled=pdf["b"] * 7 + 5)
    df = spark.createDataFrame(pdf)
    plain = ols_coefficients(df, "y", ["a", "b"]).toPandas().set_index("term")
    got = ols_coefficients(df, "y", ["one", "a", "copy", "b", "total", "scaled"]).toPandas().set_index("term")
    for term in ("one", "copy", "total", "scaled"):
        assert got.loc[term, ["estimate", "std_error", "statistic", "p_value", "conf_low", "conf_high"]].isna().all()
    for term in ("a", "b", "(Intercept)"):
        assert got.loc[term].tolist() == pytest.approx(plain.loc[term].tolist(), rel=1e-8)
    assert set(got["dof"]) == {47}


def test_regression_by_group(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"g": [f"g{i % 5}" if i % 5 else None for i in range(200)], "x": rng.normal(size=200), "y": rng.normal(size=200)})
    pdf.loc[pdf["g"] == "g1", "x"] = 2.0
    got = ols_coefficients(spark.createDataFrame(pdf), "y", ["x"], by=["g"]).collect()
    assert len(got) == 10
    for g in (None, "g2", "g3", "g4"):
        some = pdf[pdf["g"].isna() if g is None else pdf["g"] == g]
        slope, base = np.polyfit(some["x"], some["y"], 1)
        assert {r.term: r.estimate for r in got if r.g == g} == pytest.approx({"x": slope, "(Intercept)": base})
    assert {r.term: r.estimate is None for r in got if r.g == "g1"} == {"x": True, "(Intercept)": False}
    assert ols_coefficients(spark.createDataFrame(pdf), "y", ["x"], by=["g"], min_rows=41).count() == 0


def test_perfect_fit_and_no_degrees_of_freedom(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(12)], "x double, y double")
    got = {r.term: r for r in ols_coefficients(df, "y", ["x"]).collect()}
    assert got["x"].estimate == pytest.approx(2) and got["(Intercept)"].estimate == pytest.approx(1)
    two = {r.term: r for r in ols_coefficients(df.limit(2), "y", ["x"], min_rows=2).collect()}
    assert two["x"].estimate == pytest.approx(2) and two["x"].std_error is None and two["x"].p_value is None and two["x"].dof == 0


def test_batches_give_the_single_answers():
    """Series fitted together have the numbers they have alone."""
    rng = np.random.default_rng(6)
    y = np.cumsum(rng.normal(1, 2, (30, 9)), axis=1) + 50
    for trend in (False, True):
        many = S.best_smooth_many(y, trend)
        for i in range(30):
            one = O.best_smooth(y[i], trend)
            assert all(np.allclose(many[k][i], one[k], rtol=1e-9, atol=1e-9) for k in ("alpha", "beta", "sse", "level", "slope"))
    yhat, spread, number, score = S.choose_model(y, 3)
    for i in (0, 7, 29):
        alone = S.choose_model(y[i:i + 1], 3)
        assert np.allclose(yhat[i], alone[0][0]) and np.allclose(spread[i], alone[1][0]) and number[i] == alone[2][0]


def plain_gain(y, relative, trend, alpha, share, phi, level, slope):
    """-2 log likelihood but for a constant, point by point as in the textbook."""
    beta = alpha * share if trend != "none" else 0.0
    phi = phi if trend == "damped" else 1.0
    slope = slope if trend != "none" else 0.0
    total = logs = 0.0
    for value in y:
        mean = level + phi * slope
        if relative and mean <= 0:
            return np.inf
        error = (value - mean) / mean if relative else value - mean
        if relative:
            level, slope = mean * (1 + alpha * error), phi * slope + beta * mean * error
            logs += 2 * np.log(mean)
        else:
            level, slope = mean + alpha * error, phi * slope + beta * error
        total += error * error
    return len(y) * np.log(total) + logs


def plain_best(y, relative, trend, rng):
    """The best of many random points, each improved by ever smaller random steps."""
    best, at = np.inf, None
    low, high = np.array([1e-4, 1e-4, 0.8, y.min() - 2 * y.std(), -2 * y.std()]), np.array([0.9999, 0.9999, 0.98, y.max() + 2 * y.std(), 2 * y.std()])
    for _ in range(6):
        x = rng.uniform(low, high)
        x[3], x[4] = y[0], (y[-1] - y[0]) / len(y) * rng.integers(0, 2)
        value, size = plain_gain(y, relative, trend, *x), 0.4
        for k in range(700):
            if k % 70 == 69:
                size /= 2.5
            step = np.clip(x + rng.normal(0, size, 5) * (high - low) * (rng.random(5) < 0.5), low, high)
            found = plain_gain(y, relative, trend, *step)
            if found < value:
                x, value = step, found
        if value < best:
            best, at = value, x
    return best, at


def test_six_models_match_plain_search():
    """The likelihood of every model is at least that of a long random search, so the winner by corrected AIC is the plain one."""
    rng = np.random.default_rng(12)
    shapes = [lambda t: 100 + 0 * t, lambda t: 50 + 4 * t, lambda t: 20 * 1.1 ** t, lambda t: 80 + 30 * (1 - 0.8 ** t)]
    y = np.stack([shapes[i % 4](np.arange(14.0)) * (1 + rng.normal(0, 0.02 + 0.03 * (i % 3), 14)) for i in range(12)])
    t = y.shape[1]
    warm = {}
    for name, relative, trend, k in S.MODELS:
        fit = S._fit(y, relative, trend, warm[trend] if relative else None)
        if not relative:
            warm[trend] = fit
        for i in range(len(y)):
            share = fit["beta"][i] / fit["alpha"][i]
            own = plain_gain(y[i], relative, trend, fit["alpha"][i], share, fit["phi"][i], fit["level0"][i], fit["slope0"][i])
            assert own == pytest.approx(fit["gain"][i], abs=1e-6)
            assert fit["gain"][i] <= plain_best(y[i], relative, trend, rng)[0] + 0.05, (name, i)


def test_variances_by_class():
    """Simulated paths of both error kinds have the variances of the formulas."""
    rng = np.random.default_rng(5)
    for relative in (False, True):
        alpha, beta, phi, sigma, n = 0.4, 0.15, 0.9, 0.05 if relative else 2.0, 200_000
        level, slope = np.full(n, 100.0), np.full(n, 3.0)
        paths = []
        for _ in range(3):
            mean = level + phi * slope
            e = rng.normal(0, sigma, n) * (mean if relative else 1)
            paths.append(mean + e)
            level, slope = mean + alpha * e, phi * slope + beta * e
        mean = 100 + 3 * np.cumsum(0.9 ** np.arange(1, 4))
        got = S.variances(mean[None], np.array([sigma ** 2]), np.array([alpha]), np.array([beta]), np.array([phi]), relative)[0]
        assert np.allclose(got, np.var(paths, axis=1), rtol=0.02)
        assert np.allclose(np.mean(paths, axis=1), mean, rtol=0.01)


def test_six_models_in_spark(spark):
    rng = np.random.default_rng(7)
    growing = [100 * 1.2 ** i * (1 + rng.normal(0, 0.01)) for i in range(14)]
    df = frame(spark, flat=50 + rng.normal(0, 1, 14), steep=5 * np.arange(14) + rng.normal(0, 1, 14), growing=growing,
               short=[1, 2, 3], few=[1, 3, 2, 4], negative=-np.arange(14.0) + rng.normal(0, 1, 14))
    got = {}
    for r in O.forecast_auto(df, p, choose="models").collect():
        got.setdefault(r.e, []).append(r)
    assert {e: rows[0].model for e, rows in got.items() if e in ("flat", "short", "few")} == {"flat": got["flat"][0].model, "short": "None", "few": "None"}
    assert got["flat"][0].model in ("ETS(A,N,N)", "ETS(M,N,N)") and "A,N" in got["steep"][0].model and "M" not in got["negative"][0].model
    assert all(len(rows) == 3 and all(r.lo95 < r.lo80 < r.yhat < r.hi80 < r.hi95 for r in rows) for e, rows in got.items() if e not in ("short", "few"))


def test_very_many_series_in_one_run(spark):
    """One job fits 20,000 series in batches; a group without a name is a series of its own."""
    df = spark.range(20_000 * 6).select(
        F.when(F.col("id") % 20_000 > 0, (F.col("id") % 20_000).cast("string")).alias("e"), (2000 + F.floor(F.col("id") / 20_000)).cast("int").alias("t"),
        (F.xxhash64("id") % 1000 / 100 + 50).alias("v"))
    got = O.forecast_ets(df, p, h=1)
    assert got.where("success").count() == 20_000
    assert got.where("e is null").count() == 1
