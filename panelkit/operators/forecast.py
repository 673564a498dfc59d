"""Short-horizon forecasts and trend tests for every series of a panel.

The linear and ARIMA models are closed forms over aggregates, so Spark combines
them before it shuffles. Exponential smoothing needs an optimiser, which moves all
series of a group at once; a series there has one row per period.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions.numeric import bound, t_quantile, two_sided_p
from panelkit.operators.hotgroups import pieces_for
from panelkit.operators.smoothing import MODELS, best_smooth_many, choose_model, smooth_many, smoothing_steps
from panelkit.spec import PanelSpec

# Send the grouped-map functions below to the workers by value: executors then
# do not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Normal quantiles of the 95 and 80 percent intervals, model names.
Z95, Z80 = 1.96, 1.28
ETS_NAME = "Exponential Smoothing (additive trend)"
ARIMA_NAME = "ARIMA(1,1,0)"
LINEAR_NAME = "Linear extrapolation"
MIN_POINTS = 4
# Groups of series that are fitted together, for each piece of the input.
SERIES_GROUPS = 4

FORECAST_COLUMNS = ("step", "period", "yhat", "lo80", "hi80", "lo95", "hi95", "model", "success")


def _observed(df: DataFrame, p: PanelSpec) -> DataFrame:
    """Numeric period and value of the usable rows; NaN counts as missing."""
    v = F.col(p.value).cast("double")
    return df.select(*p.series, F.col(p.period).cast("double").alias("t"), F.when(~F.isnan(v), v).alias("v"))


def _steps(h: int, enough: Column, make) -> Column:
    """One struct per step, or a single empty one where a series is too short."""
    steps = F.array(*[F.struct(*make(k)) for k in range(1, h + 1)])
    return F.explode_outer(F.when(enough, steps))


def _bands(yhat: Column, spread: Column) -> list[Column]:
    return [
        yhat.alias("yhat"),
        (yhat - Z80 * spread).alias("lo80"), (yhat + Z80 * spread).alias("hi80"),
        (yhat - Z95 * spread).alias("lo95"), (yhat + Z95 * spread).alias("hi95"),
    ]


def linear_fit(df: DataFrame, p: PanelSpec) -> DataFrame:
    """Least-squares line per series: centre, slope and residual sum of squares."""
    both = F.col("v").isNotNull() & F.col("t").isNotNull()
    fit = _observed(df, p).groupBy(*p.series).agg(
        F.count_if(both).alias("n"),
        F.regr_avgx("v", "t").alias("mean_t"), F.regr_avgy("v", "t").alias("mean_v"),
        F.regr_sxx("v", "t").alias("sxx"), F.regr_syy("v", "t").alias("syy"), F.regr_sxy("v", "t").alias("sxy"),
        F.max(F.when(both, F.col("t"))).alias("last_t"),
    )
    slope = F.try_divide("sxy", "sxx")
    return fit.withColumn("slope", slope).withColumn(
        "sse", F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0)))


def forecast_linear(df: DataFrame, p: PanelSpec, h: int = 3, min_points: int = MIN_POINTS) -> DataFrame:
    """Straight-line forecast; the interval grows with sqrt(1 + step / n)."""
    fit = linear_fit(df, p)
    sigma = F.sqrt(F.try_divide(F.col("sse"), F.col("n") - 2))
    enough = F.col("n") >= min_points

    def step(k: int):
        at = F.col("last_t") + k
        yhat = F.col("mean_v") + F.col("slope") * (at - F.col("mean_t"))
        return [F.lit(k).alias("step"), at.cast("int").alias("period"), *_bands(yhat, sigma * F.sqrt(1 + k / F.col("n")))]

    return fit.select(*p.series, enough.alias("success"), _steps(h, enough, step).alias("_s")).select(
        *p.series, "_s.*", F.when(F.col("success"), LINEAR_NAME).otherwise("None").alias("model"), "success").select(*p.series, *FORECAST_COLUMNS)


def likeliest_phi(total: Column, cross: Column, inside: Column, m: Column) -> Column:
    """The coefficient of a stationary first-order autoregression without mean by exact likelihood.

    ``total`` and ``inside`` are the sums of squares of all ``m`` values and of those
    between the first and the last, ``cross`` the sum of products of neighbours. The
    slope of the likelihood is a cubic with one root in each of (-inf, -1), (-1, 1)
    and (1, inf); the middle one is wanted. Zero where all values are.
    """
    def at(s: Column) -> Column:
        m, b, c = s["m"], s["b"], s["c"]
        lead = (m - 1) * b

        def root(k: Column) -> Column:
            depth = F.sqrt(-k["p"] / 3)
            turn = F.greatest(F.least(-k["q"] / 2 / (depth * depth * depth), F.lit(1.0)), F.lit(-1.0))
            return k["shift"] + 2 * depth * F.cos((F.acos(turn) - 2 * F.pi()) / 3)

        second, first, none = -(m - 2) * c / lead, -(1 + m * b) / lead, m * c / lead
        middle = bound(F.struct((first - second * second / 3).alias("p"), (-second / 3).alias("shift"),
                                (2 * second * second * second / 27 - second * first / 3 + none).alias("q")), root)

        # Large outer roots cost digits of the middle one, which Newton steps bring back.
        def polish(x: Column) -> Column:
            slope = (3 * lead * x - 2 * (m - 2) * c) * x - (1 + m * b)
            return x - F.coalesce(F.try_divide(((lead * x - (m - 2) * c) * x - (1 + m * b)) * x + m * c, slope), F.lit(0.0))

        start = F.when(lead > 1e-9, middle).otherwise(m * c / (1 + m * b))
        return F.greatest(F.least(bound(bound(bound(start, polish), polish), polish), F.lit(1.0)), F.lit(-1.0))

    shares = F.struct(m.cast("double").alias("m"), (inside / total).alias("b"), (cross / total).alias("c"))
    return F.when(total > 0, bound(shares, at)).when(total == 0, 0.0)


def forecast_arima110(df: DataFrame, p: PanelSpec, h: int = 3, min_points: int = MIN_POINTS, method: str = "likelihood") -> DataFrame:
    """First-order autoregression of the first differences, without constant.

    Several values of a period count as their mean. The coefficient has the
    highest exact likelihood, or is the conditional least-squares estimate
    (``method="least_squares"``). The forecast
    adds the decaying sum of the last difference; its variance sums the
    squared partial sums of the coefficient's powers.
    """
    if method not in ("likelihood", "least_squares"):
        raise ValueError("method must be 'likelihood' or 'least_squares'")
    w = PanelSpec(p.entity, "t", "v", p.category).over_time()
    steps = _observed(df, p).where(F.col("t").isNotNull()).groupBy(*p.series, "t").agg(F.avg("v").alias("v")).where(F.col("v").isNotNull())
    steps = steps.withColumns({"d": F.col("v") - F.lag("v").over(w), "_next": F.lead("v").over(w)}).withColumn("d1", F.lag("d").over(w))
    paired, square = F.col("d1").isNotNull(), F.col("d") * F.col("d")
    fit = steps.groupBy(*p.series).agg(
        F.count(F.lit(1)).alias("n"), F.max("t").alias("last_t"),
        F.max_by("v", "t").alias("last_v"), F.max_by("d", "t").alias("last_d"),
        F.sum(F.col("d") * F.col("d1")).alias("cross"), F.sum(F.when(paired, F.col("d1") * F.col("d1"))).alias("past"),
        F.sum(F.when(paired, square)).alias("now"), F.count("d1").alias("pairs"),
        F.sum(square).alias("total"), F.coalesce(F.sum(F.when(paired & F.col("_next").isNotNull(), square)), F.lit(0.0)).alias("inside"),
    )
    cross = F.col("cross")
    if method == "likelihood":
        fit = fit.withColumn("phi", F.coalesce(likeliest_phi(F.col("total"), cross, F.col("inside"), F.col("n") - 1), F.lit(0.0)))
        rss, of = F.col("total") - 2 * F.col("phi") * cross + F.col("phi") * F.col("phi") * F.col("inside"), F.col("n") - 1
    else:
        fit = fit.withColumn("phi", F.coalesce(F.try_divide("cross", "past"), F.lit(0.0)))
        rss, of = F.col("now") - 2 * F.col("phi") * cross + F.col("phi") * F.col("phi") * F.col("past"), F.col("pairs")
    fit = fit.withColumn("sigma2", F.greatest(F.try_divide(rss, of), F.lit(0.0)))
    enough = F.col("n") >= min_points

    def step(k: int):
        partial = [sum((F.pow("phi", F.lit(float(i))) for i in range(1, j + 1)), F.lit(1.0)) for j in range(k)]
        yhat = F.col("last_v") + F.col("last_d") * F.col("phi") * partial[-1]
        spread = F.sqrt(F.col("sigma2") * sum((x * x for x in partial[1:]), F.lit(1.0)))
        return [F.lit(k).alias("step"), (F.col("last_t") + k).cast("int").alias("period"), *_bands(yhat, spread)]

    return fit.select(*p.series, enough.alias("success"), _steps(h, enough, step).alias("_s")).select(
        *p.series, "_s.*", F.when(F.col("success"), ARIMA_NAME).otherwise("None").alias("model"), "success").select(*p.series, *FORECAST_COLUMNS)


def trend_test(df: DataFrame, p: PanelSpec, h: int = 3, level: float = 0.95) -> DataFrame:
    """Straight line per series with slope, its t test, and t-based prediction intervals."""
    fit = linear_fit(df, p).where("n >= 3")
    dof = F.col("n") - 2
    s2 = F.col("sse") / dof
    fit = fit.withColumns({
        "slope_se": F.sqrt(F.try_divide(s2, F.col("sxx"))),
        "direction": F.when(F.col("slope") > 0, "increasing").otherwise("decreasing"),
        "t_crit": t_quantile(level, dof),
        "residual_sd": F.sqrt(s2),
    })
    fit = fit.withColumn("t_stat", F.try_divide("slope", "slope_se")).withColumn(
        "p_value", two_sided_p("t_stat", dof))

    def step(k: int):
        at = F.col("last_t") + k
        off = at - F.col("mean_t")
        yhat = F.col("mean_v") + F.col("slope") * off
        half = F.col("t_crit") * F.col("residual_sd") * F.sqrt(1 + 1 / F.col("n") + F.try_divide(off * off, F.col("sxx")))
        return [F.lit(k).alias("step"), at.cast("int").alias("period"), yhat.alias("yhat"),
                (yhat - half).alias("lo95"), (yhat + half).alias("hi95")]

    stats = ["n", "slope", "slope_se", "t_stat", "p_value", "direction"]
    return fit.select(*p.series, *stats, _steps(h, F.lit(True), step).alias("_s")).select(*p.series, *stats, "_s.*")


# --- exponential smoothing, per series --------------------------------------

def smooth(y: np.ndarray, alpha: np.ndarray, beta: np.ndarray | None):
    """Fit level (and trend) smoothing of one series for many parameter pairs at once.

    Sums of products of the errors give, by least squares, the best start for
    each pair, so the memory does not depend on the length of the series.
    Returns the sum of squares, start, last level and last trend per pair.
    """
    sse, start, level, slope = smooth_many(np.asarray(y, float)[None], alpha[None], None if beta is None else beta[None])
    return sse[0], start[0], level[0], slope[0]


def residuals(y: np.ndarray, alpha: float, beta: float | None, start: np.ndarray) -> np.ndarray:
    """The one-step errors of one fitted pair."""
    whole = np.concatenate([[1.0], start])
    steps = smoothing_steps(np.asarray(y, float)[None], np.array([[alpha]]), None if beta is None else np.array([[beta]]))
    return np.array([float(whole @ error[:, 0, 0]) for error, _, _ in steps])


def best_smooth(y: np.ndarray, trend: bool, points: int = 21, rounds: int = 3) -> dict:
    """``best_smooth_many`` of one series."""
    found = best_smooth_many(np.asarray(y, float)[None], trend, points, rounds)
    return {k: v[0] if v[0].ndim else float(v[0]) for k, v in found.items()}


def ets_many(y: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray]:
    """Additive-trend forecasts of many series and their spreads, which grow with sqrt(step)."""
    fit = best_smooth_many(y, trend=True)
    steps = np.arange(1, h + 1)
    yhat = fit["level"][:, None] + fit["slope"][:, None] * steps
    return yhat, np.std(fit["resid"], axis=1, ddof=1)[:, None] * np.sqrt(steps)


def ets_steps(y: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray]:
    """``ets_many`` of one series."""
    yhat, spread = ets_many(np.asarray(y, float)[None], h)
    if not np.all(np.isfinite(yhat)):
        raise ArithmeticError("smoothing did not converge")
    return yhat[0], spread[0]


def aicc_many(y: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The better of level and additive trend by corrected AIC for many series, with model variances."""
    n, steps = y.shape[1], np.arange(1, h + 1)
    if n - 3 - 1 <= 0:
        raise ArithmeticError("too few points to choose a model")
    best = np.full(len(y), np.inf)
    yhat, spread, names = np.zeros((len(y), h)), np.zeros((len(y), h)), [""] * len(y)
    for trend, k in ((False, 3), (True, 5)):
        if n - k - 1 <= 0:
            continue
        fit = best_smooth_many(y, trend)
        score = n * np.log(np.maximum(fit["sse"], 1e-300) / n) + 2 * k + 2 * k * (k + 1) / (n - k - 1)
        a, b = fit["alpha"][:, None], (fit["alpha"] * fit["beta"])[:, None]
        growth = (steps - 1) * (a * a + a * b * steps + b * b * steps * (2 * steps - 1) / 6)
        sigma2 = fit["sse"] / max(n - k + 1, 1)
        wins = score < best
        best[wins] = score[wins]
        yhat[wins] = (fit["level"][:, None] + fit["slope"][:, None] * steps)[wins]
        spread[wins] = np.sqrt(sigma2[:, None] * (1 + growth))[wins]
        names = [("ETS(A,A,N)" if trend else "ETS(A,N,N)") if w else old for w, old in zip(wins, names)]
    return yhat, spread, names


def aicc_steps(y: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray, str]:
    """``aicc_many`` of one series."""
    yhat, spread, names = aicc_many(np.asarray(y, float)[None], h)
    return yhat[0], spread[0], names[0]


def arima_steps(y: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray]:
    """Forecast and spread of one series by exact likelihood, as in ``forecast_arima110``."""
    d = np.diff(y)
    m, total, cross, inside = len(d), float(d @ d), float(d[1:] @ d[:-1]), float(d[1:-1] @ d[1:-1])
    phi = 0.0
    if total:
        roots = np.roots([(m - 1) * inside / total, -(m - 2) * cross / total, -1 - m * inside / total, m * cross / total])
        phi = float(np.clip(min(roots.real, key=abs), -1, 1)) if len(roots) else 0.0
    partial = np.cumsum(phi ** np.arange(h))
    sigma2 = max((total - 2 * phi * cross + phi * phi * inside) / m, 0.0)
    yhat = y[-1] + d[-1] * phi * partial
    if not np.all(np.isfinite(yhat)):
        raise ArithmeticError("autoregression did not converge")
    return yhat, np.sqrt(sigma2 * np.cumsum(partial ** 2))


def linear_steps(t: np.ndarray, y: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray]:
    steps = np.arange(1, h + 1)
    centre = t.mean()
    slope = float((t - centre) @ (y - y.mean())) / float((t - centre) @ (t - centre))
    resid = y - y.mean() - slope * (t - centre)
    sigma = np.sqrt(float(resid @ resid) / (len(y) - 2))
    return y.mean() + slope * (t[-1] + steps - centre), sigma * np.sqrt(1 + steps / len(y))


def forecast_one(t: np.ndarray, y: np.ndarray, h: int, mode: str):
    """(model, forecast, spread) by the first model that works, or None."""
    attempts = {
        "ets": [lambda: (ETS_NAME, *ets_steps(y, h))],
        "chain": [
            lambda: (ETS_NAME, *ets_steps(y, h)),
            lambda: (ARIMA_NAME, *arima_steps(y, h)),
            lambda: (LINEAR_NAME, *linear_steps(t, y, h)),
        ],
        "aicc": [lambda: (lambda f: (f[2], f[0], f[1]))(aicc_steps(y, h))],
    }[mode]
    for attempt in attempts:
        try:
            return attempt()
        except (ArithmeticError, ValueError, np.linalg.LinAlgError):
            continue
    return None


def forecast_many(series: list[tuple[np.ndarray, np.ndarray]], h: int, mode: str, min_points: int) -> list[tuple | None]:
    """(model, forecast, spread) of every series of times and values, or None; series of one length are fitted together."""
    found: list[tuple | None] = [None] * len(series)
    lengths: dict[int, list[int]] = {}
    for i, (_, y) in enumerate(series):
        if len(y) >= min_points:
            lengths.setdefault(len(y), []).append(i)
    for places in lengths.values():
        y = np.stack([series[i][1] for i in places])
        with np.errstate(all="ignore"):
            try:
                if mode == "models":
                    yhat, spread, number, _ = choose_model(y, h)
                    names = [MODELS[m][0] if m >= 0 else None for m in number]
                elif mode == "aicc":
                    yhat, spread, names = aicc_many(y, h)
                else:
                    yhat, spread = ets_many(y, h)
                    names = [ETS_NAME] * len(y)
            except (ArithmeticError, ValueError, np.linalg.LinAlgError):
                names = [None] * len(places)
        for k, i in enumerate(places):
            if names[k] is not None and np.all(np.isfinite(yhat[k])):
                found[i] = names[k], yhat[k], spread[k]
            elif mode != "models":
                # One by one, as a series that can not be fitted must not take others with it.
                found[i] = forecast_one(*series[i], h, mode)
    return found


def _per_series(df: DataFrame, p: PanelSpec, h: int, min_points: int, mode: str) -> DataFrame:
    # One mean per period first: combined before the shuffle. Series are then dealt into
    # groups that a task fits together; there are more groups the larger the input is.
    rows = _observed(df, p).where(F.col("t").isNotNull()).groupBy(*p.series, "t").agg(F.avg("v").alias("v"))
    series = list(p.series)
    by_name = {f.name: f.dataType for f in rows.schema.fields}
    schema = T.StructType(
        [T.StructField(c, by_name[c]) for c in series]
        + [T.StructField("step", T.IntegerType()), T.StructField("period", T.IntegerType())]
        + [T.StructField(c, T.DoubleType()) for c in ("yhat", "lo80", "hi80", "lo95", "hi95")]
        + [T.StructField("model", T.StringType()), T.StructField("success", T.BooleanType())]
    )

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        which = pdf.groupby(series, dropna=False, sort=False).ngroup().to_numpy() if series else np.zeros(len(pdf), int)
        t, v = pdf["t"].to_numpy(float), pdf["v"].to_numpy(float)
        order = np.lexsort((t, which))
        t, v, which = t[order], v[order], which[order]
        begins = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
        ends = np.append(begins[1:], len(which))
        points = [(t[x:y][~np.isnan(v[x:y])], v[x:y][~np.isnan(v[x:y])]) for x, y in zip(begins, ends)]
        found = forecast_many(points, h, mode, min_points)
        steps = np.arange(1, h + 1)
        keys, out = [], {c: [] for c in schema.names[len(series):]}
        for first, (at, _), one in zip(order[begins], points, found):
            n = h if one else 1
            keys.extend([first] * n)
            yhat, spread = (one[1], one[2]) if one else ([None], None)
            values = {"step": steps if one else [None], "period": int(at[-1]) + steps if one else [None], "yhat": yhat,
                      "model": [one[0] if one else "None"] * n, "success": [bool(one)] * n}
            for name, z in (("lo80", -Z80), ("hi80", Z80), ("lo95", -Z95), ("hi95", Z95)):
                values[name] = yhat + z * spread if one else [None]
            for c, x in values.items():
                out[c].extend(list(x))
        back = {c: pdf[c].iloc[keys].to_numpy() for c in series}
        return pd.DataFrame({**back, **{c: pd.Series(out[c], dtype=object if c in ("model", "success") else "Int32" if c in ("step", "period") else float)
                                        for c in schema.names[len(series):]}})

    groups = SERIES_GROUPS * pieces_for(df)
    dealt = rows.withColumn("_deal", F.pmod(F.xxhash64(*series) if series else F.lit(0), F.lit(groups)))
    return dealt.groupBy("_deal").applyInPandas(fit, schema)


def forecast_ets(df: DataFrame, p: PanelSpec, h: int = 3, min_points: int = MIN_POINTS) -> DataFrame:
    """Additive-trend exponential smoothing of every series."""
    return _per_series(df, p, h, min_points, "ets")


def forecast_auto(df: DataFrame, p: PanelSpec, h: int = 3, min_points: int = MIN_POINTS, choose: str = "chain") -> DataFrame:
    """Smoothing, else ARIMA, else a line (``chain``); level against trend by corrected AIC (``aicc``); or
    the best of the six smoothing models without season by likelihood and corrected AIC (``models``)."""
    if choose not in ("chain", "aicc", "models"):
        raise ValueError("choose must be 'chain', 'aicc' or 'models'")
    return _per_series(df, p, h, min_points, choose)


def forecast_compare(df: DataFrame, p: PanelSpec, h: int = 3) -> DataFrame:
    """Smoothing and linear trend side by side, one row per series and future period."""
    ets = forecast_auto(df, p, h, choose="aicc").where("success").select(
        *p.series, "period", *[F.col(c).alias(f"ets_{c}") for c in ("yhat", "lo80", "hi80", "lo95", "hi95")])
    line = trend_test(df, p, h).select(
        *p.series, "period", *[F.col(c).alias(f"linear_{c}") for c in ("yhat", "lo95", "hi95")])
    return ets.join(line, [*p.series, "period"], "inner")


def bind_history(df: DataFrame, forecast: DataFrame, p: PanelSpec) -> DataFrame:
    """Observed and forecast points of each series in one frame."""
    history = df.select(*p.series, F.col(p.period).cast("int").alias("period"),
                        F.col(p.value).cast("double").alias("value"), F.lit("Historical").alias("type"))
    ahead = forecast.where("success").select(*p.series, "period", F.col("yhat").alias("value"), F.lit("Forecast").alias("type"))
    return history.unionByName(ahead)
