"""Exponential smoothing of many series at once.

Series of one length are the rows of a matrix, and a step of a search moves all of
them: the recursions run over the periods with one array operation for all series and
all weights that are tried.

Two searches are here. ``best_smooth_many`` refines a grid around the best sum of squares
of the additive models. ``choose_model`` fits the six models without season, by error
(additive, multiplicative) and trend (none, additive, damped), by maximum likelihood with
a simplex that all series descend side by side, and takes the one with the lowest
corrected AIC.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Series that are searched together, and weights of the grid with them.
TOGETHER = 256


def smoothing_steps(y: np.ndarray, alpha: np.ndarray, beta: np.ndarray | None):
    """The recursion on the data and on unit starts, point by point; ``y`` has a row per series, the weights a column per try.

    One-step errors are linear in the initial level and trend; the first axis of what
    is yielded is that linear map: errors, level and trend for the data from a zero
    start, then for each unit start without data.
    """
    trend = beta is not None
    starts = 2 if trend else 1
    level = np.zeros((starts + 1, *alpha.shape))
    slope = np.zeros((starts + 1, *alpha.shape))
    level[1] = 1.0
    if trend:
        slope[2] = 1.0
    target = np.zeros((starts + 1, len(y), 1))
    for value in y.T:
        ahead = level + slope
        target[0] = value[:, None]
        error = target - ahead
        new_level = ahead + alpha * error
        if trend:
            slope = slope + beta * (new_level - level - slope)
        level = new_level
        yield error, level, slope


def smooth_many(y: np.ndarray, alpha: np.ndarray, beta: np.ndarray | None):
    """Sum of squares, start, last level and last trend per series and try, with the best start by least squares."""
    starts = 2 if beta is not None else 1
    products = np.zeros((*alpha.shape, starts + 1, starts + 1))
    error = level = slope = np.zeros((starts + 1, *alpha.shape))
    for error, level, slope in smoothing_steps(y, alpha, beta):
        moved = np.moveaxis(error, 0, -1)
        products += moved[..., :, None] * moved[..., None, :]
    gram, cross = products[..., 1:, 1:], products[..., 1:, 0]
    start = -np.linalg.solve(gram + 1e-12 * np.eye(starts), cross[..., None])[..., 0]
    whole = np.concatenate([np.ones((*alpha.shape, 1)), start], axis=-1)
    sse = np.maximum(np.einsum("...i,...ij,...j->...", whole, products, whole), 0.0)
    return sse, start, np.einsum("i...,...i->...", level, whole), np.einsum("i...,...i->...", slope, whole)


def least(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place and the rounded value of the least of every row, the first among those that agree to eight digits."""
    place, found = np.zeros(len(values), int), np.zeros(len(values))
    for i, row in enumerate(values):
        near = np.flatnonzero(row <= row.min() * (1 + 1e-6))
        keys = [float(f"{x:.7e}") for x in row[near]]
        best = int(np.argmin(keys))
        place[i], found[i] = near[best], keys[best]
    return place, found


def best_smooth_many(y: np.ndarray, trend: bool, points: int = 21, rounds: int = 3) -> dict[str, np.ndarray]:
    """Grid search over the smoothing weights of every row, refined around its best cell.

    The trend weight applies to changes of the level, and lies in (0, 1). Sums of
    squares that agree to eight digits are equal; then the earlier round, the
    smaller trend weight and the smaller level weight win.
    """
    if len(y) > TOGETHER:
        parts = [best_smooth_many(y[i:i + TOGETHER], trend, points, rounds) for i in range(0, len(y), TOGETHER)]
        return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
    n = len(y)
    rows = np.arange(n)
    centre_a, centre_b, width = np.full(n, 0.5), np.full(n, 0.5), 0.4999
    best: dict[str, np.ndarray] | None = None
    noise = 1e-6 * np.einsum("st,st->s", y, y)
    for _ in range(rounds):
        axis = np.linspace(-width, width, points)
        alphas = np.clip(centre_a[:, None] + axis, 1e-4, 0.9999)
        if trend:
            betas = np.clip(centre_b[:, None] + axis, 1e-4, 0.9999)
            alpha, beta = np.tile(alphas, (1, points)), np.repeat(betas, points, axis=1)
        else:
            alpha, beta = alphas, None
        sse, start, level, slope = smooth_many(y, alpha, beta)
        at, key = least(sse + noise[:, None])
        new = {"key": key, "start": start[rows, at], "level": level[rows, at], "slope": slope[rows, at],
               "alpha": alpha[rows, at], "beta": beta[rows, at] if trend else np.zeros(n)}
        if best is None:
            best = new
        else:
            better = key < best["key"]
            best = {k: np.where(better.reshape(-1, *[1] * (v.ndim - 1)), new[k], v) for k, v in best.items()}
        centre_a, centre_b, width = best["alpha"], best["beta"] if trend else centre_b, 2 * width / (points - 1)
    # The sums lose digits where the fit is close; the errors themselves do not.
    whole = np.concatenate([np.ones((n, 1)), best["start"]], axis=1)
    steps = smoothing_steps(y, best["alpha"][:, None], best["beta"][:, None] if trend else None)
    best["resid"] = np.stack([np.einsum("si,is->s", whole, error[:, :, 0]) for error, _, _ in steps], axis=1)
    best["sse"] = np.einsum("st,st->s", best["resid"], best["resid"])
    return best


# --- the six models ----------------------------------------------------------

# Names, whether errors are relative, what the trend is, and parameters with the variance.
MODELS = (
    ("ETS(A,N,N)", False, "none", 3), ("ETS(M,N,N)", True, "none", 3),
    ("ETS(A,A,N)", False, "additive", 5), ("ETS(M,A,N)", True, "additive", 5),
    ("ETS(A,Ad,N)", False, "damped", 6), ("ETS(M,Ad,N)", True, "damped", 6),
)
# Bounds of the level weight, of the trend weight as a share of it, and of the damping.
WEIGHTS, DAMPING = (1e-4, 0.9999), (0.8, 0.98)
WORST = 1e300
# Where descents start: a slow level, a middling one, one that follows the data, and one with a fast trend.
STARTS = np.array([[-1.5, -2.0, 0.0], [0.5, 0.0, 0.0], [3.0, -4.0, 1.0], [-4.0, 2.0, -1.0]])


def descend(f: Callable[[np.ndarray, np.ndarray], np.ndarray], start: np.ndarray, size: float, rounds: int, close: float = 1e-10) -> tuple[np.ndarray, np.ndarray]:
    """Minimise ``f`` for every row of ``start`` by simplexes that move side by side.

    ``f`` gets points (rows, tries, dimensions) and the numbers of the rows, and returns
    values (rows, tries). Rows whose simplex is flat to ``close`` leave the search.
    """
    n, d = start.shape
    simplex = np.repeat(start[:, None, :], d + 1, axis=1)
    simplex[:, np.arange(1, d + 1), np.arange(d)] += size
    values = f(simplex, np.arange(n))
    alive = np.arange(n)
    for _ in range(rounds):
        order = np.argsort(values[alive], axis=1, kind="stable")
        simplex[alive] = np.take_along_axis(simplex[alive], order[:, :, None], axis=1)
        values[alive] = np.take_along_axis(values[alive], order, axis=1)
        spread = values[alive, -1] - values[alive, 0]
        alive = alive[spread > close * (np.abs(values[alive, 0]) + close)]
        if not len(alive):
            break
        s, v = simplex[alive], values[alive]
        middle, last = s[:, :-1].mean(axis=1), s[:, -1]
        # Reflection, expansion, and contraction on both sides are tried at once.
        tries = np.stack([middle + c * (middle - last) for c in (1.0, 2.0, 0.5, -0.5)], axis=1)
        found = f(tries, alive)
        reflected, expanded, outside, inside = found.T
        pick = np.where(reflected < v[:, 0], np.where(expanded < reflected, 1, 0),
                        np.where(reflected < v[:, -2], 0, np.where(reflected < v[:, -1], np.where(outside <= reflected, 2, -1),
                                                                   np.where(inside < v[:, -1], 3, -1))))
        moved = np.flatnonzero(pick >= 0)
        s[moved, -1], v[moved, -1] = tries[moved, pick[moved]], found[moved, pick[moved]]
        shrunk = np.flatnonzero(pick < 0)
        if len(shrunk):
            s[shrunk, 1:] = (s[shrunk, 1:] + s[shrunk, :1]) / 2
            v[shrunk, 1:] = f(s[shrunk, 1:], alive[shrunk])
        simplex[alive], values[alive] = s, v
    best = np.argmin(values, axis=1)
    return simplex[np.arange(n), best], values[np.arange(n), best]


def _inside(x: np.ndarray, bounds: tuple[float, float]) -> np.ndarray:
    return bounds[0] + (bounds[1] - bounds[0]) / (1 + np.exp(-np.clip(x, -40, 40)))


def _weights(x: np.ndarray, trend: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Level weight, trend weight and damping from free numbers."""
    alpha = _inside(x[..., 0], WEIGHTS)
    beta = alpha * _inside(x[..., 1], WEIGHTS) if trend != "none" else np.zeros_like(alpha)
    phi = _inside(x[..., 2], DAMPING) if trend == "damped" else np.ones_like(alpha)
    return alpha, beta, phi


def _pass(y: np.ndarray, alpha: np.ndarray, beta: np.ndarray, phi: np.ndarray, level: np.ndarray, slope: np.ndarray):
    """One-step forecasts and errors in turn, then the last level and trend; ``y`` has a row per series, the rest tries beside it."""
    ahead, errors = [], []
    for value in y.T:
        mean = level + phi * slope
        error = value[:, None] - mean
        ahead.append(mean)
        errors.append(error)
        level, slope = mean + alpha * error, phi * slope + beta * error
    return np.stack(ahead, -1), np.stack(errors, -1), level, slope


def _best_start(y: np.ndarray, alpha: np.ndarray, beta: np.ndarray, phi: np.ndarray, trend: bool) -> tuple[np.ndarray, np.ndarray]:
    """The initial level and trend with the least sum of squares: errors are linear in them."""
    zero, one = np.zeros_like(alpha), np.ones_like(alpha)
    nothing = np.zeros_like(y)
    base = _pass(y, alpha, beta, phi, zero, zero)[1]
    by_level = _pass(nothing, alpha, beta, phi, one, zero)[1]
    ll, lb = (by_level * by_level).sum(-1), (by_level * base).sum(-1)
    if not trend:
        return -lb / ll, zero
    by_slope = _pass(nothing, alpha, beta, phi, zero, one)[1]
    ss, ls, sb = (by_slope * by_slope).sum(-1), (by_level * by_slope).sum(-1), (by_slope * base).sum(-1)
    det = ll * ss - ls * ls
    safe = np.abs(det) > 1e-12 * ll * ss
    det = np.where(safe, det, 1.0)
    return np.where(safe, (ls * sb - ss * lb) / det, -lb / ll), np.where(safe, (ls * lb - ll * sb) / det, 0.0)


def _fit(y: np.ndarray, relative: bool, trend: str, warm: dict[str, np.ndarray] | None) -> dict[str, np.ndarray]:
    """The likeliest weights and start of one model for every row of ``y``.

    With additive errors the best start follows from the weights. With relative errors it is searched
    as well, from what additive errors give (``warm``). ``gain`` is -2 log likelihood but for a constant.
    """
    n, t = y.shape
    floor = 1e-24 * np.einsum("st,st->s", y, y) + 1e-300
    scale = np.maximum(y.std(axis=1), 1e-9 * np.abs(y).max(axis=1) + 1e-12)
    free = {"none": 1, "additive": 2, "damped": 3}[trend]

    def start_of(x: np.ndarray, rows: np.ndarray, weights: tuple) -> tuple[np.ndarray, np.ndarray]:
        if not relative:
            return _best_start(y[rows], *weights, trend != "none")
        level = warm["level0"][rows][:, None] + scale[rows][:, None] * x[..., free]
        slope = warm["slope0"][rows][:, None] + scale[rows][:, None] * x[..., free + 1] if trend != "none" else np.zeros_like(level)
        return level, slope

    def cost(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
        weights = _weights(x, trend)
        ahead, errors, _, _ = _pass(y[rows], *weights, *start_of(x, rows, weights))
        if not relative:
            return t * np.log(np.maximum((errors * errors).sum(-1), floor[rows][:, None]))
        good = (ahead > 0).all(-1)
        mean = np.where(ahead > 0, ahead, 1.0)
        total = ((errors / mean) ** 2).sum(-1)
        return np.where(good, t * np.log(np.maximum(total, 1e-24)) + 2 * np.log(mean).sum(-1), WORST)

    if relative:
        states = 1 if trend == "none" else 2
        starts = [np.concatenate([x, np.zeros((n, states))], axis=1) for x in (warm["x"], *(np.tile(s, (n, 1)) for s in STARTS[:, :free]))]
    else:
        states, starts = 0, [np.tile(s, (n, 1)) for s in STARTS[:, :free]]
    # The likelihood has several hills: the best of the descents from all starts goes on from a new simplex.
    tries = [descend(cost, start, 0.7, 60 * (free + states)) for start in starts]
    best = np.argmin([g for _, g in tries], axis=0)
    x = np.stack([a for a, _ in tries])[best, np.arange(n)]
    for size in (0.3, 0.05):
        x, gain = descend(cost, x, size, 60 * (free + states))
    rows, x1 = np.arange(n), x[:, None, :]
    weights = _weights(x1, trend)
    level0, slope0 = start_of(x1, rows, weights)
    ahead, errors, level, slope = _pass(y, *weights, level0, slope0)
    with np.errstate(divide="ignore", invalid="ignore"):
        resid = np.where(ahead != 0, errors / ahead, np.inf) if relative else errors
    return {"x": x[:, :free], "gain": gain, "alpha": weights[0][:, 0], "beta": weights[1][:, 0], "phi": weights[2][:, 0],
            "level0": level0[:, 0], "slope0": slope0[:, 0], "level": level[:, 0], "slope": slope[:, 0],
            "sse": (resid * resid).sum(-1)[:, 0]}


def variances(mean: np.ndarray, sigma2: np.ndarray, alpha: np.ndarray, beta: np.ndarray, phi: np.ndarray, relative: bool) -> np.ndarray:
    """Forecast variances of every row: a sum of squared weights for additive errors, a recursion for relative ones."""
    n, h = mean.shape
    powers = np.cumsum(phi[:, None] ** np.arange(1, h + 1), axis=1)
    weight = alpha[:, None] + beta[:, None] * powers
    if not relative:
        before = np.concatenate([np.zeros((n, 1)), np.cumsum(weight[:, :-1] ** 2, axis=1)], axis=1)
        return sigma2[:, None] * (1 + before)
    theta = np.zeros((n, h))
    for k in range(h):
        theta[:, k] = mean[:, k] ** 2 + sigma2 * sum((weight[:, j] ** 2 * theta[:, k - 1 - j] for j in range(k)), np.zeros(n))
    return (1 + sigma2[:, None]) * theta - mean ** 2


def choose_model(y: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Forecasts, their spreads, model numbers and corrected AICs of rows of one length; number -1 where no model fits.

    Relative errors are tried where all values are positive, and a model only with more points than
    its parameters and one. AICs that agree to a millionth are equal; the earlier of ``MODELS`` wins.
    """
    if len(y) > TOGETHER:
        parts = [choose_model(y[i:i + TOGETHER], h) for i in range(0, len(y), TOGETHER)]
        return tuple(np.concatenate(p) for p in zip(*parts))
    n, t = y.shape
    mean, spread, number, score = np.zeros((n, h)), np.zeros((n, h)), np.full(n, -1), np.full(n, np.inf)
    ahead, warm = np.arange(1, h + 1), {}
    for m, (_, relative, trend, k) in enumerate(MODELS):
        if t - k - 1 <= 0:
            continue
        rows = np.flatnonzero((y > 0).all(axis=1)) if relative else np.arange(n)
        if not len(rows):
            continue
        fit = _fit(y[rows], relative, trend, {key: v[rows] for key, v in warm[trend].items()} if relative else None)
        if not relative:
            warm[trend] = fit
        aicc = fit["gain"] + 2 * k + 2 * k * (k + 1) / (t - k - 1)
        growth = np.cumsum(fit["phi"][:, None] ** ahead, axis=1) if trend == "damped" else np.tile(ahead, (len(rows), 1)).astype(float)
        yhat = fit["level"][:, None] + growth * fit["slope"][:, None]
        var = variances(yhat, fit["sse"] / max(t - k + 1, 1), fit["alpha"], fit["beta"], fit["phi"], relative)
        with np.errstate(invalid="ignore"):
            wins = (aicc < score[rows] - 1e-6) & (fit["gain"] < WORST) & np.isfinite(yhat).all(1) & np.isfinite(var).all(1)
        at = rows[wins]
        mean[at], spread[at], number[at], score[at] = yhat[wins], np.sqrt(np.maximum(var[wins], 0.0)), m, aicc[wins]
    return mean, spread, number, score
