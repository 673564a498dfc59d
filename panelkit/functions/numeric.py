"""Arithmetic shared by the operators. Every function returns a Column."""

from __future__ import annotations

import math
from collections.abc import Callable
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def significant(c: Column | str) -> Column:
    """A number as a double of 15 significant digits, NULL for NaN.

    Those digits are what a double keeps of any decimal, so what two engines
    add up in another order is the same number afterwards, at any size.
    """
    value = as_col(c).cast("double")
    return F.when(~F.isnan(value), F.format_string("%.14e", value).try_cast("double"))


def round_half_up(c: Column | str, digits: int) -> Column:
    """Round half away from zero on the 15 significant digits of a double, once."""
    return F.round(significant(c), digits)


def maybe_round(c: Column, digits: int | None) -> Column:
    return c if digits is None else round_half_up(c, digits)


def guarded_ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` where ``den`` is positive, else NULL."""
    num, den = as_col(num), as_col(den)
    return F.when(den > 0, num / den)


def rate_per(count: Column | str, population: Column | str, per: float = 100_000, digits: int | None = 1) -> Column:
    """Events per ``per`` head; NULL when either side is missing or nobody lives there."""
    return maybe_round(guarded_ratio(count, population) * F.lit(float(per)), digits)


def suppress_small_cells(rate: Column | str, count: Column | str | None = None, k: int = 5) -> Column:
    """True where the rate is missing or rests on fewer than ``k`` events."""
    hidden = as_col(rate).isNull()
    if count is not None:
        hidden = hidden | F.coalesce(as_col(count) < k, F.lit(False))
    return hidden


def gap_to_benchmark(value: Column | str, benchmark: Column | str, digits: int | None = None, missing: str = "null") -> Column:
    """Distance to the benchmark; ``missing="zero"`` measures from zero when there is none."""
    if missing not in ("null", "zero"):
        raise ValueError("missing must be 'null' or 'zero'")
    benchmark = as_col(benchmark)
    if missing == "zero":
        benchmark = F.coalesce(benchmark, F.lit(0.0))
    return maybe_round(as_col(value) - benchmark, digits)


def ratio_to_benchmark(value: Column | str, benchmark: Column | str, digits: int | None = 2) -> Column:
    return maybe_round(guarded_ratio(value, benchmark), digits)


def pct_change(value: Column | str, previous: Column | str, digits: int | None = None, guard: str = "positive") -> Column:
    """Change in percent of the previous value.

    ``guard="positive"`` needs a previous value above zero, ``"nonzero"`` only
    one that is not zero.
    """
    value, previous = as_col(value), as_col(previous)
    allowed = {"positive": previous > 0, "nonzero": previous != 0}[guard]
    return maybe_round(F.when(allowed, (value - previous) / previous * 100), digits)


# Up to so many degrees of freedom the t probability is a finite sum; beyond, the
# normal transformation is exact to the last digits of a double.
FINITE_DOF = 400


def normal_tail(z: Column) -> Column:
    """Two-sided normal tail probability of ``z >= 0``: a series up to 3, a continued fraction beyond."""
    def of(x: Column) -> Column:
        # erf(x) is exp(-x^2) times a sum of positive terms, each 2x^2 / (2n + 1) times the one before.
        def add(state, n):
            return bound(state["term"] * 2.0 * x * x / (2.0 * n + 1),
                         lambda term: F.struct((state["total"] + term).alias("total"), term.alias("term")))

        inner = F.aggregate(F.sequence(F.lit(1), F.lit(60)), F.struct(x.alias("total"), x.alias("term")), add, lambda s: s["total"])
        outer = F.aggregate(F.sequence(F.lit(80), F.lit(1), F.lit(-1)), x, lambda k, n: x + n / 2.0 / k)
        scale = F.exp(-x * x) / F.sqrt(F.pi())
        return F.when(x < 3 / 2 ** 0.5, F.lit(1.0) - 2 * scale * inner).otherwise(scale / outer)

    return bound(z / F.sqrt(F.lit(2.0)), of)


def _finite_tail(t: Column, n: Column) -> Column:
    """The tail for up to ``FINITE_DOF`` degrees of freedom, with theta = atan(t / sqrt(n)), as a sum in powers of cos(theta)."""
    def of(theta: Column) -> Column:
        odd = n % 2 == 1
        terms = F.when(odd, (n - 1) / 2).otherwise(n / 2).cast("int")

        def total(cos: Column) -> Column:
            # Term j grows from term j-1 by cos^2 times 2j/(2j+1) or (2j-1)/(2j).
            def step(state, j):
                grow = F.when(odd, (2.0 * j) / (2.0 * j + 1)).otherwise((2.0 * j - 1) / (2.0 * j))
                return bound(state["term"] * cos * cos * grow,
                             lambda term: F.struct((state["total"] + term).alias("total"), term.alias("term")))

            return bound(F.when(odd, cos).otherwise(F.lit(1.0)), lambda first: F.aggregate(
                F.when(terms > 1, F.sequence(F.lit(1), terms - 1)).otherwise(F.array().cast("array<int>")),
                F.struct(first.alias("total"), first.alias("term")), step, lambda s: s["total"]))

        series = bound(F.cos(theta), total)
        half_turn = F.lit(2.0) / F.pi()
        central = (
            F.when(n == 1, half_turn * theta)
            .when(odd, half_turn * (theta + F.sin(theta) * series))
            .otherwise(F.sin(theta) * series)
        )
        return F.greatest(F.lit(1.0) - central, F.lit(0.0))

    return bound(F.atan(t / F.sqrt(n.cast("double"))), of)


def _wide_tail(t: Column, n: Column) -> Column:
    """The tail for many degrees of freedom, by the normal deviate that has the same."""
    def deviate(y: Column, b: Column) -> Column:
        return F.sqrt(y) * (1.0 + (y + 3.0 + (((-0.4 * y - 3.3) * y - 24.0) * y - 85.5) / (0.8 * y * y + 100.0 + b)) / b)

    a = n - 0.5
    return normal_tail(bound(a * F.log1p(t * t / n), lambda y: deviate(y, 48.0 * a * a)))


def two_sided_p(t: Column | str, dof: Column | str) -> Column:
    """Two-sided Student t tail probability for whole degrees of freedom, in constant work.

    With theta = atan(|t| / sqrt(dof)) the central probability is a finite sum
    in powers of cos(theta) (Abramowitz and Stegun 26.7.3 and 26.7.4). Its length
    is half the degrees of freedom, so above ``FINITE_DOF`` t is turned into the
    normal deviate of the same tail instead (Hill 1970, whose error there is
    below that of a double).
    """
    both = F.struct(F.abs(as_col(t)).cast("double").alias("t"), as_col(dof).cast("bigint").alias("n"))
    return bound(both, lambda s: F.when(s["t"].isNull(), F.lit(None).cast("double")).when(s["n"] > FINITE_DOF, _wide_tail(s["t"], s["n"].cast("double"))).when(
        s["n"] >= 1, _finite_tail(s["t"], s["n"])))


def _density(t: Column, n: Column) -> Column:
    """Density of Student's t on both sides; the ratio of gamma functions is a series in 1/n, good to 3 digits at n = 3."""
    gammas = F.sqrt(n / 2) * (1.0 - 0.25 / n + 0.03125 / (n * n) + 0.0390625 / (n * n * n))
    return 2.0 * gammas / F.sqrt(n * F.pi()) * F.exp(-(n + 1) / 2 * F.log1p(t * t / n))


def t_quantile(level: float, dof: Column | str) -> Column:
    """The t with ``level`` of the probability inside (-t, t), in constant work.

    For one and two degrees of freedom it has a closed form. Beyond, Hill's expansion
    (1970) gives four digits or more, and three Newton steps on the tail all of them.
    """
    if not 0 < level < 1:
        raise ValueError("level must lie between 0 and 1")
    alpha = 1.0 - level
    z = NormalDist().inv_cdf(alpha / 2)

    def start(n: Column) -> Column:
        a = 1.0 / (n - 0.5)
        b = 48.0 / (a * a)
        c0 = ((20700.0 * a / b - 98.0) * a - 16.0) * a + 96.36
        d = ((94.5 / (b + c0) - 3.0) / b + 1.0) * F.sqrt(a * F.pi() / 2) * n

        def of(s: Column) -> Column:
            a, b, d, y = s["a"], s["b"], s["d"], s["y"]

            # Far out an expansion about the normal deviate, near the centre a power of the tail.
            def about_normal(c: Column) -> Column:
                x2 = z * z
                inner = bound((((((0.4 * x2 + 6.3) * x2 + 36.0) * x2 + 94.5) / c - x2 - 3.0) / b + 1.0) * z, lambda w: a * w * w)
                return bound(inner, lambda w: F.expm1(w))

            c = s["c"] + F.when(n < 5, 0.3 * (n - 4.5) * (z + 0.6)).otherwise(0.0)
            c = (((0.05 * d * z - 5.0) * z - 7.0) * z - 2.0) * z + b + c
            power = ((1.0 / (((n + 6.0) / (n * y) - 0.089 * d - 0.822) * (n + 2.0) * 3.0) + 0.5 / (n + 4.0)) * y - 1.0) * (
                n + 1.0) / (n + 2.0) + 1.0 / y
            return F.sqrt(n * F.when(y > a + 0.05, about_normal(c)).otherwise(power))

        return bound(F.struct(a.alias("a"), b.alias("b"), c0.alias("c"), d.alias("d"),
                              F.pow(d * alpha, 2.0 / n).alias("y")), of)

    def newton(t: Column, n: Column) -> Column:
        return bound(t, lambda t: t + (two_sided_p(t, n) - alpha) / _density(t, n))

    def found(n: Column) -> Column:
        return newton(newton(newton(start(n), n), n), n)

    exact = {1: 1 / math.tan(alpha * math.pi / 2), 2: (2 / (alpha * (2 - alpha)) - 2) ** 0.5}
    n = as_col(dof).cast("bigint")
    return F.when(n == 1, F.lit(exact[1])).when(n == 2, F.lit(exact[2])).when(n >= 3, bound(n.cast("double"), found))
