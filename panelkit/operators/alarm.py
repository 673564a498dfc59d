"""Control-chart alarms on a series."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from panelkit.functions.numeric import round_half_up
from panelkit.spec import PanelSpec


def _frame(p: PanelSpec, width: int, baseline: str) -> WindowSpec:
    if baseline == "central":
        return p.frame(-(width // 2), width // 2)
    if baseline == "trailing":
        return p.frame(-width, -1)
    raise ValueError("baseline must be 'central' or 'trailing'")


def baseline_stats(p: PanelSpec, width: int = 5, baseline: str = "central") -> tuple[Column, Column, Column]:
    """Mean, population standard deviation and number of values of the baseline."""
    w = _frame(p, width, baseline)
    return F.avg(p.value).over(w), F.stddev_pop(p.value).over(w), F.count(p.value).over(w)


def outbreak_threshold(p: PanelSpec, width: int = 5, k: float = 2.0, baseline: str = "central") -> Column:
    """The line a value has to exceed: mean plus ``k`` standard deviations."""
    mean, sd, _ = baseline_stats(p, width, baseline)
    return mean + F.lit(float(k)) * sd


def outbreak_signal(p: PanelSpec, width: int = 5, k: float = 2.0, baseline: str = "central",
                    min_points: int | None = None) -> Column:
    """True where the value exceeds the threshold.

    The central baseline contains the tested point, which bounds its z-score
    by sqrt(width - 1): with the usual width 5 and k 2 the alarm cannot fire.
    The trailing baseline compares with the ``width`` rows before the point
    and needs ``min_points`` of them (by default all).
    """
    mean, sd, n = baseline_stats(p, width, baseline)
    raised = F.col(p.value) > mean + F.lit(float(k)) * sd
    needed = min_points if min_points is not None else (width if baseline == "trailing" else 0)
    if needed:
        raised = raised & (n >= needed)
    return F.coalesce(raised, F.lit(False))


def outbreak_zscore(p: PanelSpec, width: int = 5, baseline: str = "central", digits: int = 2) -> Column:
    """Standard deviations above the baseline mean; zero where the baseline is flat."""
    mean, sd, _ = baseline_stats(p, width, baseline)
    return F.when(sd > 0, round_half_up((F.col(p.value) - mean) / sd, digits)).otherwise(F.lit(0.0))
