"""Labels derived from numbers. Every function returns a Column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelkit.functions.numeric import as_col

# Cut points and labels of the severity bands.
SEVERITY_4 = ((2.0, "Crisis Level"), (1.5, "Severely Elevated"), (1.0, "Above National"))
SEVERITY_5 = ((5.0, "Extreme"), *SEVERITY_4)
BELOW = "Below National"


def trend_direction(delta: Column | str, unknown: str | None = "Stable") -> Column:
    """Sign of a change in words. A missing change is ``unknown``."""
    delta = as_col(delta)
    return (
        F.when(delta.isNull(), F.lit(unknown))
        .when(delta > 0, "Increasing")
        .when(delta < 0, "Decreasing")
        .otherwise("Stable")
    )


def ci_comparison(value: Column | str, lower: Column | str, upper: Column | str, benchmark: Column | str,
                  unknown: str | None = "At National Rate") -> Column:
    """Position of a value against a benchmark and its confidence interval.

    The interval is tested before the benchmark on each side. ``unknown`` is
    the answer when value or benchmark is missing and no bound decides.
    """
    value, lower, upper, benchmark = map(as_col, (value, lower, upper, benchmark))
    undecided = value.isNull() | benchmark.isNull()
    return (
        F.when(value > upper, "Significantly Above National")
        .when(value > benchmark, "Above National")
        .when(value < lower, "Significantly Below National")
        .when(value < benchmark, "Below National")
        .when(undecided, F.lit(unknown))
        .otherwise("At National Rate")
    )


def bands(c: Column | str, cuts: Sequence[tuple[float, str]], below: str | None = None) -> Column:
    """The label of the highest cut reached; ``below`` under all cuts; NULL stays NULL."""
    c = as_col(c)
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for cut, label in sorted(cuts, reverse=True):
        out = out.when(c >= cut, label)
    return out.otherwise(F.lit(below))


def severity_band(ratio: Column | str, levels: int = 4) -> Column:
    return bands(ratio, {4: SEVERITY_4, 5: SEVERITY_5}[levels], BELOW)


def burden_category(rank: Column | str, high: int = 3, low: int = 11) -> Column:
    rank = as_col(rank)
    return F.when(rank <= high, "High Burden").when(rank >= low, "Low Burden").otherwise("Moderate Burden")


def outcome_rank(rank: Column | str, entities: Column | int) -> Column:
    """The rank counted from the other end, among ``entities`` ranked entities."""
    entities = F.lit(entities) if isinstance(entities, int) else entities
    return (entities + 1 - as_col(rank)).cast("bigint")


def event_period(period: Column | str, pre: tuple[int, int] = (2019, 2021), post_from: int = 2022,
                 labels: tuple[str, str, str] = ("Baseline", "Pre-Emergency", "Post-Emergency")) -> Column:
    """Side of an event on which a period lies."""
    period = as_col(period)
    baseline, before, after = labels
    return F.when(period.between(*pre), before).when(period >= post_from, after).otherwise(baseline)


def is_after_event(period: Column | str, post_from: int = 2022) -> Column:
    return F.coalesce(as_col(period) >= post_from, F.lit(False))


def outbreak_status(signal: Column | str, z: Column | str, severe: float = 3.0, elevated: float = 1.0) -> Column:
    signal, z = F.coalesce(as_col(signal), F.lit(False)), as_col(z)
    return (
        F.when(signal & (z >= severe), "Severe Outbreak")
        .when(signal, "Outbreak Detected")
        .when(z >= elevated, "Elevated")
        .otherwise("Normal Range")
    )


def lookup(c: Column | str, mapping: Mapping[str, str], default: Column | str | None = None) -> Column:
    """Value of ``c`` in a small fixed mapping, without a join."""
    c = as_col(c)
    pairs = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    found = F.try_element_at(pairs, c)
    if default is None:
        return found
    return F.coalesce(found, default if isinstance(default, Column) else F.lit(default))


def groups_of(mapping: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """Turn ``{group: members}`` into ``{member: group}``."""
    return {member: group for group, members in mapping.items() for member in members}


def traffic_light(comparison: Column | str) -> Column:
    """red, yellow or green from the words of a comparison; green when missing."""
    text = F.lower(F.coalesce(as_col(comparison), F.lit("")))
    return (
        F.when(text.contains("significantly above") | text.contains("crisis"), "red")
        .when(text.contains("above") | text.contains("elevated"), "yellow")
        .otherwise("green")
    )


def alarm_light(status: Column | str) -> Column:
    """The light for an outbreak status."""
    return F.coalesce(
        lookup(status, {"Severe Outbreak": "red", "Outbreak Detected": "red", "Elevated": "yellow"}), F.lit("green"))


def light_label(light: Column | str) -> Column:
    return lookup(light, {"red": "Needs Attention", "yellow": "Monitor", "green": "On Track"})


def gap_narrative(gap: Column | str, large: float = 100.0) -> Column:
    """Words for a gap to the benchmark."""
    gap = as_col(gap)
    return F.when(gap > large, "substantially above").when(gap > 0, "above").otherwise("at or below")


def flag_in(c: Column | str, values: Sequence[str]) -> Column:
    """Membership flag that is false, not NULL, for a missing value."""
    return F.coalesce(as_col(c).isin(*values), F.lit(False))
