"""Joins to the population table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def link_population(df: DataFrame, population: DataFrame, on: Mapping[str, str], column: str = "population",
                    out: str = "population", only: Column | None = None) -> DataFrame:
    """Left join the population of the same entity and period.

    ``on`` maps columns of ``df`` to columns of ``population``. ``only``
    restricts the population rows first, for instance to the benchmark entity
    when only the period is matched. One row per key is guaranteed by an
    aggregate, so the join never multiplies rows; Spark broadcasts the result
    only when it measures it as small.
    """
    if only is not None:
        population = population.where(only)
    keys = {right: f"_key_{i}" for i, right in enumerate(on.values())}
    side = population.groupBy(*[F.col(r).alias(k) for r, k in keys.items()]).agg(F.max(column).alias(out))
    match = [df[left] == side[keys[right]] for left, right in on.items()]
    return df.join(side, match, "left").drop(*keys.values())


def linked_flag(column: str = "population") -> Column:
    return F.col(column).isNotNull()
