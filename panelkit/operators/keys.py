"""Joins on keys that may be NULL."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL equals NULL, keeping the keys of ``left``.

    Spark plans the null-safe comparison as an equi-join, so a NULL group is a
    group like any other, as it is for windows and aggregates.
    """
    names = {k: f"_right_{k}" for k in keys}
    side = right.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in right.columns])
    same = reduce(Column.__and__, [F.col(f"`{k}`").eqNullSafe(F.col(f"`{n}`")) for k, n in names.items()], F.lit(True))
    return left.join(side, same, how).drop(*names.values())
