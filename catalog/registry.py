"""Where queries and the SQL that checks them are registered together."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions.numeric import round_half_up

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``oracle`` only its rows are looked at."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def rounded(df: DataFrame, digits: int = 4, skip: tuple[str, ...] = ()) -> DataFrame:
    """Round every double of a result, so that the last bits of a sum or root
    do not decide whether two engines agree."""
    return df.select(*[
        round_half_up(F.col(f"`{c}`"), digits).alias(c) if t == "double" and c not in skip else F.col(f"`{c}`")
        for c, t in df.dtypes
    ])
