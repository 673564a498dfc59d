"""Row filters and code mapping used while staging raw tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.classify import lookup
from panelkit.functions.text import fold_accents, tidy


def _normal(name: str, ignore_case: bool) -> Column:
    text = tidy(name)
    return F.lower(text) if ignore_case else text


def keep_levels(df: DataFrame, levels: Mapping[str, Sequence[str]], ignore_case: bool = False) -> DataFrame:
    """Keep rows whose trimmed text is listed, for every given column."""
    for name, values in levels.items():
        wanted = [v.lower() for v in values] if ignore_case else values
        df = df.where(_normal(name, ignore_case).isin(*wanted))
    return df


def drop_levels(df: DataFrame, levels: Mapping[str, Sequence[str]], ignore_case: bool = False) -> DataFrame:
    """Drop rows whose trimmed text is listed; a missing text is dropped too, as NOT IN does."""
    for name, values in levels.items():
        unwanted = [v.lower() for v in values] if ignore_case else values
        df = df.where(~_normal(name, ignore_case).isin(*unwanted))
    return df


def drop_incomplete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows where all the given columns are present."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


def map_code(df: DataFrame, source: str, target: str, codes: Mapping[str, str] | DataFrame,
             default: str | None = None) -> DataFrame:
    """Look up the code of a trimmed name.

    A mapping becomes a literal inside the projection. A two-column frame
    (name, code) is joined; repeated names are merged first so that rows never
    fan out, and Spark broadcasts the frame only if it measures it as small.
    """
    if not isinstance(codes, DataFrame):
        return df.withColumn(target, lookup(tidy(source), codes, default))
    name, code = codes.columns
    dim = codes.groupBy(tidy(name).alias("_name")).agg(F.min(code).alias(target))
    out = df.join(dim, tidy(df[source]) == dim["_name"], "left").drop("_name")
    return out if default is None else out.withColumn(target, F.coalesce(F.col(target), F.lit(default)))


def map_code_folded(df: DataFrame, source: str, target: str, aliases: DataFrame, min_matches: int = 0) -> DataFrame:
    """Look up a code by exact name, else by the name without accents.

    When fewer than ``min_matches`` rows find a code, the match is not trusted
    and every code is NULL. The number of matches is a scalar subquery.
    """
    name, code = aliases.columns
    exact = aliases.groupBy(F.col(name).alias("_exact")).agg(F.min(code).alias("_by_exact"))
    folded = aliases.groupBy(fold_accents(name).alias("_folded")).agg(F.min(code).alias("_by_folded"))
    out = (
        df.join(exact, df[source] == exact["_exact"], "left")
        .join(folded, fold_accents(df[source]) == folded["_folded"], "left")
        .withColumn(target, F.coalesce("_by_exact", "_by_folded"))
        .drop("_exact", "_by_exact", "_folded", "_by_folded")
    )
    if not min_matches:
        return out
    matches = out.select(F.count(target)).scalar()
    return out.withColumn(target, F.when(matches >= min_matches, F.col(target)))


def latest_period_rows(df: DataFrame, period: str) -> DataFrame:
    """Rows of the last period. The maximum is a scalar subquery, not a join."""
    return df.where(F.col(period) == df.select(F.max(period)).scalar())


def latest_flag(df: DataFrame, period: str, latest: str = "latest_period", flag: str = "is_latest") -> DataFrame:
    """Add the last period of the whole table and mark its rows, without a global window."""
    return df.withColumn(latest, df.select(F.max(period)).scalar()).withColumn(
        flag, F.coalesce(F.col(period) == F.col(latest), F.lit(False)))
