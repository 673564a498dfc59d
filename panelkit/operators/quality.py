"""Declarative data-quality checks: failing rows, and a count per check.

Conditions are plain predicates, so that looking for failing rows pushes them
to the scan. A condition that is NULL does not fail.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str

    @property
    def name(self) -> str:
        return f"not_null:{self.table}.{self.column}"

    def broken(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class Accepted:
    """Values outside the list fail; a missing value passes."""

    table: str
    column: str
    values: tuple

    @property
    def name(self) -> str:
        return f"accepted:{self.table}.{self.column}"

    def broken(self) -> Column:
        return ~F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class InRange:
    """Values below ``low`` or above ``high`` fail, among the rows selected by ``where``."""

    table: str
    column: str
    low: float | None = None
    high: float | None = None
    where: str = "true"

    @property
    def name(self) -> str:
        return f"range:{self.table}.{self.column}"

    def broken(self) -> Column:
        c, bounds = F.col(self.column), []
        if self.low is not None:
            bounds.append(c < self.low)
        if self.high is not None:
            bounds.append(c > self.high)
        out = reduce(lambda a, b: a | b, bounds, F.lit(False)) if len(bounds) != 1 else bounds[0]
        return out if self.where == "true" else F.expr(self.where) & out


@dataclass(frozen=True)
class Unique:
    table: str
    columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"unique:{self.table}.{','.join(self.columns)}"

    def failing(self, df: DataFrame) -> DataFrame:
        present = df.dropna(subset=list(self.columns))
        return present.groupBy(*self.columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@dataclass(frozen=True)
class Present:
    """At least one row satisfies ``where``."""

    table: str
    where: str = "true"

    @property
    def name(self) -> str:
        return f"present:{self.table}"

    def failing(self, df: DataFrame) -> DataFrame:
        return df.agg(F.count_if(F.expr(self.where)).alias("n")).where("n = 0")


@dataclass(frozen=True)
class ExactlyOne:
    """Exactly one row satisfies ``where``."""

    table: str
    where: str

    @property
    def name(self) -> str:
        return f"exactly_one:{self.table}"

    def failing(self, df: DataFrame) -> DataFrame:
        return df.agg(F.count_if(F.expr(self.where)).alias("n")).where("n <> 1")


RowCheck = (NotNull, Accepted, InRange)
Check = NotNull | Accepted | InRange | Unique | Present | ExactlyOne


def failing_rows(tables: Mapping[str, DataFrame], check: Check) -> DataFrame:
    """The rows, keys or counts that break one check; empty when it passes."""
    df = tables[check.table]
    return df.where(check.broken()) if isinstance(check, RowCheck) else check.failing(df)


def measured(check: Check) -> Column:
    """The failures of a check that needs no grouping, as an aggregate: it can be summed up while rows are written."""
    if isinstance(check, RowCheck):
        return F.count_if(check.broken())
    n = F.count_if(F.expr(check.where))
    return (n == 0 if isinstance(check, Present) else n != 1).cast("bigint")


def _scalar_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Failures of all checks of one table that need no grouping, in a single pass."""
    counts = df.agg(*[measured(c).alias(f"c{i}") for i, c in enumerate(checks)])
    pairs = [F.struct(F.lit(c.name).alias("check"), F.col(f"c{i}").alias("failures")) for i, c in enumerate(checks)]
    return counts.select(F.inline(F.array(*pairs)))


def row_check_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Failures of all row checks of one table, counted in a single pass."""
    return _scalar_counts(df, checks)


def unique_counts(df: DataFrame, checks: Sequence[Unique]) -> DataFrame:
    """Failures of all key checks of one table: one pass, with a grouping set for every key."""
    columns = list(dict.fromkeys(c for check in checks for c in check.columns))
    sets = list(dict.fromkeys(tuple(sorted(check.columns, key=columns.index)) for check in checks))
    n, which = "_n", "_set"
    counted = df.select(*[F.col(c) for c in columns]).groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(
        F.count(F.lit(1)).alias(n), F.grouping_id().alias(which)).where(F.col(n) > 1)

    def twice(check: Unique) -> Column:
        # A column that a set leaves out has its bit, the first column the highest.
        number = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in check.columns)
        return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in check.columns], F.col(which) == number)

    totals = counted.agg(*[F.count_if(twice(c)).alias(f"c{i}") for i, c in enumerate(checks)])
    pairs = [F.struct(F.lit(c.name).alias("check"), F.col(f"c{i}").alias("failures")) for i, c in enumerate(checks)]
    return totals.select(F.inline(F.array(*pairs)))


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check with its number of failures. A check of a table that is not given is an error.

    A table is read once for all checks of rows, and once more for all keys.
    """
    if unknown := sorted({c.table for c in checks} - set(tables)):
        raise KeyError(f"checks of tables that are not given: {unknown}")
    if not checks:
        raise ValueError("no checks")
    parts = []
    for table, df in tables.items():
        own = [c for c in checks if c.table == table]
        keys = [c for c in own if isinstance(c, Unique)]
        if scalars := [c for c in own if not isinstance(c, Unique)]:
            parts.append(_scalar_counts(df, scalars))
        if keys:
            parts.append(unique_counts(df, keys))
    return reduce(lambda a, b: a.unionByName(b), parts)
