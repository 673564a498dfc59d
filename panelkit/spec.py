"""Names the roles that columns play in a panel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Window, WindowSpec


@dataclass(frozen=True)
class PanelSpec:
    """A panel holds one row per entity, period and category combination.

    ``series`` columns identify one time series, ``cross`` columns one
    cross-section (all entities at one period, within a category).
    """

    entity: str
    period: str
    value: str
    category: tuple[str, ...] = ()

    @property
    def series(self) -> tuple[str, ...]:
        return (self.entity, *self.category)

    @property
    def cross(self) -> tuple[str, ...]:
        return (self.period, *self.category)

    @property
    def key(self) -> tuple[str, ...]:
        return (*self.series, self.period)

    def over_time(self) -> WindowSpec:
        """Rows of one series in period order."""
        return Window.partitionBy(*self.series).orderBy(self.period)

    def frame(self, start: int, end: int) -> WindowSpec:
        """Row-counted frame around each point of a series."""
        return self.over_time().rowsBetween(start, end)

    def whole_series(self) -> WindowSpec:
        return Window.partitionBy(*self.series)

    def across(self) -> WindowSpec:
        return Window.partitionBy(*self.cross)
