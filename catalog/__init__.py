"""The registered queries."""

from catalog import alarm_queries, forecast_queries, io_queries, mart_queries, panel_queries, shape_queries, text_queries  # noqa: F401
from catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
