"""Indicator analytics over panels on Spark."""

from panelkit.operators.alarm import outbreak_signal, outbreak_threshold, outbreak_zscore
from panelkit.operators.clean import (
    drop_incomplete, drop_levels, keep_levels, latest_flag, latest_period_rows, map_code, map_code_folded,
)
from panelkit.operators.forecast import (
    bind_history, forecast_arima110, forecast_auto, forecast_compare, forecast_ets, forecast_linear, trend_test,
)
from panelkit.operators.hotgroups import counts_before, exact_quantiles, over_long_series, rank_desc_hot
from panelkit.operators.link import link_population, linked_flag
from panelkit.operators.quality import (
    Accepted, ExactlyOne, InRange, NotNull, Present, Unique, failing_rows, run_checks,
)
from panelkit.operators.regression import ols_coefficients
from panelkit.operators.shape import (
    box_stats, combine_strata, coverage, coverage_grid, equal_width_bins, level_counts, ordered_list, peak_per_series,
    pivot_gap, pivot_heatmap, pre_post, profile, region_average, series_mean, sorted_values, stack_indicators,
)
from panelkit.operators.windows import (
    attach_benchmark, convergence, latest_per_series, peak_period, previous_per_series, priority_dedup, rank_desc, rolling,
    series_stats, trajectory, yoy,
)
from panelkit.session import build_session, materialise
from panelkit.sources.csv import clean_column_names, filter_total_rows, null_out, read_csv_table
from panelkit.sources.tables import export_csv, read_table, write_table
from panelkit.spec import PanelSpec

__all__ = [name for name, value in list(globals().items()) if callable(value)]
