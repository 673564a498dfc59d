"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the cores, BENCH_RUNS the warm
runs per query (their median is reported), BENCH_QUERIES a list of queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import catalog
from panelkit.session import build_session

HEADLINE = (
    "panel_enriched", "yoy_change", "rolling_central_long", "rank_desc_wide", "benchmark_gap", "benchmark_ratio",
    "population_link", "pre_post", "profile", "box_stats_hot", "coverage_grid", "combine_strata", "stack_indicators",
    "stage_levels", "stage_two_sources", "outbreak_signal", "surveillance_enriched", "mart_comparison", "mart_harms",
    "mart_surveillance", "focus_overview", "forecast_linear", "forecast_arima", "trend_test", "forecast_auto",
    "dq_unique", "dq_range", "status_table", "ols_lines",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", spark_sql_shuffle_partitions=cpus if cpus != "*" else "8",
                          spark_ui_enabled="false", spark_driver_memory=os.environ.get("BENCH_MEMORY", "16g"))
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total of median warm query times", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
