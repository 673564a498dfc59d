"""Operators over panels: change, moving statistics, ranks, benchmarks.

Windows here run on panels that were aggregated first, so one partition holds
the periods of one series or the entities of one period. Where a single series
or cross-section is itself too large for one task, use the exact counterparts
in ``panelkit.operators.hotgroups``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.numeric import maybe_round, pct_change
from panelkit.operators.keys import join_keys
from panelkit.spec import PanelSpec


def yoy(df: DataFrame, p: PanelSpec, digits: int | None = None, pct_digits: int | None = None,
        guard: str = "positive", require_adjacent: bool = False) -> DataFrame:
    """Add ``prev_value``, ``yoy_change`` and ``yoy_pct_change``.

    The previous row of the series counts as the previous period, also across
    a gap. ``require_adjacent`` accepts it only when its period is one less.
    A series has one row per period; the order of rows that repeat one is arbitrary.
    """
    w = p.over_time()
    previous = F.lag(p.value).over(w)
    if require_adjacent:
        previous = F.when(F.lag(p.period).over(w) == F.col(p.period) - 1, previous)
    out = df.withColumn("prev_value", previous)
    return out.withColumns({
        "yoy_change": maybe_round(F.col(p.value) - F.col("prev_value"), digits),
        "yoy_pct_change": pct_change(p.value, "prev_value", pct_digits, guard),
    })


def rolling(p: PanelSpec, before: int, after: int, stat: str = "avg", digits: int | None = None) -> Column:
    """A moving statistic over ``before`` rows, the row itself and ``after`` rows.

    The frame shrinks at the ends of a series. ``stat`` is ``avg`` or
    ``stddev_pop``.
    """
    fn = {"avg": F.avg, "stddev_pop": F.stddev_pop}[stat]
    return maybe_round(fn(p.value).over(p.frame(-before, after)), digits)


def rank_desc(by: Sequence[str], value: str, nulls: str = "first") -> Column:
    """Rank 1 for the highest value; ties share a rank; NULLs come first or last."""
    order = {"first": F.col(value).desc_nulls_first(), "last": F.col(value).desc_nulls_last()}[nulls]
    return F.rank().over(Window.partitionBy(*by).orderBy(order)).cast("bigint")


def attach_benchmark(df: DataFrame, p: PanelSpec, benchmark: str, columns: Mapping[str, str],
                     strategy: str = "window") -> DataFrame:
    """Add columns of the benchmark entity's row of the same period and category.

    ``columns`` maps source columns to the names they get. ``"window"`` reads
    the panel once and shares its shuffle with a rank over the same keys;
    ``"join"`` filters the benchmark rows and joins them, which keeps a very
    large cross-section spread over many tasks.
    """
    is_benchmark = F.col(p.entity) == benchmark
    if strategy == "window":
        w = p.across()
        return df.withColumns({new: F.max(F.when(is_benchmark, F.col(old))).over(w) for old, new in columns.items()})
    if strategy != "join":
        raise ValueError("strategy must be 'window' or 'join'")
    side = df.where(is_benchmark).groupBy(*p.cross).agg(*[F.max(old).alias(new) for old, new in columns.items()])
    return join_keys(df, side, p.cross, "left")


def series_stats(df: DataFrame, p: PanelSpec, strategy: str = "window") -> DataFrame:
    """Add mean, minimum, maximum and number of points of each series.

    ``"join"`` aggregates before it shuffles and joins the small result back,
    for series too long for one task.
    """
    measures = {
        "mean_rate": F.avg(p.value), "min_rate": F.min(p.value),
        "max_rate": F.max(p.value), "data_points": F.count(F.lit(1)),
    }
    if strategy == "window":
        return df.withColumns({name: c.over(p.whole_series()) for name, c in measures.items()})
    stats = df.groupBy(*p.series).agg(*[c.alias(name) for name, c in measures.items()])
    return join_keys(df, stats, p.series, "left")


def peak_period(p: PanelSpec) -> Column:
    """The period of the highest value of the series; the first such period on a tie."""
    order = [F.col(p.value).desc_nulls_first(), F.col(p.period).asc()]
    w = Window.partitionBy(*p.series).orderBy(*order)
    return F.first(p.period).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def priority_dedup(df: DataFrame, keys: Sequence[str], source: str, priority: Sequence[str],
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """Keep one row per key, from the first listed source that has one.

    Spark limits each group to its best row before the shuffle, so a key with
    very many copies sends only one row per map task.
    """
    place = F.lit(len(priority))
    for i, name in reversed(list(enumerate(priority))):
        place = F.when(F.col(source) == name, i).otherwise(place)
    w = Window.partitionBy(*keys).orderBy(place, *tiebreak)
    return df.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place")


def latest_per_series(df: DataFrame, p: PanelSpec) -> DataFrame:
    """The last row of each series, as an aggregate rather than a sort."""
    others = [c for c in df.columns if c not in p.series]
    row = F.max_by(F.struct(*others), p.period)
    return df.groupBy(*p.series).agg(row.alias("_row")).select(*p.series, "_row.*").select(*df.columns)


def previous_per_series(df: DataFrame, p: PanelSpec) -> DataFrame:
    """The last row of each series together with the value of the row before it."""
    return latest_per_series(df.withColumn("prev_value", F.lag(p.value).over(p.over_time())), p)


def trajectory(df: DataFrame, p: PanelSpec) -> DataFrame:
    """First and last point of each series and the change between them."""
    ends = df.groupBy(*p.series).agg(
        F.min(p.period).alias("first_period"),
        F.min_by(p.value, p.period).alias("first_value"),
        F.max(p.period).alias("last_period"),
        F.max_by(p.value, p.period).alias("last_value"),
    )
    change = F.col("last_value") - F.col("first_value")
    pct = F.when(F.col("first_value") == 0, 0.0).otherwise(change / F.nullif("first_value", F.lit(0.0)) * 100)
    return ends.withColumns({"total_change": change, "total_pct_change": pct})


def convergence(df: DataFrame, p: PanelSpec, benchmark: str, absolute: bool = False,
                strategy: str = "window") -> DataFrame:
    """Gap to the benchmark series at the first and last common period.

    A falling signed gap counts as converging, also below the benchmark;
    ``absolute`` compares the size of the gaps instead. Fewer than two common
    periods give the label N/A.
    """
    merged = convergence_gaps(df, p, benchmark, strategy)
    ends = merged.groupBy(*p.series).agg(
        F.count(F.lit(1)).alias("common_periods"),
        F.min_by("gap", p.period).alias("gap_first"),
        F.max_by("gap", p.period).alias("gap_last"),
    )
    size = (lambda c: F.abs(F.col(c))) if absolute else F.col
    enough = F.col("common_periods") >= 2
    out = ends.withColumn("gap_change", F.when(enough, size("gap_last") - size("gap_first")))
    return out.withColumns({
        "gap_first": F.when(enough, F.col("gap_first")),
        "gap_last": F.when(enough, F.col("gap_last")),
        "label": F.when(~enough, "N/A").when(F.col("gap_change") < 0, "Converging").otherwise("Diverging"),
    })


def convergence_gaps(df: DataFrame, p: PanelSpec, benchmark: str, strategy: str = "window") -> DataFrame:
    """The gap at every period an entity shares with the benchmark."""
    with_bm = attach_benchmark(df, p, benchmark, {p.value: "benchmark"}, strategy)
    rows = with_bm.where((F.col(p.entity) != benchmark) & F.col("benchmark").isNotNull())
    return rows.withColumn("gap", F.col(p.value) - F.col("benchmark"))
