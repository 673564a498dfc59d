"""Aggregates, pivots and stacking of panels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.classify import event_period
from panelkit.operators.hotgroups import exact_quantiles, pieces_for
from panelkit.operators.keys import join_keys
from panelkit.session import materialise
from panelkit.spec import PanelSpec


def stack_indicators(parts: Sequence[tuple[DataFrame, Mapping[str, str | Column], Mapping[str, object]]]) -> DataFrame:
    """Bring several panels to one schema and stack them.

    Each part is a frame, a mapping of output names to its columns, and
    constants. An output column that a part lacks is NULL there.
    """
    frames = []
    for df, mapping, constants in parts:
        picked = [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in mapping.items()]
        frames.append(df.select(*picked, *[F.lit(v).alias(name) for name, v in constants.items()]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def combine_strata(df: DataFrame, by: Sequence[str], measures: Sequence[str], strata: str = "strata") -> DataFrame:
    """Sum measures over the strata of a key and count the strata rows."""
    return df.groupBy(*by).agg(*[F.sum(m).alias(m) for m in measures], F.count(F.lit(1)).alias(strata))


def region_average(df: DataFrame, by: Sequence[str], value: str, out: str = "avg_value") -> DataFrame:
    """Mean per group, highest first."""
    return df.groupBy(*by).agg(F.avg(value).alias(out)).orderBy(F.col(out).desc())


def series_mean(df: DataFrame, period: str, value: str, out: str = "mean_value") -> DataFrame:
    """Several rows per period collapsed to their mean."""
    return df.groupBy(period).agg(F.avg(value).alias(out))


def pre_post(df: DataFrame, p: PanelSpec, rank: str, pre: tuple[int, int], post_from: int) -> DataFrame:
    """Mean value, mean rank and periods before and after an event, per series.

    One aggregate with conditions, so both sides come from one pass.
    """
    side = event_period(p.period, pre, post_from, ("none", "pre", "post"))
    aggs = []
    for name in ("pre", "post"):
        here = side == name
        aggs += [
            F.avg(F.when(here, F.col(p.value))).alias(f"{name}_avg"),
            F.avg(F.when(here, F.col(rank))).alias(f"{name}_rank"),
            F.count_if(here).alias(f"{name}_periods"),
        ]
    change = F.try_divide(F.col("post_avg") - F.col("pre_avg"), F.col("pre_avg")) * 100
    return df.groupBy(*p.series).agg(*aggs).withColumn("pct_change", change)


def peak_per_series(df: DataFrame, p: PanelSpec) -> DataFrame:
    """Highest value of each series and its first period, as an aggregate."""
    per_value = df.groupBy(*p.series, F.col(p.value).alias("peak_value")).agg(F.min(p.period).alias("peak_period"))
    best = F.max_by(F.struct("peak_value", "peak_period"), F.struct("peak_value"))
    return per_value.groupBy(*p.series).agg(best.alias("_b")).select(*p.series, "_b.*")


def pivot_heatmap(df: DataFrame, p: PanelSpec, periods: Sequence[int], prefix: str = "p") -> DataFrame:
    """Entity by period means, ordered by the last listed period.

    The periods are given, so no extra job has to collect them.
    """
    wide = df.groupBy(p.entity).pivot(p.period, list(periods)).agg(F.avg(p.value))
    wide = wide.select(p.entity, *[F.col(f"`{t}`").alias(f"{prefix}{t}") for t in periods])
    return wide.orderBy(F.col(f"{prefix}{periods[-1]}").asc_nulls_last())


def pivot_gap(df: DataFrame, p: PanelSpec, focus: str, benchmark: str) -> DataFrame:
    """Focus and benchmark value side by side per period, and their gap."""
    def value_of(name: str) -> Column:
        return F.max(F.when(F.col(p.entity) == name, F.col(p.value)))

    out = df.where(F.col(p.entity).isin(focus, benchmark)).groupBy(*p.cross).agg(
        value_of(focus).alias("focus_value"), value_of(benchmark).alias("benchmark_value"))
    return out.withColumn("gap", F.col("focus_value") - F.col("benchmark_value"))


def coverage(df: DataFrame, p: PanelSpec, optional: Sequence[str] = ()) -> DataFrame:
    """Rows and distinct periods of each series, and which optional columns hold any value."""
    return df.groupBy(*p.series).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(p.period).alias("n_periods"),
        F.min(p.period).alias("first_period"),
        F.max(p.period).alias("last_period"),
        *[F.bool_or(F.col(c).isNotNull()).alias(f"has_{c}") for c in optional],
    )


def coverage_grid(df: DataFrame, p: PanelSpec) -> DataFrame:
    """The distinct entity and period combinations that hold data."""
    return df.select(p.entity, p.period).distinct()


def sorted_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column in order, as a selector shows them."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def level_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Frequency table of every level of several columns, in one pass over the rows."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in cols]))
    return df.select(pairs.alias("_l")).groupBy("_l.column", "_l.level").agg(F.count(F.lit(1)).alias("n"))


def profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Minimum, quartiles, mean, maximum and missing count of numeric columns, one row each.

    The plain measures are one aggregate over the columns as they are. For the
    quartiles the columns are unpivoted, so that all of them share one exact
    distributed pass.
    """
    measures = {"min": F.min, "mean": F.avg, "max": F.max, "n": F.count, "n_missing": lambda c: F.count_if(c.isNull())}
    values = [F.col(c).cast("double") for c in cols]
    wide = df.agg(*[fn(v).alias(f"{m}_{i}") for i, v in enumerate(values) for m, fn in measures.items()])
    basics = wide.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("place"), F.lit(c).alias("column"), *[F.col(f"{m}_{i}").alias(m) for m in measures])
        for i, c in enumerate(cols)])))

    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("place"), v.alias("v")) for i, v in enumerate(values)]))
    quartiles = exact_quantiles(df.select(pairs.alias("_p")).select("_p.*"), ["place"], "v", (0.25, 0.5, 0.75))
    by_column = quartiles.groupBy("place").agg(
        *[F.max(F.when(F.col("prob") == q, F.col("quantile"))).alias(name)
          for q, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    return basics.join(by_column, "place", "left").select(
        "column", "min", "q1", "median", "mean", "q3", "max", "n", "n_missing")


def box_stats(df: DataFrame, by: Sequence[str], value: str, strategy: str = "panel") -> DataFrame:
    """Five-number summary and 1.5 IQR fences per group.

    ``"panel"`` uses Spark's exact percentile, which holds the distinct values
    of one group in memory: right for series of a panel. ``"hot"`` takes the
    distributed quantiles for groups of any size.
    """
    probs, names = (0.0, 0.25, 0.5, 0.75, 1.0), ("low", "q1", "median", "q3", "high")
    if strategy == "panel":
        arrays = df.groupBy(*by).agg(F.percentile(value, [float(q) for q in probs]).alias("_q"))
        out = arrays.select(*by, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    else:
        long = exact_quantiles(df, by, value, probs)
        out = long.groupBy(*by).agg(
            *[F.max(F.when(F.col("prob") == q, F.col("quantile"))).alias(n) for q, n in zip(probs, names)])
    spread = (F.col("q3") - F.col("q1")) * 1.5
    return out.withColumns({"lower_fence": F.col("q1") - spread, "upper_fence": F.col("q3") + spread})


def ordered_list(df: DataFrame, by: Sequence[str], label: str, value: str, text: Column, separator: str = " | ",
                 out: str = "listing", strategy: str = "panel", pieces: int | None = None) -> DataFrame:
    """``label: text`` items of each group in one string, highest value first, missing values last.

    Equal values go by falling text, items without a text are left out. ``"panel"`` takes
    a group in one task: right for a reporting cell, whose items one line shows. ``"hot"``
    cuts the order of all rows into stretches, joins the items of a group inside each stretch,
    and then the stretches' strings, so that no task holds more than a stretch and one string.
    """
    groups = [F.col(c) for c in by]
    if strategy == "panel":
        item = F.struct(F.col(value).alias("v"), F.concat(F.col(label), F.lit(": "), text).alias("t"))
        items = F.sort_array(F.collect_list(item), asc=False)
        return df.groupBy(*groups).agg(F.concat_ws(separator, F.transform(items, lambda i: i["t"])).alias(out))
    rows = df.select(*groups, F.col(value).alias("_v"), F.concat(F.col(label), F.lit(": "), text).alias("_t"))
    order = [F.col("_v").desc_nulls_last(), F.col("_t").desc_nulls_last()]
    cut = materialise(rows.repartitionByRange(pieces or pieces_for(df), *[F.col(c) for c in by], *order).withColumn(
        "_stretch", F.spark_partition_id()), "stretches")
    # The rows of a group in a stretch are in one partition, so their items are as many as a stretch has at most.
    inside = F.sort_array(F.collect_list(F.struct(F.col("_v").alias("v"), F.col("_t").alias("t"))), asc=False)
    parts = cut.groupBy(*by, "_stretch").agg(F.transform(inside, lambda i: i["t"]).alias("_items")).select(
        *by, "_stretch", F.when(F.exists("_items", lambda t: t.isNotNull()), F.concat_ws(separator, "_items")).alias("_part"))
    whole = F.array_sort(F.collect_list(F.struct(F.col("_stretch").alias("s"), F.col("_part").alias("p"))))
    return parts.groupBy(*by).agg(F.concat_ws(separator, F.transform(whole, lambda x: x["p"])).alias(out))


def equal_width_bins(df: DataFrame, by: Sequence[str], value: str, n: int = 5, out: str = "bin") -> DataFrame:
    """Bins of one rounded width per group; the last bin is open.

    The width is a fifth (``1/n``) of the group's maximum, rounded half to
    even at its leading digit and at least one. A value outside every bin goes
    to the last, and so does a missing one. Group maxima are aggregated and joined back, so a hot group
    is combined before the shuffle.
    """
    top = df.groupBy(*by).agg(F.max(value).cast("double").alias("_max"))
    top = top.withColumn("_max", F.when(F.col("_max") <= 0, 1.0).otherwise(F.col("_max")))
    raw = F.col("_max") / n
    magnitude = F.pow(F.lit(10.0), F.length(F.floor(raw).cast("bigint").cast("string")) - 1)
    top = top.withColumn("bin_width", F.greatest(F.lit(1.0), F.bround(raw / magnitude, 0) * magnitude))
    rows = join_keys(df, top, by, "left")
    reached = reduce(lambda a, b: a + b, [(F.col(value) >= F.col("bin_width") * i).cast("int") for i in range(1, n)])
    return rows.withColumn(out, F.coalesce(F.when(F.col(value) < 0, n - 1).otherwise(reached), F.lit(n - 1)).cast("bigint")).drop("_max")
