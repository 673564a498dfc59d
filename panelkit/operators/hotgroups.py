"""Exact ranks, row frames and quantiles for groups too large for one task.

A window keeps one partition in one task. When a single period holds billions
of entities, or a single series billions of rows, the functions here give the
same answers from pieces:

1. rows are range-partitioned by group and order, so that every partition is
   one stretch of the global order, whatever the sizes of the groups; the
   partition number is written with the rows and thereby fixed;
2. the rows of each stretch are counted per group, and the counts of earlier
   stretches are summed (one row per group and stretch);
3. a position is that sum plus the place inside the stretch.

Sampling only decides where stretches begin. Nothing is dropped, capped or
approximated, and rows of a NULL group are kept. For ranks and quantiles equal values are merged with a count
first, combined before the shuffle, so a value shared by a third of the rows
travels as one row per map task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from panelkit.operators.keys import join_keys
from panelkit.session import materialise


# Bytes of input that one piece stands for.
PIECE_BYTES = 128 << 20


def pieces_for(df: DataFrame) -> int:
    """How many pieces a frame is cut into: one for each 128 MB of the files it reads, and
    at least as many as the session asks of a shuffle before adaptive merging.

    Sizes are those of the plan's leaves, since no estimate grows beyond them by a join.
    """
    conf = df.sparkSession.conf
    least = int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
                or conf.get("spark.sql.shuffle.partitions"))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    # Leaves that are not files have no size, for which Spark puts the largest number.
    return max(least, -(-sum(s for s in sizes if s < 1 << 60) // PIECE_BYTES))


def _stretches(df: DataFrame, by: Sequence[str], order: Column, pieces: int | None) -> DataFrame:
    """Range-partition by group and order; ``_stretch`` numbers the partitions in that order."""
    pieces = pieces or pieces_for(df)
    return df.repartitionByRange(pieces, *by, order).withColumn("_stretch", F.spark_partition_id())


def _earlier(by: Sequence[str]) -> WindowSpec:
    """Earlier stretches of the same group. One row per stretch, so partitions are small."""
    return Window.partitionBy(*by).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)


def _merged(df: DataFrame, by: Sequence[str], order: str, descending: bool, pieces: int | None) -> DataFrame:
    """Distinct values of each group with their counts ``n``, in written stretches. NULLs are left out."""
    values = df.where(F.col(order).isNotNull()).groupBy(*by, order).agg(F.count(F.lit(1)).alias("n"))
    step = F.col(order).desc() if descending else F.col(order).asc()
    return materialise(_stretches(values, by, step, pieces), "values")


def _offsets(values: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per group and stretch: its rows, and the rows of earlier stretches."""
    totals = values.groupBy(*by, "_stretch").agg(F.sum("n").alias("_total"))
    return totals.withColumn("_offset", F.coalesce(F.sum("_total").over(_earlier(by)), F.lit(0)))


def _before(by: Sequence[str], order: str, descending: bool = False) -> Column:
    """Rows of the group ahead of a value, given the offset of its stretch."""
    step = F.col(order).desc() if descending else F.col(order).asc()
    inside = Window.partitionBy(*by, "_stretch").orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    return F.col("_offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))


def counts_before(df: DataFrame, by: Sequence[str], order: str, descending: bool = False,
                  pieces: int | None = None) -> DataFrame:
    """Per distinct ``order`` value of a group: ``n`` rows holding it and
    ``before`` rows of the group that sort ahead of it. NULLs are left out.
    """
    values = _merged(df, by, order, descending, pieces)
    rows = join_keys(values, _offsets(values, by), [*by, "_stretch"])
    return rows.select(*by, order, "n", _before(by, order, descending).alias("before"))


def rank_desc_hot(df: DataFrame, by: Sequence[str], value: str, out: str = "rank", nulls: str = "first",
                  pieces: int | None = None) -> DataFrame:
    """The result of ``rank_desc`` without one task per cross-section."""
    ahead = counts_before(df, by, value, descending=True, pieces=pieces).drop("n")
    present = join_keys(df.where(F.col(value).isNotNull()), ahead, [*by, value])
    ranked = present.select(*df.columns, (F.col("before") + 1).cast("bigint").alias(out))

    missing = df.where(F.col(value).isNull())
    totals = df.groupBy(*by).agg(F.count(value).alias("_n"), (F.count(F.lit(1)) - F.count(value)).alias("_nulls"))
    if nulls == "first":
        ranked = join_keys(ranked, totals, by).withColumn(out, F.col(out) + F.col("_nulls")).select(*df.columns, out)
        missing = missing.withColumn(out, F.lit(1).cast("bigint"))
    else:
        missing = join_keys(missing, totals, by).select(*df.columns, (F.col("_n") + 1).cast("bigint").alias(out))
    return ranked.unionByName(missing)


# The low bits of a monotonically increasing id count the rows of a partition.
ROW_BITS = (1 << 33) - 1


def number_rows(df: DataFrame, series: Sequence[str], order: str, out: str = "row", pieces: int | None = None) -> DataFrame:
    """Number the rows of every series from zero in order; ``order`` is unique within a series."""
    placed = _stretches(df, series, F.col(order).asc(), pieces).sortWithinPartitions(*series, order)
    placed = materialise(placed.withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS))), "rows")
    parts = placed.groupBy(*series, "_stretch").agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
    shift = parts.select(*series, "_stretch", (
        F.coalesce(F.sum("_rows").over(_earlier(series)), F.lit(0)) - F.col("_first")).alias("_shift"))
    return join_keys(placed, shift, [*series, "_stretch"]).select(*df.columns, (F.col("_place") + F.col("_shift")).alias(out))


def over_long_series(df: DataFrame, series: Sequence[str], order: str, before: int, after: int,
                     measures: Callable[[WindowSpec], Mapping[str, Column]], rows_per_piece: int = 100_000,
                     pieces: int | None = None) -> DataFrame:
    """Evaluate row frames on series too long for one task.

    ``order`` is unique within a series. Rows are numbered, cut into pieces of
    ``rows_per_piece``, and each piece receives copies of the ``before`` rows
    ahead of it and the ``after`` rows behind it, so every frame is complete.
    ``measures`` gets the window spec, ordered, and returns the new columns;
    their frames must not reach beyond ``before`` and ``after``.
    """
    if max(before, after) > rows_per_piece:
        raise ValueError("a frame must not be longer than a piece")
    rows = number_rows(df, series, order, "_row", pieces)
    home = F.floor(F.col("_row") / rows_per_piece)
    place = F.col("_row") % rows_per_piece
    targets = F.array_compact(F.array(
        home,
        F.when(place < after, home - 1),
        F.when(place >= rows_per_piece - before, home + 1),
    ))
    copies = rows.select("*", home.alias("_home"), F.explode(targets).alias("_piece"))
    w = Window.partitionBy(*series, "_piece").orderBy("_row")
    new = measures(w)
    return copies.withColumns(dict(new)).where("_piece = _home").select(*df.columns, *new)


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float],
                    pieces: int | None = None) -> DataFrame:
    """Linear-interpolated quantiles of every group, one row per group and probability.

    The positions wanted are compared with the stretches first, and only the
    few stretches that hold one are sorted.
    """
    values = _merged(df, by, value, False, pieces)
    stretches = _offsets(values, by).withColumn("_size", F.sum("_total").over(Window.partitionBy(*by)))
    at = [(float(q), F.col("_size") * float(q) - float(q)) for q in probs]
    spots = F.array(*[F.struct(F.lit(q).alias("prob"), a.alias("at"), end(a).cast("bigint").alias("spot"))
                      for q, a in at for end in (F.floor, F.ceil)])

    def held(spots: Column, first: Column, rows: Column) -> Column:
        return F.filter(spots, lambda s: (s["spot"] >= first) & (s["spot"] < first + rows))

    wanted = stretches.select(*by, "_stretch", "_offset", held(spots, F.col("_offset"), F.col("_total")).alias("_spots"))
    rows = join_keys(values, wanted.where(F.size("_spots") > 0), [*by, "_stretch"])
    rows = rows.withColumn("_first", _before(by, value))
    rows = rows.select(*by, F.col(value).cast("double").alias("_v"),
                       F.explode(held(F.col("_spots"), F.col("_first"), F.col("n"))).alias("_s"))
    # Both ends of a probability: the lower spot holds the smaller value, the upper one the larger.
    ends = rows.groupBy(*by, F.col("_s.prob").alias("prob"), F.col("_s.at").alias("_at")).agg(
        F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    fraction = F.col("_at") - F.floor("_at")
    return ends.select(*by, "prob", (F.col("_low") + (F.col("_high") - F.col("_low")) * fraction).alias("quantile"))
