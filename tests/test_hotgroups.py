"""The split operators against brute force, with one group or value holding most rows."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelkit.operators import hotgroups as H
from panelkit.operators import shape
from panelkit.operators import windows as W
from panelkit.spec import PanelSpec


def skewed(n=3000, seed=3):
    """A third of the rows share one group and one value; some values are missing."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        group = "hot" if i % 3 == 0 else rnd.choice("abc")
        value = 7.5 if i % 3 == 1 else None if rnd.random() < 0.05 else round(rnd.lognormvariate(0, 2), 2)
        out.append((i, group, value))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(skewed(), "id int, g string, v double").cache()


@pytest.mark.parametrize("nulls", ["first", "last"])
@pytest.mark.parametrize("ranges", [None, 2, 64])
def test_rank_equals_window(frame, rows, nulls, ranges):
    plain = frame.withColumn("k", W.rank_desc(["g"], "v", nulls))
    split = H.rank_desc_hot(frame, ["g"], "v", "k", nulls, ranges)
    assert rows(split, "id", "k") == rows(plain, "id", "k")


@pytest.mark.parametrize("piece", [4, 37, 10_000])
def test_long_series_equals_window(frame, rows, piece):
    def measures(w):
        return {"prev": F.lag("v").over(w), "nxt": F.sum("v").over(w.rowsBetween(0, 3)), "n": F.count("v").over(w.rowsBetween(-4, 2))}

    from pyspark.sql import Window

    plain = frame.withColumns(measures(Window.partitionBy("g").orderBy("id")))
    split = H.over_long_series(frame, ["g"], "id", 4, 3, measures, rows_per_piece=piece)
    cols = ["id", "prev", "n", F.round("nxt", 6)]
    assert rows(split, *cols) == rows(plain, *cols)


def test_frame_longer_than_piece_is_refused(frame):
    with pytest.raises(ValueError):
        H.over_long_series(frame, ["g"], "id", 5, 0, lambda w: {}, rows_per_piece=4)


def test_long_series_by_timestamp(spark, rows):
    from pyspark.sql import Window

    df = spark.range(500).select(F.lit("a").alias("g"), F.timestamp_seconds(F.col("id") * 997 % 5003).alias("ts"), F.col("id").cast("double").alias("v"))
    def measures(w):
        return {"m": F.avg("v").over(w.rowsBetween(-2, 2))}
    plain = df.withColumns(measures(Window.partitionBy("g").orderBy("ts")))
    assert rows(H.over_long_series(df, ["g"], "ts", 2, 2, measures, 50, 16), "v", "m") == rows(plain, "v", "m")


def test_quantiles_equal_numpy(frame):
    pdf = frame.toPandas()
    got = {(r.g, r.prob): r.quantile for r in H.exact_quantiles(frame, ["g"], "v", (0.0, 0.1, 0.5, 0.99, 1.0)).collect()}
    for g, part in pdf.groupby("g"):
        for q in (0.0, 0.1, 0.5, 0.99, 1.0):
            assert got[g, q] == pytest.approx(np.quantile(part["v"].dropna(), q), abs=1e-9)


def test_quantiles_without_groups(frame):
    got = H.exact_quantiles(frame, [], "v", (0.25, 0.75)).toPandas().set_index("prob")["quantile"]
    values = frame.toPandas()["v"].dropna()
    assert got[0.25] == pytest.approx(values.quantile(0.25)) and got[0.75] == pytest.approx(values.quantile(0.75))


def test_profile_and_box(frame):
    row = shape.profile(frame, ["v", "id"]).where("column = 'v'").first()
    v = pd.Series([x[2] for x in skewed()], dtype=float)
    assert (row.n, row.n_missing) == (v.count(), v.isna().sum())
    assert (row["min"], row.median, row["max"]) == (v.min(), pytest.approx(v.median()), v.max())
    a = {tuple(map(str, r)) for r in shape.box_stats(frame, ["g"], "v").collect()}
    b = {tuple(map(str, r)) for r in shape.box_stats(frame, ["g"], "v", strategy="hot").collect()}
    assert a == b


def test_series_stats_strategies_agree(frame, rows):
    p = PanelSpec("g", "id", "v")
    cols = ["id", F.round("mean_rate", 9), "min_rate", "max_rate", "data_points"]
    assert rows(W.series_stats(frame, p), *cols) == rows(W.series_stats(frame, p, "join"), *cols)


@pytest.fixture(scope="module")
def with_nulls(spark):
    """Groups, series and values that are missing."""
    data = [(i, None if i % 4 == 0 else "a" if i % 4 == 1 else "b", None if i % 7 == 0 else float(i % 13)) for i in range(200)]
    return spark.createDataFrame(data, "id int, g string, v double").cache()


@pytest.mark.parametrize("nulls", ["first", "last"])
def test_null_group_keeps_its_ranks(with_nulls, rows, nulls):
    plain = with_nulls.withColumn("k", W.rank_desc(["g"], "v", nulls))
    assert rows(H.rank_desc_hot(with_nulls, ["g"], "v", "k", nulls, 3), "id", "k") == rows(plain, "id", "k")


def test_null_series_keeps_its_frames(with_nulls, rows):
    from pyspark.sql import Window

    def measures(w):
        return {"s": F.sum("v").over(w.rowsBetween(-2, 1))}

    plain = with_nulls.withColumns(measures(Window.partitionBy("g").orderBy("id")))
    assert rows(H.over_long_series(with_nulls, ["g"], "id", 2, 1, measures, rows_per_piece=9), "id", "s") == rows(plain, "id", "s")


def test_null_group_has_box_stats(with_nulls, rows):
    assert rows(shape.box_stats(with_nulls, ["g"], "v", "hot")) == rows(shape.box_stats(with_nulls, ["g"], "v"))


def test_join_forms_equal_window_forms_on_null_keys(with_nulls, rows):
    p = PanelSpec("g", "id", "v", ("c",))
    panel = with_nulls.withColumn("c", F.when(F.col("id") % 3 == 0, "x")).withColumn("id", F.col("id") % 10)
    for fn in (lambda s: W.attach_benchmark(panel, p, "a", {"v": "bm"}, s), lambda s: W.series_stats(panel, p, s)):
        cols = [F.round(F.col(c), 9) if c == "mean_rate" else F.col(c) for c in fn("window").columns]
        window, joined = fn("window"), fn("join")
        assert rows(joined, *cols) == rows(window, *cols)


def test_bins_of_a_null_group_and_of_null_values(with_nulls):
    got = shape.equal_width_bins(with_nulls, ["g"], "v").collect()
    assert len(got) == 200 and all(r.bin_width is not None for r in got)
    assert all(r.bin == 4 for r in got if r.v is None)
    assert {r.bin for r in got if r.g is None and r.v is not None} > {0, 1}


def test_pieces_grow_with_the_files(spark, monkeypatch):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_orderkey", "l_quantity")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert H.pieces_for(lines) == H.pieces_for(spark.range(5)) == least
    monkeypatch.setattr(H, "PIECE_BYTES", 1000)
    assert H.pieces_for(lines) > 10 * least
