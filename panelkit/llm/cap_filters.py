"""Near-duplicate vectors by spherical-cap filters.

Directions come from a random product code: a random rotation, a few blocks of
coordinates, and a random codebook of unit vectors per block; a direction is one
codeword per block. A vector is decoded to all directions whose inner product with it
exceeds a threshold: blocks are taken one by one, and a partial sum goes on
only while the best rest could still reach it. Vectors that share a direction are
candidates, and their cosine is computed in double precision.

The number of directions grows with the number of vectors of a label, so that a
vector meets a bounded number of others by chance. The threshold follows from it;
a vector that exceeds fewer than ``FILTERS`` directions is decoded again at lower
steps of it, so that each has that many. Vectors at cosine 0.98 share about half of
theirs. Equal vectors are merged first, and counted as links of each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.components import components
from panelkit.session import materialise

COSINE = 0.98
# Directions a vector exceeds at least, directions per vector of a label, and blocks of a direction.
FILTERS, SPREAD, BLOCKS = 16, 64, 3
# By what share of its standard deviation the threshold is lowered for vectors with too few directions.
LOWER = 0.25


class ProductCode:
    """Random directions and the decoding of vectors to those they exceed."""

    def __init__(self, dims: int, vectors: int, filters: int = FILTERS, spread: int = SPREAD, blocks: int = BLOCKS, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.rotation = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
        blocks = min(blocks, dims)
        self.cuts = np.linspace(0, dims, blocks + 1).astype(int)
        self.words = max(8, int(np.ceil((vectors * spread) ** (1 / blocks))))
        self.books = []
        for a, b in zip(self.cuts, self.cuts[1:]):
            book = rng.standard_normal((self.words, b - a))
            self.books.append(book / np.linalg.norm(book, axis=1, keepdims=True) * np.sqrt((b - a) / dims))
        # Inner products with a unit vector have this standard deviation, whatever the vector.
        self.spacing = LOWER / np.sqrt(dims)
        self.filters = min(filters, self.words ** blocks)
        self.threshold = NormalDist().inv_cdf(1 - min(0.4, 2 * self.filters / self.words ** blocks)) / np.sqrt(dims)

    def decode(self, vectors: np.ndarray) -> list[np.ndarray]:
        """The numbers of the directions that every unit vector exceeds, at the highest step that gives enough."""
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(vectors)
        places, threshold = np.arange(len(vectors)), self.threshold
        while len(places):
            found = self.exceeded(vectors[places], threshold)
            for i, names in zip(places.tolist(), found):
                out[i] = names
            places = places[[len(names) < self.filters for names in found]]
            threshold -= self.spacing
        return out

    def exceeded(self, vectors: np.ndarray, threshold: float) -> list[np.ndarray]:
        turned = vectors @ self.rotation
        scores = [turned[:, a:b] @ book.T for a, b, book in zip(self.cuts, self.cuts[1:], self.books)]
        best = np.stack([s.max(axis=1) for s in scores], axis=1)
        # The most that the blocks behind each block can add.
        rest = np.c_[np.cumsum(best[:, ::-1], axis=1)[:, ::-1][:, 1:], np.zeros(len(vectors))]
        out = []
        for i in range(len(vectors)):
            names, sums = np.zeros(1, np.int64), np.zeros(1)
            for k, block in enumerate(scores):
                floor = threshold - rest[i, k]
                words = np.flatnonzero(block[i] >= floor - sums.max(initial=-np.inf))
                total = sums[:, None] + block[i][words][None, :]
                above = total >= floor
                names = (names[:, None] * self.words + words[None, :])[above]
                sums = total[above]
            out.append(names)
        return out


def unit_vectors(lists: pa.Array | list) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of one length as rows of length 1, and which of the given ones they are.

    Null, empty and zero vectors and those with a null or non-finite component are left out.
    """
    kept, rows = [], []
    for i, x in enumerate(lists):
        if x is None or not len(x):
            continue
        v = np.array(x, dtype=float)
        peak = np.abs(v).max() if np.isfinite(v).all() else 0.0
        if peak > 0:
            v = v / peak
            kept.append(i)
            rows.append(v / np.sqrt(v @ v))
    return np.array(rows), np.array(kept, np.int64)


def usable(vector: Column) -> Column:
    """Whether a vector can have links."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & ok & F.exists(vector, lambda x: x != 0), F.lit(False))


def cosine(a: Column, b: Column) -> Column:
    """The cosine of two arrays, in double precision."""
    @F.pandas_udf(T.DoubleType())
    def of(left: pd.Series, right: pd.Series) -> pd.Series:
        out = np.zeros(len(left))
        pairs = [(i, x, y) for i, (x, y) in enumerate(zip(left, right)) if len(x) == len(y)]
        for size in {len(x) for _, x, _ in pairs}:
            at, xs, ys = zip(*[p for p in pairs if len(p[1]) == size])
            x, y = np.stack(xs).astype(float), np.stack(ys).astype(float)
            x, y = x / np.abs(x).max(axis=1, keepdims=True), y / np.abs(y).max(axis=1, keepdims=True)
            dot = np.einsum("ij,ij->i", x, y)
            out[list(at)] = dot / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))
        return pd.Series(out)

    return of(a, b)


def directions(vectors: DataFrame, codes: dict[int, ProductCode], vector: str, out: str = "direction") -> DataFrame:
    """One row per vector and direction it exceeds, in place of the vector; ``codes`` by dimension."""
    rest = [f for f in vectors.schema.fields if f.name != vector]
    schema = T.StructType([*rest, T.StructField(out, T.LongType())])
    shared = vectors.sparkSession.sparkContext.broadcast(codes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(vector).to_pylist()
            by_size: dict[int, list[int]] = {}
            for i, x in enumerate(lists):
                by_size.setdefault(len(x), []).append(i)
            for size, places in by_size.items():
                for at in range(0, len(places), 512):
                    some = places[at:at + 512]
                    units, kept = unit_vectors([lists[i] for i in some])
                    if not len(kept):
                        continue
                    names = shared.value[size].decode(units)
                    row = np.repeat(np.array(some)[kept], [len(x) for x in names])
                    part = batch.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in rest), pa.array(np.concatenate(names))], schema.names)

    return vectors.mapInArrow(run, schema)


def similar_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = COSINE,
                    filters: int = FILTERS, spread: int = SPREAD) -> DataFrame:
    """One row per vector: ``key``, ``n_links``, ``component_id`` and ``kept``.

    Vectors are compared when their labels are equal and not null and their
    lengths agree. Links join vectors with a cosine of at least ``least``;
    ``n_links`` counts the other vectors linked directly, ``component_id`` is the
    smallest key that can be reached, ``kept`` says that it is the vector's own.
    Vectors that are null, empty or zero, or hold null or non-finite components, have no
    links; nor have those with a null label. Keys are unique; a row that
    repeats a key counts as another vector. An empty frame stays empty.
    """
    rows = materialise(df.select(
        F.col(f"`{key}`").alias("_key"), F.col(f"`{vector}`").alias("_vector"), F.col(f"`{label}`").alias("_label")
    ).withColumn("_node", F.when(F.col("_label").isNotNull() & usable(F.col("_vector")), F.concat_ws(
        "-", F.col("_label").cast("string"), F.md5(F.to_json(F.struct("_vector")).cast("binary"))))), "vectors")
    live = rows.where(F.col("_node").isNotNull())
    nodes = live.groupBy("_node").agg(F.first("_label").alias("_label"), F.first("_vector").alias("_vector"),
                                      F.count(F.lit(1)).alias("_copies"), F.min("_key").alias("_least"))
    nodes = materialise(nodes, "nodes")
    # Only vectors of one label and length meet, so the largest such group sets the number of directions.
    many = nodes.groupBy("_label", F.size("_vector").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    codes = {r["size"]: ProductCode(r["size"], r["n"], filters, spread) for r in many.groupBy("size").agg(F.max("n").alias("n")).collect()}

    cells = directions(nodes.select("_node", "_label", F.size("_vector").alias("_size"), "_vector"), codes, "_vector")
    cells = materialise(cells, "cells")
    one, two = cells.alias("one"), cells.alias("two")
    same = reduce_and([F.col(f"one.{c}") == F.col(f"two.{c}") for c in ("direction", "_label", "_size")])
    pairs = one.join(two, same & (F.col("one._node") < F.col("two._node"))).select(
        F.col("one._node").alias("a"), F.col("two._node").alias("b")).distinct()
    ends = nodes.select("_node", "_vector")
    seen = pairs.join(ends.select(F.col("_node").alias("a"), F.col("_vector").alias("_left")), "a").join(
        ends.select(F.col("_node").alias("b"), F.col("_vector").alias("_right")), "b")
    links = materialise(seen.where(cosine(F.col("_left"), F.col("_right")) >= least).select("a", "b"), "links")

    copies = nodes.select(F.col("_node").alias("_other"), "_copies")
    degree = links.select(F.col("a").alias("_node"), F.col("b").alias("_other")).union(links.select("b", "a")).join(
        copies, "_other").groupBy("_node").agg(F.sum("_copies").alias("_far"))
    groups = components(links)
    known = nodes.select("_node", "_copies", "_least").join(degree, "_node", "left")
    known = known.join(groups, known._node == groups.node, "left").withColumn("_group", F.coalesce("component", "_node"))
    least_keys = known.groupBy("_group").agg(F.min("_least").alias("_id"))
    known = known.join(least_keys, "_group").select(
        "_node", (F.col("_copies") - 1 + F.coalesce("_far", F.lit(0))).cast("bigint").alias("n_links"), F.col("_id"))
    linked = live.select("_key", "_node").join(known, "_node").select("_key", "n_links", F.col("_id").alias("component_id"))
    alone = rows.where(F.col("_node").isNull()).select("_key", F.lit(0).cast("bigint").alias("n_links"), F.col("_key").alias("component_id"))
    return linked.union(alone).select(
        F.col("_key").alias(key), "n_links", "component_id", F.col("_key").eqNullSafe(F.col("component_id")).alias("kept"))


def reduce_and(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out
