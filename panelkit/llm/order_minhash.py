"""Near-duplicate documents by Order MinHash and banded alignment.

A document is its sequence of shingles of five words, each labelled with the number of
its earlier occurrences. For every one of some hash functions the few shingles
with the smallest hashes are taken in text order; their joint hash agrees for two
documents only if these shingles are shared and stand in the same order. Pairs of
such hashes are bands, and documents with an equal band are candidates.

Candidates are aligned: the longest common subsequence of their shingles, found
bit-parallel inside the band of diagonals that the wanted similarity allows,
over the length of the union. Documents are linked from 0.8 on. Classes are the
connected components of links.

Exact copies are merged first, and buckets with the same members. The texts of a
bucket are compared in cells of a bounded number of them; a larger bucket has a cell
for each pair of its blocks. In a cell the shingles that all pairs share are counted
by a product of 0-1 matrices, which bounds their similarity from above; only pairs that
can be similar and that no earlier link connects are aligned. A cell gives the links
that connect its texts, at most one a text, so no pairs are written out and no
connection is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.bytewords import ByteWords, mixed, seeds
from panelkit.llm.components import components
from panelkit.llm.workers import tidy
from panelkit.session import materialise

SHINGLE, SIMILARITY = 5, 0.8
# Smallest shingles a function takes, functions of a band, and bands. At similarity 0.8 a function agrees
# with probability 0.64, a band with 0.41, and no band with 3 in a million.
TAKEN, ROWS, BANDS = 2, 2, 24
# Hashes or matrix elements computed at once.
STEP = 1 << 21
# Texts and shingles of a block, and rows of a task's group of cells.
BLOCK, WEIGHT, GROUP = 512, 1 << 20, 2000

# Words are runs of ASCII letters and digits and of everything beyond ASCII, lower case.
WORDS = ByteWords(bytes(b for b in range(128) if not chr(b).isalnum()))


def word_hashes(text: str | None) -> np.ndarray:
    data = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), np.uint8)
    return WORDS.words(data)[0]


class OrderMinHash:
    """Shingles and bands of texts."""

    def __init__(self, shingle: int = SHINGLE, taken: int = TAKEN, rows: int = ROWS, bands: int = BANDS) -> None:
        self.shingle, self.taken, self.rows, self.bands = shingle, taken, rows, bands
        self.weights = seeds(shingle, 1 << 33) | np.uint64(1)
        self.functions = seeds(rows * bands, 1 << 34) | np.uint64(1)
        self.joints = seeds(max(taken, rows), 1 << 35) | np.uint64(1)
        self.band_seeds = seeds(bands, 1 << 36)

    def shingles(self, text: str | None) -> np.ndarray:
        """Hashes of the text's shingles in order; a shorter text is one shingle, one without words has none."""
        words = word_hashes(text)
        n = len(words) - self.shingle + 1
        if n < 1:
            return mixed((words * self.weights[:len(words)]).sum(dtype=np.uint64, keepdims=True)) if len(words) else words
        out = np.zeros(n, np.uint64)
        for i, w in enumerate(self.weights):
            out += words[i:n + i] * w
        return mixed(out)

    def labelled(self, shingles: np.ndarray) -> np.ndarray:
        """Shingles made distinct by the number of equal ones before them."""
        order = np.argsort(shingles, kind="stable")
        ordered = shingles[order]
        fresh = np.r_[True, ordered[1:] != ordered[:-1]]
        places = np.arange(len(ordered))
        earlier = np.empty(len(ordered), np.uint64)
        earlier[order] = places - np.maximum.accumulate(np.where(fresh, places, 0))
        return mixed(shingles + earlier * np.uint64(0x9E3779B97F4A7C15))

    def band_keys(self, text: str | None) -> list[int]:
        """The keys of all bands as signed 64-bit numbers; none for a text without words."""
        shingles = self.shingles(text)
        if not len(shingles):
            return []
        labelled = self.labelled(shingles)
        taken, many = min(self.taken, len(labelled)), len(self.functions)
        joint = np.zeros(many, np.uint64)
        step = max(1, STEP // len(labelled))
        for at in range(0, many, step):
            values = labelled[None, :] * self.functions[at:at + step, None]
            rows = np.arange(len(values))
            picked = np.empty((len(values), taken), np.int64)
            for k in range(taken):
                picked[:, k] = values.argmin(axis=1)
                values[rows, picked[:, k]] = np.uint64(0xFFFFFFFFFFFFFFFF)
            picked.sort(axis=1)
            joint[at:at + step] = (labelled[picked] * self.joints[:taken]).sum(axis=1, dtype=np.uint64)
        bands = (mixed(joint).reshape(self.bands, self.rows) * self.joints[:self.rows]).sum(axis=1, dtype=np.uint64)
        return mixed(bands + self.band_seeds).view(np.int64).tolist()


def common_in_band(a: np.ndarray, b: np.ndarray, width: int) -> int:
    """Length of the longest common subsequence whose pairs lie within ``width`` diagonals of the main one.

    A bit per element of ``a`` inside the band: zeros are the steps of a row of
    the alignment table. Below the band nothing changes any more, above it all is one.
    """
    places: dict[int, list[int]] = {}
    for i, x in enumerate(a.tolist()):
        places.setdefault(x, []).append(i)
    size = 2 * width + 1
    full = (1 << size) - 1
    low, steps, common = -width, full, 0
    for j, y in enumerate(b.tolist()):
        at = places.get(y)
        if at is None:
            continue
        shift = j - width - low
        if shift:
            gone = steps & ((1 << shift) - 1) if shift < size else steps
            common += min(shift, size) - gone.bit_count()
            steps = (steps >> shift) | (full ^ (full >> shift)) if shift < size else full
            low += shift
        found = 0
        for i in at:
            if 0 <= i - low < size:
                found |= 1 << (i - low)
        moved = steps & found
        if moved:
            steps = ((steps + moved) | (steps - moved)) & full
    return common + size - steps.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Common shingles in order over the union, exact from ``least`` on and else some number below it."""
    if not len(a) or not len(b):
        return 0.0
    both = len(a) + len(b)
    need = int(np.ceil(least / (1 + least) * both - 1e-9))
    if min(len(a), len(b)) < need:
        return 0.0
    short = min(len(a), len(b))
    differs = np.flatnonzero(a[:short] != b[:short])
    head = int(differs[0]) if len(differs) else short
    differs = np.flatnonzero(a[::-1][:short - head] != b[::-1][:short - head])
    tail = int(differs[0]) if len(differs) else short - head
    common, a, b = head + tail, a[head:len(a) - tail], b[head:len(b) - tail]
    if len(a) and len(b):
        if common + np.isin(a, b).sum() < need:
            return 0.0
        common += common_in_band(a, b, both - 2 * need)
    return common / (both - common)


def copy_key(text: Column) -> Column:
    """What stands for a text: 96 bits of hash and its length."""
    raw = F.coalesce(text, F.lit(""))
    return F.concat_ws("-", F.hex(F.xxhash64(raw)), F.hex(F.hash(raw)), F.octet_length(raw).cast("string"))


def sketches(df: DataFrame, text: str = "text", maker: OrderMinHash | None = None) -> DataFrame:
    """Replace column ``text`` by ``n_shingles`` and ``bands`` (array of long)."""
    maker = maker or OrderMinHash()
    rest = [f for f in df.schema.fields if f.name != text]
    schema = T.StructType([*rest, T.StructField("n_shingles", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).to_pylist()
            keys = [maker.band_keys(x) for x in texts]
            sizes = [max(len(word_hashes(x)) - maker.shingle + 1, 1 if k else 0) for x, k in zip(texts, keys)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in rest), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], schema.names)
        tidy()

    return df.mapInArrow(run, schema)


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """The number of shared elements of all pairs of sets, by products of 0-1 matrices a stretch of elements at a time."""
    sizes = [len(x) for x in sets]
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, element, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often[element] > 1
    owner, (_, element) = owner[shared], np.unique(element[shared], return_inverse=True)
    order = np.argsort(element, kind="stable")
    owner, element = owner[order], element[order]
    counts = np.zeros((len(sets), len(sets)), np.float32)
    step = max(1, STEP // max(len(sets), 1))
    for first in range(0, int(element[-1]) + 1 if len(element) else 0, step):
        low, high = np.searchsorted(element, [first, first + step])
        held = np.zeros((len(sets), step), np.float32)
        held[owner[low:high], element[low:high] - first] = 1
        counts += held @ held.T
    return counts


def spanning_links(texts: list[np.ndarray], sets: list[np.ndarray], sides: list[int], least: float) -> list[tuple[int, int]]:
    """Links that connect whatever is connected by pairs of similar texts; with two sides, pairs across only.

    The share of labelled shingles in common is an upper bound of the
    similarity. Pairs that reach it are aligned, the likeliest first, unless
    earlier links connect them.
    """
    sizes = np.array([len(x) for x in sets])
    common = common_counts(sets)
    total = sizes[:, None] + sizes[None, :]
    good = np.triu(common >= np.ceil(least / (1 + least) * total - 1e-9), 1)
    if len(set(sides)) > 1:
        side = np.array(sides)
        good &= side[:, None] != side[None, :]
    first, second = np.nonzero(good)
    best = np.argsort(-(common[first, second] / (total[first, second] - common[first, second])), kind="stable")
    root, out = list(range(len(texts))), []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(first[best].tolist(), second[best].tolist()):
        x, y = find(i), find(j)
        if x != y and similarity(texts[i], texts[j], least) >= least:
            root[y] = x
            out.append((i, j))
    return out


def _linker(maker: OrderMinHash, least: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def of(rows: pd.DataFrame) -> pd.DataFrame:
        made: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for copy, text in zip(rows["copy"], rows["_text"]):
            if copy not in made:
                shingles = maker.shingles(text)
                made[copy] = shingles, maker.labelled(shingles)
        links = set()
        for _, cell in rows.groupby(["band", "low", "high"], sort=False):
            copies, sides = cell["copy"].tolist(), cell["side"].tolist()
            for i, j in spanning_links([made[c][0] for c in copies], [made[c][1] for c in copies], sides, least):
                links.add((min(copies[i], copies[j]), max(copies[i], copies[j])))
        made.clear()
        tidy()
        return pd.DataFrame(sorted(links), columns=["a", "b"])

    return of


def bucket_cells(buckets: DataFrame, block: int = BLOCK, weight: int = WEIGHT) -> DataFrame:
    """Rows ``band``, ``low``, ``high``, ``side`` and ``copy``: the texts to be compared in one cell.

    Buckets with the same members are one. A bucket of more than ``block`` texts, or with more
    than ``weight`` shingles, is cut into blocks by the hash of the text, and has a cell for
    each pair of blocks, so a cell is bounded whatever the bucket.
    """
    shared = buckets.groupBy("band").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight"), F.sum(F.xxhash64("copy").cast("decimal(38,0)")).alias("members"))
    shared = shared.where("size > 1").groupBy("size", "members", "weight").agg(F.min("band").alias("band"))
    blocks = F.greatest(F.ceil(F.col("size") / block), F.ceil(F.col("weight") / weight)).cast("int")
    entries = buckets.join(shared.select("band", blocks.alias("blocks")), "band").select(
        "band", "copy", "blocks", F.pmod(F.xxhash64("copy", "band"), F.col("blocks")).cast("int").alias("side"))
    spread = entries.select("band", "copy", "side", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return spread.select("band", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "copy")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = SIMILARITY,
                    maker: OrderMinHash | None = None) -> DataFrame:
    """One row per document: ``key``, ``class_id`` and ``kept``.

    ``class_id`` is the smallest key of the document's class, and ``kept`` is true
    for one row of each class, the one with the smallest key. Texts that are equal are
    one class; texts without words, null and empty ones included, have no other
    duplicates than equal ones (null counts as empty). Rows with a null key may
    be members; a class with null keys only has a null id. Equal rows are copies.
    """
    maker = maker or OrderMinHash()
    keyed = docs.select(F.col(f"`{key}`").alias("_key"), copy_key(F.col(f"`{text}`")).alias("copy"), F.col(f"`{text}`").alias("_text"))
    rows = materialise(sketches(keyed, "_text", maker).withColumn("_row", F.monotonically_increasing_id()), "sketches")
    # Copies are merged before their bands are spread; of equal texts all bands are equal.
    texts = rows.groupBy("copy").agg(F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    cells = materialise(bucket_cells(texts.select("copy", "n", F.explode("bands").alias("band"))), "cells")
    groups = max(1, cells.count() // GROUP)
    # Copies meet in their task first, so that the shuffle carries a text once a task at most.
    source = docs.select(copy_key(F.col(f"`{text}`")).alias("copy"), F.col(f"`{text}`").alias("_text")).groupBy("copy").agg(
        F.first("_text").alias("_text"))
    loaded = cells.join(source, "copy").withColumn("_group", F.pmod(F.xxhash64("band", "low", "high"), F.lit(groups)))
    links = loaded.groupBy("_group").applyInPandas(_linker(maker, least), "a string, b string")
    groups = components(materialise(links, "links"))

    place = F.struct(F.col("_key").isNull().alias("none"), F.col("_key").alias("key"), F.col("_row").alias("row"))
    per_text = rows.groupBy("copy").agg(F.min(place).alias("_first"))
    per_text = per_text.join(groups, per_text.copy == groups.node, "left").select(
        "copy", "_first", F.coalesce("component", "copy").alias("component"))
    per_class = per_text.groupBy("component").agg(F.min("_first").alias("_first"))
    named = per_text.select("copy", "component").join(per_class, "component").select("copy", "_first")
    return rows.select("_key", "copy", "_row").join(named, "copy").select(
        F.col("_key").alias(key), F.col("_first.key").alias("class_id"),
        (F.col("_row") == F.col("_first.row")).alias("kept"))
