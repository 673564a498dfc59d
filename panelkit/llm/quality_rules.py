"""Quality of documents: fixed rules, then boosted trees over document statistics.

Statistics come from one pass over the whole texts, a row of numbers each. Trees
are fitted by the driver on at most ``SAMPLE`` labelled rows of numbers and go to
the tasks as arrays. The score may only fall with the share of symbols, repeated
words, repeated lines and bars, and with upper-case letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.boosted_trees import Forest, fit
from panelkit.llm.bytewords import ByteWords, seeds
from panelkit.llm.workers import tidy
from panelkit.session import materialise

# Labelled rows that the trees are fitted on, about.
SAMPLE = 20_000
WINDOW = 8
SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Statistics beside the counts, and whether the score may only rise (1) or fall (-1) in them.
FEATURES = {
    "log_words": 0, "mean_word_chars": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_word_share": -1,
    "distinct_word_share": 0, "upper_share": -1, "digit_share": 0, "bar_share": -1, "exclamation_share": -1,
    "stop_share": 0, "words_per_line": 0, "top_word_share": -1,
}


class Statistics:
    """Counts and features of single texts."""

    def __init__(self) -> None:
        self.words = ByteWords(SPACE)
        self.weights = seeds(WINDOW, 1 << 32) | np.uint64(1)

    def _repeated(self, hashes: np.ndarray) -> int:
        """Words in windows that occur twice or more."""
        n = len(hashes) - WINDOW + 1
        if n < 2:
            return 0
        windows = np.zeros(n, np.uint64)
        for i, w in enumerate(self.weights):
            windows += hashes[i:n + i] * w
        order = np.sort(windows)
        twice = np.unique(order[1:][order[1:] == order[:-1]])
        if not len(twice):
            return 0
        at = np.minimum(np.searchsorted(twice, windows), len(twice) - 1)
        change = np.zeros(len(hashes) + 1, np.int64)
        first = np.flatnonzero(twice[at] == windows)
        np.add.at(change, first, 1)
        np.add.at(change, first + WINDOW, -1)
        return int((change.cumsum() > 0).sum())

    def of(self, text: bytes | None) -> tuple[list[int], list[float]]:
        text = text or b""
        data = np.frombuffer(text, np.uint8)
        hashes, starts, _ = self.words.words(data)
        seen = np.bincount(data, minlength=256)
        spaces = int(seen[list(SPACE)].sum())
        points = len(data) - int(seen[0x80:0xC0].sum())
        n = len(hashes)
        lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
        counts = [n, points - spaces, int(seen[list(SYMBOLS)].sum()), len(lines) - len(set(lines)), self._repeated(hashes)]
        _, often = np.unique(hashes, return_counts=True)
        many, chars, rows = max(n, 1), max(counts[1], 1), max(len(lines), 1)
        upper = int(seen[65:91].sum())
        features = [
            float(np.log1p(n)), counts[1] / many, counts[2] / chars, counts[3] / rows, counts[4] / many,
            len(often) / many, upper / chars, int(seen[48:58].sum()) / chars, int(seen[124]) / many, int(seen[33]) / many,
            int(seen[46]) / many, n / rows, (int(often.max()) if n else 0) / many,
        ]
        return counts, features


def statistics(df: DataFrame, text: str = "text", features: str = "features") -> DataFrame:
    """Replace column ``text`` by the counts ``COUNTS`` and the array ``features``.

    Words are runs without ASCII white space. A null or empty text has no words.
    Other columns pass through; names of the new ones must be free.
    """
    rest = [f for f in df.schema.fields if f.name != text]
    if clash := {f.name for f in rest} & {*COUNTS, features}:
        raise ValueError(f"the frame already has columns {sorted(clash)}")
    schema = T.StructType([*rest, *[T.StructField(c, T.LongType()) for c in COUNTS],
                           T.StructField(features, T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = Statistics()
        for batch in batches:
            found = [each.of(x) for x in batch.column(text).cast(pa.binary()).to_pylist()]
            counts = np.array([c for c, _ in found], np.int64).reshape(len(found), len(COUNTS))
            columns = [*(batch.column(f.name) for f in rest), *(pa.array(c) for c in counts.T),
                       pa.array([f for _, f in found], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, schema.names)
        tidy()

    return df.mapInArrow(run, schema)


def sample(stats: DataFrame, labels: DataFrame, key: str, label: str, features: str, bound: int) -> DataFrame:
    """Features and labels of ``bound`` documents at most; all of them if there are fewer.

    A key has its highest label. Rows of equal key and features count once. Documents are chosen
    by the hash of both after they have met their labels, so a key with very many documents is
    sampled like any others.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        F.max(F.col(label).cast("int")).alias("_label"))
    rows = stats.select(F.col(f"`{key}`").alias("_key"), F.col(features).alias("_x")).withColumn("_hash", F.xxhash64("_key", "_x"))
    rows = rows.join(known, "_key")
    many = rows.select("_key", "_hash").distinct().count()
    if many > bound:
        rows = rows.where(F.pmod("_hash", F.lit(1_000_000)) < int(0.95 * bound / many * 1_000_000))
    return rows.dropDuplicates(["_key", "_hash"]).orderBy("_key", "_hash").limit(bound).select("_label", "_x")


def fit_trees(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", features: str = "features",
              bound: int = SAMPLE) -> Forest:
    """Trees for the probability of label 1, from at most ``bound`` labelled rows.

    Without labelled rows, or with one label only, the trees are a constant.
    """
    rows = sample(stats, labels, key, label, features, bound).collect()
    x = np.array([r["_x"] for r in rows], float).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r["_label"] for r in rows], float), np.array(list(FEATURES.values())))


def score(stats: DataFrame, forest: Forest, features: str = "features", out: str = "score") -> DataFrame:
    """Add the trees' probability ``out``; rows without features get null."""
    shared = stats.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def of(rows: pd.Series) -> pd.Series:
        whole = rows[rows.notna()]
        x = np.stack(whole.to_list()) if len(whole) else np.zeros((0, len(FEATURES)))
        return pd.Series(shared.value.score(x), index=whole.index).reindex(rows.index)

    return stats.withColumn(out, of(features))


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", bound: int = SAMPLE) -> DataFrame:
    """Counts, ``base_failed``, ``score`` and ``kept`` of every document, without its text.

    The rules reject documents under 20 words, and those with over 30 % of words
    in repeated windows. Of the others, those stay that the trees give 0.5 or more;
    with no labels of both kinds all of them stay. Other columns pass through; names
    of the new ones are refused.
    """
    if clash := {"score", "base_failed", "kept"} & set(docs.columns):
        raise ValueError(f"the frame already has columns {sorted(clash)}")
    stats = materialise(statistics(docs, text), "statistics")
    forest = fit_trees(stats, labels, key, bound=bound)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    judged = score(stats, forest).withColumn("base_failed", failed)
    verdict = F.col("score") >= 0.5 if len(forest.feature) else F.lit(True)
    return judged.withColumn("kept", ~F.col("base_failed") & verdict)
