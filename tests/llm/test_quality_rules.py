from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import boosted_trees, quality_rules
from panelkit.llm.registry import table

LABELS = "doc_id long, quality int"


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    repeated = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(repeated)]


ODD = [None, "", " \n\t ", "é ß x\x1cy", "a b\na b\n\na b ", "one two three four five six seven eight " * 3, "# * $ % & | < >",
       "x" * 300_000, "w " * 200_000, "a\r\nb\r\na\r\n", "日本 語"]


def test_counts_match_plain_ones(spark, documents, sf):
    texts = ODD + [r.text for r in table(spark, sf, "documents").collect()]
    got = quality_rules.statistics(documents(list(enumerate(texts)))).orderBy("doc_id").collect()
    assert [[r[c] for c in quality_rules.COUNTS] for r in got] == [plain_counts(t) for t in texts]


def test_repeated_words_at_the_edges():
    each = quality_rules.Statistics()
    words = [f"w{i}" for i in range(8)]
    for text in (" ".join(words * 2), " ".join([*words, "x", *words]), " ".join(words + words[:4]), "a " * 9):
        assert each.of(text.encode())[0] == plain_counts(text)


@pytest.mark.parametrize("sign", [1, -1])
def test_monotone_features_never_turn(sign):
    rng = np.random.default_rng(5)
    x = rng.random((800, 3))
    y = ((x[:, 0] - 0.5) * sign + 0.3 * np.sin(9 * x[:, 1]) + 0.1 * rng.standard_normal(800) > 0).astype(float)
    forest = boosted_trees.fit(x, y, np.array([sign, 0, 0]), trees=30)
    grid = np.linspace(-1, 2, 60)
    for row in x[:50]:
        line = np.repeat(row[None, :], len(grid), axis=0)
        line[:, 0] = grid
        assert (np.diff(forest.score(line)) * sign >= -1e-12).all()
    assert ((forest.score(x) >= 0.5) == y).mean() > 0.85


def plain_score(forest, row):
    inner, total = forest.feature.shape[1], forest.start
    for f, t, v in zip(forest.feature, forest.threshold, forest.value):
        node = 0
        while node < inner:
            node = 2 * node + (2 if row[f[node]] > t[node] else 1)
        total += v[node - inner]
    return 1 / (1 + np.exp(-total))


def test_array_scoring_is_that_of_single_rows():
    rng = np.random.default_rng(6)
    x = rng.random((300, 4))
    forest = boosted_trees.fit(x, (x[:, 0] > x[:, 1]).astype(float), np.zeros(4, int), trees=12)
    assert np.allclose(forest.score(x), [plain_score(forest, r) for r in x])


def test_constant_labels_and_no_rows():
    assert boosted_trees.fit(np.zeros((0, 2)), np.zeros(0), np.zeros(2, int)).score(np.zeros((3, 2))).tolist() == [0.5] * 3
    forest = boosted_trees.fit(np.ones((4, 2)), np.ones(4), np.zeros(2, int))
    assert len(forest.feature) == 0 and forest.score(np.ones((1, 2)))[0] > 0.5


def test_judged_on_held_out_labels(spark):
    """Trees fitted on half of the labels keep clean documents of the other half."""
    sf = "/root/testdata/sf0.01"
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    judged = quality_rules.judge(table(spark, sf, "documents").select("doc_id", "text"), labels.where("doc_id % 2 = 0"))
    rest = judged.where("not base_failed").join(labels.where("doc_id % 2 = 1"), "doc_id").select("kept", "quality").collect()
    assert len(rest) > 100
    assert np.mean([r.kept == (r.quality == 1) for r in rest]) > 0.95


def test_edge_cases(spark, documents):
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None), (3, 7)], LABELS)
    frame = documents([(1, None), (1, ""), (None, "a b c"), (2, "w%d " % 3 * 25), (4, " ".join(f"w{i}" for i in range(30))),
                       (4, " ".join(f"w{i}" for i in range(30)))]).withColumn("n", F.lit(3))
    rows = quality_rules.judge(frame, labels).orderBy("n_words").collect()
    assert [r.base_failed for r in rows] == [True, True, True, True, False, False]
    assert [r.kept for r in rows] == [False] * 4 + [True] * 2
    assert all(r.n == 3 for r in rows)
    assert quality_rules.judge(documents([]), labels.limit(0)).collect() == []
    with pytest.raises(ValueError, match="n_words"):
        quality_rules.statistics(documents([(1, "a")]).withColumn("n_words", F.lit(1)))


def test_a_hot_key_is_sampled(spark, documents):
    """One labelled key with many documents: no more rows than the bound, and repeated ones once."""
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0)], LABELS)
    rows = documents([(1, f"text {'word ' * (i % 400)}{i}") for i in range(500)] + [(1, "same")] * 300)
    stats = quality_rules.statistics(rows)
    got = quality_rules.sample(stats, labels, "doc_id", "quality", "features", 10).collect()
    assert 0 < len(got) <= 10 and {r._label for r in got} == {1}
    few = quality_rules.sample(stats.where("n_words = 1"), labels, "doc_id", "quality", "features", 10).collect()
    assert len(few) == 1


def test_columns_of_helpers_pass_through(spark, documents):
    names = ["_key", "_label", "_hash", "_x", "_score"]
    frame = documents([(1, "a b")]).select("doc_id", "text", *[F.lit(n).alias(n) for n in names])
    row = quality_rules.judge(frame, spark.createDataFrame([], LABELS)).first()
    assert all(row[n] == n for n in names)
    for name in ("score", "kept", "base_failed"):
        with pytest.raises(ValueError, match=name):
            quality_rules.judge(frame.withColumn(name, F.lit(1)), spark.createDataFrame([], LABELS))
