from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from panelkit.llm import ranked_search

ITEMS = "item_id long, text string"


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(documents, items, k):
    """Every document scored for every item."""
    counts = [(key, Counter(plain_terms(text))) for key, text in documents]
    n_docs, n_words = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for key, c in counts:
            score = 0
            for t in set(plain_terms(text)):
                if c[t]:
                    m = 100 - 50 + (50 * c.total() * n_docs) // n_words
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, key is not None, key or 0))
        out += [(item, rank, key if known else None, -score) for rank, (score, known, key) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def test_terms():
    texts = ["", "Ab-c d_e 9x", "É à ÀB", "日本 語x", "a\x00b\x7fc", "tab\tnew\nline\r", "🙂x y"]
    for t in texts:
        assert [w.decode() for w in ranked_search.terms_of(t.encode())] == plain_terms(t)


def random_rows(seed, n, words=60):
    rng = np.random.default_rng(seed)
    weights = 1 / np.arange(1, words + 1)
    text = lambda size: " ".join(f"w{x}" for x in rng.choice(words, size, p=weights / weights.sum()))
    return [(i, text(rng.integers(0, 25))) for i in range(n)]


@pytest.mark.parametrize("k, block, fold", [(3, 1 << 23, 1024), (3, 300, 1), (1, 50, 2), (50, 1000, 1024)])
def test_ranking_matches_plain(spark, documents, monkeypatch, k, block, fold):
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", block)
    monkeypatch.setattr(ranked_search, "FOLD", fold)
    rows = random_rows(k, 400) + [(None, "w1 w50"), (7, None), (7, "w3 w3 w40"), (7, "w3 w3 w40"), (-4, "")]
    items = random_rows(9, 12) + [(None, "w2"), (5, None), (5, ""), (6, "nowhere"), (3, "w1 w2 w3"), (3, "w1 w2 w3")]
    got = ranked_search.search(documents(rows).repartition(4), spark.createDataFrame(items, ITEMS), k)
    assert sorted(map(tuple, got.collect()), key=str) == plain_search(rows, items, k)


def test_groups_of_queries_change_nothing(spark, documents, monkeypatch):
    monkeypatch.setattr(ranked_search, "GROUP_WORDS", 40)
    rows, items = random_rows(1, 100), random_rows(2, 10)
    got = ranked_search.search(documents(rows), spark.createDataFrame(items, ITEMS), 5)
    assert sorted(map(tuple, got.collect()), key=str) == plain_search(rows, items, 5)


def test_accumulators_are_limited():
    """A block whose rare terms settle the best documents makes no accumulators for the common one."""
    texts = [b"rare one common" if i < 5 else b"common" for i in range(1000)]
    numbers = {b"rare": 0, b"common": 1}
    row = ranked_search.index_block(list(range(1000)), texts, numbers)
    block = ranked_search.Block({c: row.column(c)[0].values for c in ("ids", "sizes", "terms", "lengths", "places", "times")}, 1000, 1010)
    best = ranked_search.Best(5)
    assert ranked_search.search_block(block, [(0, 5000), (1, 1)], best) == 5
    assert best.ids.tolist() == [0, 1, 2, 3, 4]
    assert best.scores.tolist() == [5000 * block.most[0] + int(block.adds[block.lists[1][0]])] * 5


def test_empty_frames_and_other_columns(spark, documents):
    items = spark.createDataFrame([(1, "a b")], ITEMS)
    assert ranked_search.search(documents([]), items).collect() == []
    assert ranked_search.search(documents([(1, None)]), items).collect() == []
    assert ranked_search.search(documents([(1, "a")]), spark.createDataFrame([], ITEMS)).collect() == []
    extra = documents([(1, "a"), (2, "c d")]).selectExpr("doc_id", "text", "1 as score", "2 as rank", "3 as item_id", "4 as ids", "5 as query")
    asked = items.selectExpr("item_id", "text", "9 as doc_id", "8 as words", "7 as item")
    assert [r.doc_id for r in ranked_search.search(extra, asked).collect()] == [1]
