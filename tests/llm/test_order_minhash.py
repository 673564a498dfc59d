from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import order_minhash as o
from panelkit.llm.components import components
from panelkit.llm.registry import table

MAKER = o.OrderMinHash()


def plain_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row
        row = [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(row[j], before[j + 1]))
    return row[-1]


def plain_classes(texts, least=o.SIMILARITY):
    """Class of every text by comparing all pairs."""
    made = {i: MAKER.shingles(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    keys = sorted(texts)
    for n, i in enumerate(keys):
        for j in keys[n + 1:]:
            a, b = made[i], made[j]
            if texts[i] == texts[j] or min(len(a), len(b)) >= least * max(len(a), len(b), 1) and len(a) and o.similarity(a, b, least) >= least:
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i in texts}


def test_similarity_is_that_of_a_full_table():
    pick = random.Random(8)
    for _ in range(300):
        a = [pick.randint(0, 12) for _ in range(pick.randint(1, 60))]
        b = [x if pick.random() < 0.93 else pick.randint(0, 12) for x in a if pick.random() < 0.97]
        if not b:
            continue
        common = plain_common(a, b)
        want = common / (len(a) + len(b) - common)
        got = o.similarity(np.array(a, np.uint64), np.array(b, np.uint64), 0.8)
        assert got == want if want >= 0.8 else got < 0.8


@pytest.mark.parametrize("width", [0, 1, 5, 200])
def test_band(width):
    pick = random.Random(width)
    a, b = [[pick.randint(0, 5) for _ in range(70)] for _ in range(2)]
    table_ = [[0] * 71 for _ in range(71)]
    for j, y in enumerate(b):
        for i, x in enumerate(a):
            near = x == y and abs(i - j) <= width
            table_[j + 1][i + 1] = max(table_[j][i] + near, table_[j][i + 1], table_[j + 1][i])
    assert o.common_in_band(np.array(a), np.array(b), width) == table_[70][70]


def test_labels_make_shingles_distinct():
    shingles = MAKER.shingles("a b c d e " * 40)
    assert len(set(MAKER.labelled(shingles).tolist())) == len(shingles) > len(set(shingles.tolist()))


def test_order_matters():
    words = [f"w{i}" for i in range(200)]
    turned = words[100:] + words[:100]
    same = sum(x == y for x, y in zip(MAKER.band_keys(" ".join(words)), MAKER.band_keys(" ".join(turned))))
    assert same < o.BANDS / 2


def test_agreement_of_a_function_is_the_squared_similarity():
    rng, one = np.random.default_rng(1), o.OrderMinHash(rows=1, bands=64)
    share = []
    for k in range(40):
        words = [f"{k}x{i}" for i in range(400)]
        edited = [w if rng.random() > 0.02 else w + "z" for w in words]
        a, b = one.shingles(" ".join(words)), one.shingles(" ".join(edited))
        want = o.similarity(a, b, 0.01) ** 2
        share.append((np.mean(np.array(one.band_keys(" ".join(words))) == one.band_keys(" ".join(edited))), want))
    got, want = np.mean(share, axis=0)
    assert abs(got - want) < 0.05


def test_long_texts_in_steps(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(20_000))
    whole = MAKER.band_keys(text)
    monkeypatch.setattr(o, "STEP", 50_000)
    assert MAKER.band_keys(text) == whole


def test_classes_of_the_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    want = plain_classes({r.doc_id: r.text for r in docs.collect()})
    rows = o.near_duplicates(docs).collect()
    assert {r.doc_id: r.class_id for r in rows} == want
    assert {r.doc_id for r in rows if r.kept} == set(want.values())


def test_chains_and_strangers_in_one_bucket(spark, documents):
    """Copies drift by a few words each, so the first and the last are far apart; classes follow the links."""
    pick, texts = random.Random(4), {}
    for family in range(4):
        words = [f"f{family}w{i}" for i in range(120)]
        for step in range(12):
            texts[family * 100 + step] = " ".join(words)
            words[pick.randrange(120)] = f"n{family}x{step}"
    want = plain_classes(texts)
    rows = o.near_duplicates(documents(list(texts.items()))).collect()
    assert {r.doc_id: r.class_id for r in rows} == want and len(set(want.values())) == 4


def test_blocks_of_a_large_bucket_lose_no_link(spark, documents, monkeypatch):
    pick, texts = random.Random(6), {}
    words = [f"w{i}" for i in range(100)]
    for i in range(160):
        own = list(words)
        for _ in range(pick.randint(0, 5)):
            own[pick.randrange(100)] = f"n{i}x{pick.random()}"
        texts[i] = " ".join(own)
    want = plain_classes(texts)
    monkeypatch.setattr(o.bucket_cells, "__defaults__", (20, 1 << 20))
    rows = o.near_duplicates(documents(list(texts.items()))).collect()
    assert {r.doc_id: r.class_id for r in rows} == want and 1 < len(set(want.values())) < 160


def test_cells_are_bounded_and_hold_every_pair(spark):
    buckets = spark.createDataFrame([(b, f"c{i}", 10) for b, n in ((1, 2), (2, 90), (3, 1), (4, 2)) for i in range(n)],
                                    "band long, copy string, n long")
    cells = o.bucket_cells(buckets, block=20).collect()
    held = {}
    for r in cells:
        held.setdefault((r.band, r.low, r.high), []).append((r.copy, r.side))
    # Buckets 1 and 4 have the same members, bucket 3 has one.
    assert {k[0] for k in held} == {1, 2} and max(map(len, held.values())) < 70
    pairs = {frozenset((a, b)) for rows in held.values() for a, s in rows for b, u in rows if a < b and (s != u or len({x for _, x in rows}) == 1)}
    assert len(pairs) == 90 * 89 // 2


def test_common_counts(monkeypatch):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 50)).astype(np.uint64)) for _ in range(20)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    for step in (1 << 21, 64):
        monkeypatch.setattr(o, "STEP", step)
        got = o.common_counts(sets)
        assert all(got[i, j] == want[i][j] for i in range(20) for j in range(20) if i != j)


def test_edge_cases(spark, documents):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = documents([(1, None), (2, ""), (3, "?!"), (4, "!?"), (5, "one two"), (6, "One, two"), (7, "one three"), (None, "one two"),
                      (8, long), (9, long + " end"), (9, long + " end"), (10, "?!")]).withColumn("copy", F.lit("c"))
    got = o.near_duplicates(rows).collect()
    classes = {}
    for r in got:
        classes.setdefault(r.class_id, []).append((r.doc_id, r.kept))
    assert len(got) == 12 and all(sum(k for _, k in v) == 1 for v in classes.values())
    assert {k: sorted(i or 0 for i, _ in v) for k, v in classes.items()} == {
        1: [1, 2], 3: [3, 10], 4: [4], 5: [0, 5, 6], 7: [7], 8: [8, 9, 9]}
    assert o.near_duplicates(documents([])).collect() == []
    assert [r.kept for r in o.near_duplicates(documents([(None, "a"), (None, "a")])).orderBy("kept").collect()] == [False, True]


def test_components(spark):
    pick = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(pick.randrange(100, 300), pick.randrange(100, 300)) for _ in range(120)]
    links += [(7, 7), (None, 3), (500, 400), (500, 400)] + [(1000, 1000 + i) for i in range(200)]
    parent = {i: i for p in links for i in p if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        if a is not None and b is not None:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    touched = {i for a, b in links if None not in (a, b) and a != b for i in (a, b)}
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: root(i) for i in touched}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
