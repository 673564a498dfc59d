from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm import cap_filters as c
from panelkit.llm.registry import table

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def plain(rows, least=c.COSINE):
    """Links of every vector and its component by all pairs."""
    good = [r for r in rows if r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    units = [np.array(r[1], float) / np.linalg.norm(np.array(r[1], float)) for r in good]
    links, parent = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (r, u) in enumerate(zip(good, units)):
        for s, v in zip(good[n + 1:], units[n + 1:]):
            if r[2] == s[2] and len(u) == len(v) and u @ v >= least:
                links[r[0]] += 1
                links[s[0]] += 1
                x, y = sorted((root(r[0]), root(s[0])))
                parent[y] = x
    return {i: (links[i], root(i), root(i) == i) for i in links}


def planted(n=60, copies=6, dims=64, seed=3):
    rng, rows = np.random.default_rng(seed), []
    for i in range(n):
        base = rng.standard_normal(dims)
        for k in range(copies):
            noise = rng.standard_normal(dims)
            rows.append((len(rows), (base + 0.12 * (k % 3) * noise).astype(np.float32).tolist(), i % 3))
    return rows


def result(frame):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in c.similar_vectors(frame).collect()}


def test_links_and_components_of_planted_copies(spark):
    rows = planted()
    want = plain(rows)
    assert sum(w[0] for w in want.values()) > 400
    assert result(spark.createDataFrame(rows, SCHEMA)) == want


def test_query_table(spark, sf):
    frame = table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    assert result(frame) == plain([tuple(r) for r in frame.collect()])


def test_recall_at_the_threshold():
    """Pairs at exactly the wanted cosine share a direction in nearly all cases."""
    rng = np.random.default_rng(0)
    x = rng.standard_normal((600, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal((600, 64))
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    code = c.ProductCode(64, 5000)
    pairs = zip(code.decode(x), code.decode(c.COSINE * x + np.sqrt(1 - c.COSINE ** 2) * z))
    assert np.mean([bool(set(a.tolist()) & set(b.tolist())) for a, b in pairs]) > 0.99


def test_decoding_finds_all_directions_above():
    rng = np.random.default_rng(1)
    code = c.ProductCode(12, 8, filters=4, spread=8)
    x = rng.standard_normal((20, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    names = np.arange(code.words ** 3)
    parts = [names // code.words ** 2, names // code.words % code.words, names % code.words]
    whole = np.concatenate([b[p] for b, p in zip(code.books, parts)], axis=1) @ code.rotation.T
    for v, found in zip(x, code.exceeded(x, code.threshold)):
        assert sorted(found.tolist()) == np.flatnonzero(whole @ v >= code.threshold).tolist()


def test_edge_cases(spark):
    a, nan, inf = [1.0, 2.0], float("nan"), float("inf")
    rows = [(1, a, 1), (2, a, 1), (3, [2.0, 4.0], 1), (4, a, 2), (5, a, None), (6, None, 1), (7, [0.0, 0.0], 1), (8, [1.0, None], 1),
            (9, [1.0, nan], 1), (10, [inf, 1.0], 1), (11, [1.0, 2.0, 0.0], 1), (12, [], 1), (13, [-1.0, -2.0], 1), (14, [1e-30, 2e-30], 1)]
    got = result(spark.createDataFrame(rows, SCHEMA).withColumn("direction", F.lit(1)).withColumn("a", F.lit(1)))
    assert got == plain(rows) and got[1] == (3, 1, True) and got[14][1] == 1
    assert c.similar_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    twice = c.similar_vectors(spark.createDataFrame([(1, a, 1), (1, a, 1), (None, a, None)], SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.n_links) for r in twice) == [(0, 0), (1, 1), (1, 1)]


def test_doubles_too(spark):
    frame = spark.createDataFrame([(1, [1e200, 1.0], "x"), (2, [2e200, 0.0], "x")], "vec_id long, embedding array<double>, label string")
    assert [r.n_links for r in c.similar_vectors(frame).collect()] == [1, 1]
    with pytest.raises(Exception, match="embedding"):
        c.similar_vectors(frame.drop("embedding"))
