from __future__ import annotations

import math
import struct
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from panelkit.llm import hash_tree
from panelkit.llm.queries import QUERIES


def placed(spark, tree, n=20_000):
    rows = hash_tree.descend(spark.range(n), ["id"], tree).collect()
    return {r.id: r.shard for r in rows}


def test_shares_follow_weights(spark):
    tree = {"a": {"r": {"0": 1.0, "1": 3.0}}, "b": {"r": {"2": 4.0}, "s": {"3": 0.0, "4": 2.0}}}
    count = Counter(placed(spark, tree).values())
    assert set(count) == {"0", "1", "2", "4"}
    for shard, weight in (("0", 1), ("1", 3), ("2", 4), ("4", 2)):
        assert abs(count[shard] - 2000 * weight) < 250


def test_new_region_takes_rows_only_into_itself(spark):
    before, after = placed(spark, hash_tree.regular_tree(16)), placed(spark, hash_tree.regular_tree(17))
    moved = {i for i in before if before[i] != after[i]}
    assert {after[i] for i in moved} == {"16"}
    assert abs(len(moved) - 20_000 / 17) < 200


def test_heavier_subtree_confines_movement(spark):
    light = {"a": {"r": {"0": 1.0, "1": 1.0}}, "b": {"r": {"2": 1.0}, "s": {"3": 1.0}}}
    heavy = {"a": {"r": {"0": 1.0, "1": 1.0}}, "b": {"r": {"2": 1.0}, "s": {"3": 2.0}}}
    before, after = placed(spark, light), placed(spark, heavy)
    moved = {(before[i], after[i]) for i in before if before[i] != after[i]}
    # Into region b, whose weight grew, and within it into rack s; nothing leaves b, nothing moves inside a.
    assert moved == {("0", "2"), ("0", "3"), ("1", "2"), ("1", "3"), ("2", "3")}


def test_slots_are_gapless(spark, sf):
    slots = defaultdict(list)
    for r in QUERIES["op7_hash_tree"](spark, sf).collect():
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 16) and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sizes_and_sums(spark, documents, tmp_path):
    import zlib

    texts = {1: "é日", 2: None, 3: "", 4: "x" * 500_000}
    documents(list(texts.items())).write.parquet(f"{tmp_path}/documents.parquet")
    for r in QUERIES["op7_hash_tree"](spark, str(tmp_path)).collect():
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))


def test_edge_cases(spark, documents):
    rows = documents([(None, "a"), (None, "b"), (5, "c"), (5, "c"), (5, None)]).withColumn("extra", F.lit("x"))
    got = hash_tree.number_within(hash_tree.descend(rows, ["doc_id"], hash_tree.regular_tree(16)), "shard").collect()
    assert len(got) == 5 and all(r.extra == "x" for r in got)
    assert len({r.shard for r in got if r.doc_id is None}) == len({r.shard for r in got if r.doc_id == 5}) == 1
    by_null = hash_tree.number_within(rows, "doc_id").collect()
    assert sorted(r.slot for r in by_null if r.doc_id is None) == [0, 1]
    assert hash_tree.number_within(hash_tree.descend(documents([]), ["doc_id"], hash_tree.regular_tree(3)), "shard").collect() == []
    with pytest.raises(ValueError, match="depth"):
        hash_tree.descend(rows, ["doc_id"], {"a": {"0": 1.0}, "1": 1.0})


def plain_xxhash64(values, seed=42):
    """Hash of a long and strings as Spark chains them: each column's hash is the next one's seed."""
    for v in values:
        seed = xxhash.xxh64(struct.pack("<q", v) if isinstance(v, int) else v.encode(), seed=seed).intdigest()
    return seed


def plain_place(key, tree, path=""):
    """The same descent, one key at a time."""
    while isinstance(tree, dict):
        if len(tree) == 1:
            name = next(iter(tree))
        else:
            draws = []
            for child, below in tree.items():
                u = ((plain_xxhash64([key, f"{path}/{child}"]) >> 11) + 0.5) / (1 << 53)
                draws.append((-math.log(u) / hash_tree.weight_of(below), child))
            name = min(draws)[1]
        path, tree = f"{path}/{name}", tree[name]
    return path.rsplit("/", 1)[1]


def test_placement_matches_independent_draws(spark):
    weighted = {"a": {"r": {"0": 1.0, "1": 2.5}, "s": {"2": 0.5}}, "b": {"t": {"3": 3.0, "4": 1.0, "5": 0.25}}}
    for tree in (hash_tree.regular_tree(16), hash_tree.regular_tree(17), weighted):
        rows = hash_tree.descend(spark.range(500), ["id"], tree).collect()
        assert {r.id: r.shard for r in rows} == {i: plain_place(i, tree) for i in range(500)}


def test_columns_of_helpers_pass_through(spark):
    names = ["_piece", "_row", "_group", "_of", "_n", "_shift", "_place", "_at_0", "_at_1", "_at_2"]
    frame = spark.range(5).select("id", *[F.lit(n).alias(n) for n in names])
    rows = hash_tree.number_within(hash_tree.descend(frame, ["id"], hash_tree.regular_tree(16)), "shard").collect()
    assert len(rows) == 5 and all(r[n] == n for r in rows for n in names)
