from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelkit.llm import swap_packing
from panelkit.llm.queries import QUERIES
from panelkit.llm.registry import table

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_are_the_librarys(library):
    coder = swap_packing.WordTokenizer(library.to_str())
    pick = random.Random(4)
    parts = ["a", "B", "é", "É", "é", "'s", "'LL", "12", "½", "ß", "İ", "ſ", "中文", ".", ",", "!", "<|endoftext|>", " ", "  ", "\n",
             "\t", " ", "\x1c", "\x85", "=", "̸", "Σ", "ς", "-", "_", "…", "x,y", "​"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 16))) for _ in range(3000)]
    got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def assert_packed(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return bins


def test_query_cuts_and_packs_every_document(spark, sf, library):
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    rows = QUERIES["op8_swap_packing"](spark, sf).collect()
    assert_packed(rows, 2048)
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    assert set(pieces) == set(texts)
    for key, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want = [(k, at, len(ids[at:at + 2048]), zlib.crc32(ids[at:at + 2048].tobytes())) for k, at in enumerate(range(0, len(ids), 2048))]
        assert sorted(pieces[key]) == want


def fewest(sizes, capacity):
    """A lower bound of the bins: large pieces, and the small ones that do not fit beside them."""
    best = 0
    for least in range(capacity // 2 + 1):
        large = [s for s in sizes if s > capacity / 2]
        room = sum(capacity - s for s in large if s <= capacity - least)
        small = sum(s for s in sizes if least <= s <= capacity / 2)
        best = max(best, len(large) + max(0, -(-(small - room) // capacity)))
    return best


@pytest.mark.parametrize("seed", range(6))
def test_search_never_adds_bins_and_reaches_full_ones(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, [40, 60, 100, 30, 90, 99][seed], 400).tolist()
    start = swap_packing.best_fit(sizes, 100)
    bins = swap_packing.pack_group(sizes, 100)
    assert sorted(i for b in bins for i in b) == list(range(400))
    assert max(sum(sizes[i] for i in b) for b in bins) <= 100
    assert fewest(sizes, 100) <= len(bins) <= min(len(start), fewest(sizes, 100) + 1)


def test_search_improves_on_best_fit():
    # Best fit by falling size puts 6+3 and 6+3 first; exchanges find 6+4, 6+4 and 3+3+2+2.
    sizes = [6, 6, 4, 4, 3, 3, 2, 2]
    assert len(swap_packing.pack_group(sizes, 10)) == 3
    poor = [[0], [1], [2, 4], [3, 5], [6, 7]]
    assert len(swap_packing.empty_bins(poor, sizes, 10)) <= 4


def squares(bins, sizes):
    return sum(sum(sizes[i] for i in b) ** 2 for b in bins)


def test_exchanges_raise_squared_fill():
    rng = np.random.default_rng(9)
    sizes = rng.integers(1, 60, 60).tolist()
    poor = [[i] for i in range(60)]
    filled = swap_packing.fill_up(poor, sizes, 100)
    assert squares(filled, sizes) > squares(poor, sizes)
    assert squares(swap_packing.empty_bins(filled, sizes, 100), sizes) >= squares(filled, sizes)


def test_groups_and_rounds_keep_every_piece(spark):
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 100, 700).tolist()
    frame = spark.createDataFrame([(i, s, "x") for i, s in enumerate(sizes)], "id long, length long, extra string")
    rows = swap_packing.pack(frame, 100, group=50).collect()
    assert sorted(r.id for r in rows) == list(range(700)) and all(r.extra == "x" for r in rows)
    bins = assert_packed(rows, 100)
    assert len(bins) <= fewest(sizes, 100) * 1.03 + 1


def test_sequences_do_not_depend_on_how_the_rows_are_split(spark):
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 100, 700).tolist()
    frame = spark.createDataFrame(list(enumerate(sizes)), "id long, length long")
    found = {n: swap_packing.pack(frame.repartition(n, "id"), 100, group=50).select("sequence_id").distinct().count() for n in (1, 2, 8)}
    assert len(set(found.values())) == 1


def test_groups_have_the_same_mix(spark):
    frame = spark.createDataFrame([(s, "x") for s in [7] * 40 + [5] * 41 + [1] * 3], "length long, _slot string").repartition(5)
    mixes = defaultdict(list)
    for r in swap_packing.dealt(frame, "length", 4, "group").collect():
        mixes[r.group].append(r.length)
    assert sorted(map(len, mixes.values())) == [21, 21, 21, 21]
    assert all(m.count(7) == 10 and m.count(5) in (10, 11) for m in mixes.values())


def test_columns_of_any_name_pass_through(spark):
    names = ["_id", "_group", "_bin", "_offset", "_open", "_size", "_n", "_before", "_slot", "_piece", "_row", "_place", "_of", "_shift"]
    frame = spark.createDataFrame([(3, *names), (8, *names)], ["length", *names])
    rows = swap_packing.pack(frame, 8).collect()
    assert sorted(r.length for r in rows) == [3, 8] and all(r[n] == n for r in rows for n in names)


def test_memo_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(swap_packing, "MEMO", 4)
    coder = swap_packing.WordTokenizer(library.to_str())
    texts = ["The cat and the dog, and a very odd Ornithorhynchus!"] * 3 + ["Élan and the end."]
    for _ in range(3):
        assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == [
            library.encode(t, add_special_tokens=False).ids for t in texts]


def test_assembled_ids(spark, documents, library):
    texts = ["a few words", "some more of them", None, "", "word " * 50]
    pieces = swap_packing.token_pieces(documents(list(enumerate(texts))), PATH, capacity=20, end=0, ids="ids")
    packed = swap_packing.pack(pieces, 20).cache()
    whole = {r.sequence_id: list(r.ids) for r in swap_packing.assemble(packed).collect()}
    back = defaultdict(dict)
    for r in packed.collect():
        back[r.doc_id][r.piece] = whole[r.sequence_id][r.offset:r.offset + r.length]
    for i, text in enumerate(texts):
        assert sum((back[i][k] for k in sorted(back[i])), []) == [*library.encode(text or "", add_special_tokens=False).ids, 0]


def test_edge_cases(spark, documents):
    assert swap_packing.pack(swap_packing.token_pieces(documents([]), PATH, 8, 0), 8).collect() == []
    same = documents([(1, "hello"), (1, "hello"), (None, "hello"), (2, None)])
    rows = swap_packing.pack(swap_packing.token_pieces(same, PATH, 8, 0), 8).collect()
    assert len(rows) == 4 and len({r.sequence_id for r in rows}) == 1
    assert_packed(rows, 8)
    with pytest.raises(ValueError, match="piece"):
        swap_packing.token_pieces(documents([(1, "a")]).withColumn("piece", F.lit(1)), PATH, 8, 0)
    with pytest.raises(Exception, match="must be from 1 to"):
        swap_packing.pack(spark.createDataFrame([(9,)], "length long"), 8).collect()
