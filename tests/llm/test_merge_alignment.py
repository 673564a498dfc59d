from __future__ import annotations

from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from panelkit.llm import merge_alignment as alignment
from panelkit.llm.prefix_bpe import byte_symbols
from panelkit.llm.queries import QUERIES
from panelkit.llm.registry import table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", "a", "The quick brown fox.", "<|endoftext|> and <s> </s> <unk>", "日本語 текст 👩‍👩‍👧", "tab\tand\r\nlines\n\n", "  two  spaces ",
         "ornithorhynchus " * 300, "ﬁ ½ é é", "\x00\x01", "▁under▁", "x" * 4000, "The quick brown fox."]


class Plain:
    """Alignment by comparing every two byte ranges."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.symbols = byte_symbols()

    def tokens(self, text):
        if not text:
            return [], []
        a = [(i, bytes(self.symbols[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            p = self.b.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()))
        raw = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == b"".join(x for _, x in b) == raw else ([], [])

    def __call__(self, text):
        a, b = self.tokens(text)
        spans = []
        for side in (a, b):
            ends = np.cumsum([len(x) for _, x in side]).tolist()
            spans.append([(i, e - len(x), e) for (i, x), e in zip(side, ends)])
        links, j = [], 0
        for x in spans[0]:
            while j < len(spans[1]) and spans[1][j][2] <= x[1]:
                j += 1
            for y in spans[1][j:]:
                if y[1] >= x[2]:
                    break
                links.append((x[0], y[0]))
        cuts = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups, start = [], 0
        for cut in cuts:
            groups.append(["|".join(",".join(str(i) for i, s, e in side if start <= s and e <= cut) for side in spans)][0])
            start = cut
        return len(a), len(b), len(groups), links, sha256(";".join(groups).encode()).hexdigest() if a else ""


def expected(rows):
    plain = Plain()
    found = [(key, plain(text)) for key, text in rows]
    holds = Counter(p for _, f in found for p in set(f[3]))
    best = defaultdict(int)
    for (a, _), n in holds.items():
        best[a] = max(best[a], n)
    return [(key, n_a, n_b, n_groups, len(links), sum(holds[p] == best[p[0]] for p in links), sum(holds[p] for p in links), digest)
            for key, (n_a, n_b, n_groups, links, digest) in found]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, *((x or 0) if i == 0 else x for i, x in enumerate(r))))


@pytest.mark.parametrize("piece", [1, 2, 7, 64, 5000])
def test_merge_in_pieces(piece):
    rng = np.random.default_rng(piece)
    for size in (1, 2, 30, 800):
        a, b = (np.append(np.sort(rng.choice(size, rng.integers(0, size), replace=False)) + 1, size + 1) for _ in range(2))
        link_a, link_b, group, group_a, group_b = alignment.merge_ends(np.unique(a), np.unique(b), piece)
        a, b = np.unique(a), np.unique(b)
        begin_a, begin_b = np.append(0, a[:-1]), np.append(0, b[:-1])
        want = [(i, j) for i in range(len(a)) for j in range(len(b)) if begin_a[i] < b[j] and begin_b[j] < a[i]]
        assert list(zip(link_a.tolist(), link_b.tolist())) == want
        cuts = np.intersect1d(a, b)
        assert a[group_a - 1].tolist() == b[group_b - 1].tolist() == cuts.tolist()
        assert group.tolist() == [int(np.searchsorted(cuts, min(a[i], b[j]))) for i, j in want]


def test_diagonals():
    rng = np.random.default_rng(3)
    a, b = np.sort(rng.integers(0, 50, 40)), np.sort(rng.integers(0, 50, 60))
    merged = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
    splits = alignment.diagonal_splits(a, b, np.arange(101))
    assert splits.tolist() == [sum(side == 0 for _, side in merged[:d]) for d in range(101)]


def test_packed_numbers():
    values = np.array([0, 1, 127, 128, 16383, 16384, 1 << 21, (1 << 28) - 1, 1 << 28, (1 << 34) + 5])
    data, at = alignment.pack_numbers(values)
    back, begins = alignment.unpack_numbers(data)
    assert back.tolist() == values.tolist() and begins.tolist() == at[:-1].tolist()
    assert alignment.unpack_numbers(b"")[0].tolist() == []


@pytest.mark.parametrize("block", [1, 200, 1 << 23])
def test_statistics_match_plain(spark, documents, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK", block)
    monkeypatch.setattr(alignment, "STRETCH", 150 if block < 1000 else 1 << 21)
    rows = list(enumerate(TEXTS)) + [(None, "null key"), (3, TEXTS[3]), (3, TEXTS[3])]
    got = alignment.link_statistics(documents(rows).repartition(3), A, B).collect()
    assert order(map(tuple, got)) == order(expected(rows))


def test_alignment_lists(spark, documents):
    plain = Plain()
    for r in alignment.align(documents(list(enumerate(TEXTS))), A, B).collect():
        a, b = plain.tokens(TEXTS[r.doc_id])
        assert list(r.a_ids) == [i for i, _ in a] and list(r.b_ids) == [i for i, _ in b]
        assert [(r.a_ids[x.a], r.b_ids[x.b]) for x in r.links] == plain(TEXTS[r.doc_id])[3]
        assert len(r.groups) == plain(TEXTS[r.doc_id])[2]
        for g in r.groups:
            assert sum(len(x) for _, x in a[:g.a_end]) == sum(len(x) for _, x in b[:g.b_end])


def test_empty_and_other_columns(spark, documents):
    assert alignment.link_statistics(documents([]), A, B).collect() == []
    assert alignment.align(documents([]), A, B).collect() == []
    extra = documents([(1, "a word")]).selectExpr("doc_id", "text", "7 as block", "'x' as links", "null as rest", "8 as `odd.name`", "9 as code")
    row = alignment.link_statistics(extra, A, B).first()
    assert (row["doc_id"], row["block"], row["links"], row["rest"], row["odd.name"], row["code"]) == (1, 7, "x", None, 8, 9)
    with pytest.raises(ValueError, match="n_a"):
        alignment.link_statistics(documents([(1, "a")]).withColumnRenamed("doc_id", "n_a"), A, B)


def test_query_matches_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    assert order(map(tuple, QUERIES["op12_merge_alignment"](spark, sf).collect())) == order(expected(rows))
