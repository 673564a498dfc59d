from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from panelkit.llm import prefix_bpe
from panelkit.llm.queries import id_digests

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return prefix_bpe.PrefixEncoder(prefix_bpe.read_vocabulary(PATH))


def ids(encoder, texts):
    return [np.frombuffer(x, "<i4").tolist() for x in encoder.encode(texts)]


ODD = ["", "  a  b\n\n c \n d   ", "a\n \nb", "it's I'll we'd  they'RE", "<|endoftext|>hi <|endoftext|><|endoft", "日本語 текст ½ ²³ Ⅷ",
       " x  y　", "tab\t\t x\t y", "é" * 500, "a" * 3000, "!!!!!!!!!####  ----", "\x1c \x1d a\x85b", "👩‍👩‍👧 🇩🇪", "0123456789" * 30, " " * 100 + "x"]


def test_ids_are_the_librarys(encoder, library):
    pick = random.Random(3)
    signs = "abcdefghijklmnopqrstuvwxyz'  .,\n\tÀéß12309 the ing"
    texts = ODD + ["".join(pick.choice(signs) for _ in range(pick.randint(1, 60))) for _ in range(3000)]
    assert ids(encoder, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_tokens_as_words(encoder, library):
    words = [t.decode() for t in prefix_bpe.read_vocabulary(PATH)["tokens"].values() if t.isascii()][::37]
    assert ids(encoder, words) == [library.encode(w, add_special_tokens=False).ids for w in words]


def test_memo_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(prefix_bpe, "MEMO", 4)
    small = prefix_bpe.PrefixEncoder(prefix_bpe.read_vocabulary(PATH))
    texts = ["the cat and the dog and a very odd ornithorhynchus"] * 3 + ["the end of it all"]
    for _ in range(3):
        assert ids(small, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_round_trip_in_spark(spark, documents):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "null key"), (7, None), (3, ODD[3]), (3, ODD[3])]
    coded = prefix_bpe.encode(documents(rows), PATH)
    back = prefix_bpe.decode(coded, PATH).collect()
    key = lambda r: (r[0] is not None, r[0], r[1])
    assert sorted(map(tuple, back), key=key) == sorted([(i, t or "") for i, t in rows], key=key)


def test_digests(spark, documents, library):
    from hashlib import sha256

    fields = [T.StructField("n", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())]
    got = prefix_bpe.encode_to(documents([(1, "a bc <|endoftext|>"), (2, None)]), PATH, fields, id_digests).orderBy("doc_id").collect()
    want = library.encode("a bc <|endoftext|>", add_special_tokens=False).ids
    assert tuple(got[0]) == (1, len(want), sha256(",".join(map(str, want)).encode()).hexdigest(),
                             sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest())
    assert got[1].n == 0 and got[1].a == got[1].b == sha256(b"").hexdigest()


def test_empty_and_clashing(spark, documents):
    assert prefix_bpe.encode(documents([]), PATH).collect() == []
    with pytest.raises(ValueError, match="ids"):
        prefix_bpe.encode(documents([(1, "a")]).withColumnRenamed("doc_id", "ids"), PATH)
