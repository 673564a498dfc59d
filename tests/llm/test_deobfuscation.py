from __future__ import annotations

import math
import time
import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import deobfuscation as d
from panelkit.llm.registry import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return d.language_model(d.trigram_counts(table(spark, SF, "documents")))


def plain_trigrams(texts):
    out = {}
    for text in texts:
        codes = [0, 0] + [d.TABLE[ord(c)] if ord(c) < 0x250 else 0 for c in (text or "").lower()] + [0, 0]
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            out[a, b, c] = out.get((a, b, c), 0) + 1
    return out


def test_trigrams_are_counted_over_whole_texts(spark, documents):
    texts = ["stupid idiot", None, "", "é日x", "ab " * 1000]
    got = {(r.gram // d.SIZE ** 2, r.gram // d.SIZE % d.SIZE, r.gram % d.SIZE): r.n for r in d.trigram_counts(documents(list(enumerate(texts)))).collect()}
    want = plain_trigrams(texts)
    assert {k: n for k, n in got.items() if k != (0, 0, 0)} == {k: n for k, n in want.items() if k != (0, 0, 0)}


def test_counts_grow_with_the_input(spark, documents):
    one = d.trigram_counts(documents([(1, "some words")])).agg(F.sum("n")).first()[0]
    many = d.trigram_counts(documents([(i, "some words") for i in range(50)]).repartition(5)).agg(F.sum("n")).first()[0]
    assert many > 40 * one


def test_model_is_a_distribution(model):
    assert np.allclose(np.exp(model).sum(axis=2), 1, atol=1e-3)


def plain_decode(restorer, word):
    """All paths through the lattice, with the same costs."""
    best = None
    choices = []
    for i, char in enumerate(word):
        arcs = restorer.arcs(char)
        run = i > 0 and char == word[i - 1]
        choices.append((arcs, run and (word[i + 1:i + 2] == char or word[i - 2:i - 1] == char)))
    for path in product(*[range(len(arcs) + long) for arcs, long in choices]):
        out, score, state = "", 0.0, (0, 0)
        for (arcs, _), pick in zip(choices, path):
            if pick == len(arcs):
                if not out or all(x != out[-1] for x, _ in arcs):
                    break
                score -= d.DROP_REPEAT
                continue
            letter, cost = arcs[pick]
            score -= cost
            if letter:
                code = d.CODE.get(letter, d.OTHER)
                score += d.EARNED + restorer.model[state[0]][state[1]][code]
                state, out = (state[1], code), out + letter
        else:
            score += restorer.model[state[0]][state[1]][0]
            best = max(best, (score, out)) if best else (score, out)
    return best[1]


@pytest.mark.parametrize("word", ["1d10t", "m0r0n", "stuuupid", "tr@sh", "l0$er", "i.d.i.o.t", "clooown", "5cum", "a11", "x+y"])
def test_viterbi_finds_the_best_path(model, word):
    restorer = d.Restorer(model)
    assert restorer.decode(word) == plain_decode(restorer, word)


def test_disguised_words(model):
    restorer = d.Restorer(model)
    for word in ("1d10t", "i.d.i.o.t", "IDIOOOOT", "!diot"[1:] and "idi0t"):
        assert restorer.restore(word) == "idiot", word
    assert [restorer.restore(w) for w in ("m0r0n", "stuuuupid", "$tup1d", "(moron),", "the&&&", "Hello!!!", "1234", "...")] == [
        "moron", "stupid", "stupid", "moron", "the", "hello", "", ""]
    assert "idiot" in restorer.spaced("an i d i o t here") and "stupid" in restorer.spaced("so s-t-u-p-i-d!")
    assert restorer.spaced("plain words only") == []


def test_signs_at_edges_and_words_without_letters(model):
    restorer = d.Restorer(model)
    assert [restorer.restore(w) for w in ("!diot", "(!diot)", "!DIOT!!", "57up!d", "1d107")] == ["idiot", "idiot", "idiot", "stupid", "idiot"]
    assert [restorer.restore(w) for w in ("$7@73", "+83", "17", "70")] == ["state", "be", "it", "to"]
    assert [restorer.restore(w) for w in ("idiot!", "real!", "cool!!", "hell!", "!important", "m0r0n!")] == ["idiot", "real", "cool", "hell", "important", "moron"]
    assert "be" in restorer.readings("b3!") and "well" in restorer.readings("wel!") and restorer.readings("idiot!") == ["idiot"]
    assert [restorer.restore(w) for w in ("1234", "455", "2015", "12:30", "4.55", "$100", "100%", "$$$", "!!!", "+", "|")] == [""] * 11


def test_spaced_words_without_a_break(model):
    """The input is unaltered: no comma or wider space between the words."""
    restorer = d.Restorer(model)
    for text in ("y o u a r e a n i d i o t", "w h a t a n i d i o t y o u a r e", "i d i o t s t u p i d", "i.d.i.o.t.s.t.u.p.i.d", "a i d i o t", "y 0 u a r e a 1 d 1 0 t"):
        assert "idiot" in restorer.spaced(text), text
    assert "stupid" in restorer.spaced("i d i o t s t u p i d") and "moron" in restorer.spaced("t h e m o r o n i s h e r e")
    assert restorer.spaced("i d i o t").count("idiot") == 1 and restorer.spaced("i d i o t i d i o t").count("idiot") == 2
    assert restorer.spaced("1 2 3 4 5 6") == [] and "idiot" in restorer.spaced("! d i o t")


def plain_several(restorer, word):
    """All ways to cut a word of letters, with the same scores."""
    best = None
    for cuts in product((False, True), repeat=len(word) - 1):
        score, state, out = 0.0, (0, 0), ""
        for i, char in enumerate(word):
            code = d.CODE[char]
            score += d.EARNED + restorer.model[state[0]][state[1]][code]
            state, out = (state[1], code), out + char
            if i == len(word) - 1 or cuts[i]:
                score += restorer.model[state[0]][state[1]][0]
                state, out = (state[1], 0), out + " "
        best = max(best, (score, out[:-1])) if best else (score, out[:-1])
    return best[1]


@pytest.mark.parametrize("word", ["idiotstupid", "youareanidiot", "theword", "anidiot", "themoron"])
def test_viterbi_finds_the_best_cut(model, word):
    restorer = d.Restorer(model)
    assert restorer.decode(word, several=True) == plain_several(restorer, word)


def test_disguise_in_runs_and_signs_does_not_hide(spark, documents):
    labels, docs = table(spark, "/root/testdata/sf0.1", "labels"), table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text")
    base = " ".join(["there", "was", "thing", "and", "that", "other", "nothing", "for", "them"] * 6)
    planted = [(10 ** 9 + i, f"{base} {w} {base}") for i, w in enumerate(["i d i o t s t u p i d", "y o u a r e a n i d i o t s t u p i d", "!diot 57up!d"])]
    planted += [(10 ** 9 + 8, f"{base} 1 2 3 4 5 6 7 455 2015 100% {base}"), (10 ** 9 + 9, f"{base} real! cool! t h e w o r d i s h e r e {base}")]
    rows = d.judge(docs.union(documents(planted)), labels.select("doc_id", "toxic")).where("doc_id >= 1000000000").orderBy("doc_id").collect()
    assert [r.predicted for r in rows] == [1, 1, 1, 0, 0]


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    rows = d.judge(table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "labels").select("doc_id", "toxic")).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 50
    assert np.mean([a == b for a, b in held]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_disguise_does_not_hide(spark, documents):
    """Toxic documents with digits for letters or spaced letters are judged as the plain ones."""
    labels, docs = table(spark, "/root/testdata/sf0.1", "labels"), table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text")
    base = " ".join(["there", "was", "thing", "and", "that", "other", "nothing", "for", "them"] * 6)
    planted = [(10 ** 9 + i, f"{base} {w} {base}") for i, w in enumerate(["idiot stupid", "1d10t stup1d", "i d i o t s t u p i d".replace("t s", "t, s"), "idiooooot stuuupid"])]
    planted.append((10 ** 9 + 9, f"{base} {base}"))
    rows = d.judge(docs.union(documents(planted)), labels.select("doc_id", "toxic")).where("doc_id >= 1000000000").orderBy("doc_id").collect()
    assert [r.predicted for r in rows] == [1, 1, 1, 1, 0]


def test_edge_cases(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    same = documents([(1, "a b"), (1, "a b"), (None, "c"), (2, None), (3, ""), (4, "x" * 200_000), (5, "4" * 5000 + "a")]).withColumn("lang", F.lit("en"))
    rows = d.judge(same, none).collect()
    assert len(rows) == 7 and all(r.lang == "en" and r.predicted == int(r.score >= 0.5) and not math.isnan(r.score) for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 5), (3, 1)], "doc_id long, toxic int")
    assert d.judge(same, odd).count() == 7
    assert d.judge(documents([]), none).collect() == []
    with pytest.raises(ValueError, match="score"):
        d.judge(documents([(1, "a")]).withColumn("score", F.lit(1)), none)


def test_runs_are_those_of_the_expression():
    pick = np.random.default_rng(3)
    parts = list("ab1@$!|+é日_ .-*\n") + ["i d i o t", "i.d.i.o.t", "a-b-c", "(x y z)", "語 a b"]
    texts = ["".join(pick.choice(parts, pick.integers(0, 14))) for _ in range(3000)] + ["", "a b c", "a"]
    found = [[m.span() for m in d.runs(t, starts)] for t, starts in d.with_starts(texts)]
    assert found == [[m.span() for m in d.SPACED.finditer(t)] for t in texts]


def test_long_words_take_time_in_proportion(model):
    """No step copies what came before: a word of ten times the length takes about ten times as long."""
    restorer, times = d.Restorer(model), []
    for n in (5_000, 50_000):
        start = time.process_time()
        restorer.best("a1b4" * n)
        times.append(time.process_time() - start)
    assert times[1] < 30 * times[0]


def test_decoding_keeps_every_state(model):
    """A run of signs with very many readings is decoded as by trying all of them."""
    restorer = d.Restorer(model)
    assert restorer.decode("1|!6") == plain_decode(restorer, "1|!6")
    assert restorer.decode("6a1!e5") == plain_decode(restorer, "6a1!e5")


def test_a_hot_key_is_sampled(spark, documents):
    """One labelled key with many documents: the sample stays near its bound, and repeated rows count once."""
    labels = spark.createDataFrame([(1, 1), (1, 0), (1, 1), (3, 0)], "doc_id long, toxic int")
    rows = documents([(1, f"text {i}") for i in range(2000)] + [(1, "same")] * 500 + [(3, "other")])
    many = d.labelled(rows, labels, "doc_id", "text", "toxic", 100)
    got = many.collect()
    assert 50 < len(got) <= 100 + 40 and len({(r._key, r._text) for r in got}) == len(got)
    assert {r._label for r in got if r._key == 1} == {1}
    assert d.labelled(rows.where("text in ('same', 'other')"), labels, "doc_id", "text", "toxic", 100).count() == 2


def test_columns_of_helpers_pass_through(spark, documents):
    names = ["_x", "_key", "_text", "_label", "_hash", "x", "label"]
    frame = documents([(1, "a b")]).select("doc_id", "text", *[F.lit(n).alias(n) for n in names])
    row = d.judge(frame, spark.createDataFrame([], "doc_id long, toxic int")).first()
    assert all(row[n] == n for n in names)
