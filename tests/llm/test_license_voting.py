from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from panelkit.llm import license_voting
from panelkit.llm.license_voting import TEMPLATES


def words(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def places(text):
    w = words(text)
    return sorted((i, t.label) for t in TEMPLATES if t.exact for i in range(len(w)) if w[i:i + len(t.words)] == t.words)


MIT = next(t.text for t in TEMPLATES if t.label == "mit")
TEXTS = [
    None, "", "CC-BY cc  by! CC\nBY", "GNU Lesser General Public License, all rights reserved.", "all rights", "cc é by",
    "General public General Public License", "x" * 100_000 + " cc by", "word " * 60_000 + "all rights reserved", "İcc by ccK by",
    MIT.upper(), "before " + MIT.replace("granted", "kindly and freely granted") + " after",
    "Licensed under the Apache License, Version 2.0.", " ".join(MIT.split()[:6]), "cc by cc by cc by", "\x00cc\x00by\x7f",
]


def test_exact_places_and_words(spark, documents):
    rows = license_voting.summary(documents(list(enumerate(TEXTS)))).orderBy("doc_id").collect()
    for r, text in zip(rows, TEXTS):
        found = places(text)
        assert (r.n_words, r.n_base) == (len(words(text)), len(found))
        assert (r.first_word, r.last_word) == ((found[0][0], found[-1][0]) if found else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in found}))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1


def test_whole_changed_and_partial_templates(spark, documents):
    labels = {r.doc_id: (r.labels, r.score) for r in license_voting.summary(documents(list(enumerate(TEXTS)))).collect()}
    assert labels[10] == ("mit", 1.0)
    assert labels[11][0] == "mit" and 0.8 <= labels[11][1] < 1
    assert labels[12][0] == "apache-2.0"
    assert labels[13][0] == "" and 0 < labels[13][1] < 0.8


def test_spans(spark, documents):
    _, found = license_voting.find(documents([(1, "see: " + MIT + " end"), (2, "cc by")]))
    assert sorted((r.label, r.first, r["last"]) for r in found.collect()) == [("cc-by", 0, 1), ("mit", 1, len(MIT.split()))]


def test_edge_cases(spark, documents):
    same = documents([(1, "cc by"), (1, "cc by"), (None, "cc by"), (2, None)]).withColumns({"more": F.lit(1), "label": F.lit("x"), "_doc": F.lit(2)})
    rows = license_voting.summary(same).collect()
    assert sorted(r.n_base for r in rows) == [0, 1, 1, 1] and all((r.more, r.label, r._doc) == (1, "x", 2) for r in rows)
    assert license_voting.summary(documents([])).collect() == []
    with pytest.raises(ValueError, match="n_words"):
        license_voting.summary(documents([(1, "a")]).withColumn("n_words", F.lit(1)))


def test_one_shuffle_of_pairs_and_no_python(spark, documents):
    plan = license_voting.votes(documents([(1, "a b")]), TEMPLATES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BroadcastNestedLoop" not in plan and plan.count("Exchange hashpartitioning") <= 1
