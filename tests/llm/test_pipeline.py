"""Every stage of the pipeline against a plain version, each on what the stage before it kept."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from panelkit.llm import deobfuscation, order_minhash, quality_rules
from panelkit.llm.registry import table
from panelkit.llm.secret_index import RULES

EXTRA = ["score", "held_out", "predicted", "spans", "kept", "base_failed", "row", "rest", "number", "_row", "_doc", "features", "component"]


@pytest.fixture(scope="module")
def stages(spark, sf):
    """Input and output of every stage on the whole table and planted documents, with columns of every helper's name."""
    base = "there was thing and that other nothing for them the and was with from into over under again"
    words = [w for w in base.split()]
    rng = np.random.default_rng(1)
    story = " ".join(f"{words[i % len(words)]}{rng.integers(0, 10 ** 6)}" for i in range(120))
    planted = [(10 ** 6, story), (10 ** 6 + 1, story), (10 ** 6 + 1, story), (10 ** 6 + 2, story.replace(story.split()[60], "changed")),
               (10 ** 6 + 3, f"{story[::-1]} password=abcdefgh1 and token: zzzzzzzz9"), (10 ** 6 + 4, "too short"), (10 ** 6 + 5, None)]
    docs = table(spark, sf, "documents")
    more = spark.createDataFrame([(i, t, "en", "planted", len(t or "")) for i, t in planted], docs.schema)
    docs = docs.unionByName(more).select("*", *[F.lit(f"own {n}").alias(n) for n in EXTRA])
    found = []
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, sf).collect()
        found.append((name, docs.collect(), rows))
        if name != "packing":
            docs = spark.createDataFrame(rows, docs.schema)
    return {name: (given, kept) for name, given, kept in found}


def bag(rows):
    return Counter(map(tuple, rows))


def test_other_columns_stay(stages):
    for name, (given, kept) in stages.items():
        if name != "packing":
            assert kept and kept[0].__fields__ == given[0].__fields__
            assert all(r[n] == f"own {n}" for r in kept for n in EXTRA), name


def test_toxicity(spark, sf, stages):
    """Rows stay or go whole, by a score made here from the evidence of each text alone."""
    given, kept = stages["toxicity"]
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in EXTRA))
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    pair = docs.select("doc_id", "text")
    model = spark.sparkContext.broadcast(deobfuscation.language_model(deobfuscation.trigram_counts(pair)))
    judge = deobfuscation.fit_judge(deobfuscation.labelled(pair, labels, "doc_id", "text", "toxic", deobfuscation.SAMPLE), model)
    reader = deobfuscation.Reader(model.value, judge.weights)
    toxic = judge.score(np.array([reader.evidence(r.text) for r in given])) >= 0.5
    assert bag(kept) == bag(r for r, t in zip(given, toxic) if not t)
    assert {r.doc_id for r in kept} >= {10 ** 6, 10 ** 6 + 1, 10 ** 6 + 2, 10 ** 6 + 3}


def plain_failed(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    repeated = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return len(words) < 20 or 100 * len(repeated) > 30 * len(words)


def test_quality(spark, sf, stages):
    """What the rules reject goes, and of the rest what the trees score below a half, one row at a time."""
    given, kept = stages["quality rules"]
    each = quality_rules.Statistics()
    counted = [each.of((r.text or "").encode()) for r in given]
    stats = quality_rules.statistics(spark.createDataFrame([(r.doc_id, r.text) for r in given], "doc_id long, text string"))
    forest = quality_rules.fit_trees(stats, table(spark, sf, "labels").select("doc_id", "quality"))
    good = forest.score(np.array([f for _, f in counted])) >= 0.5 if len(forest.feature) else np.ones(len(given), bool)
    assert bag(kept) == bag(r for r, g in zip(given, good) if g and not plain_failed(r.text))
    assert {r.doc_id for r in given} - {r.doc_id for r in kept} >= {10 ** 6 + 4} & {r.doc_id for r in given}


def test_near_duplicates(stages):
    """One row of each class that a comparison of all pairs finds."""
    given, kept = stages["near duplicates"]
    maker = order_minhash.OrderMinHash()
    made = [maker.shingles(r.text) for r in given]
    parent = list(range(len(given)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(given)):
        for j in range(i):
            a, b = made[i], made[j]
            if (given[i].text or "") == (given[j].text or "") or len(a) and len(b) and order_minhash.similarity(a, b, 0.8) >= 0.8:
                parent[root(i)] = root(j)
    classes = defaultdict(list)
    for i, r in enumerate(given):
        classes[root(i)].append(tuple(r))
    left = bag(kept)
    assert sum(left.values()) == len(classes) < len(given)
    for rows in classes.values():
        assert sum(left[r] for r in set(rows)) == 1
        # The smallest key stays, a null key only among its own.
        assert min((r[0] is None, r[0] or 0) for r in rows) in [(r[0] is None, r[0] or 0) for r in set(rows) if left[r]]


def plain_redacted(text):
    spans = sorted((m.start(), m.end()) for rule in RULES for m in re.finditer(rule.pattern, text)
                   if not rule.least or len(m.group(rule.group)) >= rule.least)
    out, at = "", 0
    for start, end in spans:
        if start >= at:
            out += text[at:start] + "[secret]"
        at = max(at, end)
    return out + text[at:]


def test_secrets(stages):
    given, kept = stages["secret scans"]
    want = Counter()
    for r in given:
        text = plain_redacted(r.text) if r.text is not None else None
        want[tuple({**r.asDict(), "text": text, "n_chars": len(text) if text is not None else None}.values())] += 1
    assert bag(kept) == want
    assert any("[secret]" in (r.text or "") for r in kept)


def test_packing(stages):
    given, rows = stages["packing"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in given:
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        want.update((r.doc_id, k, at, len(ids[at:at + 2048]), zlib.crc32(ids[at:at + 2048].tobytes())) for k, at in enumerate(range(0, len(ids), 2048)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    filled = defaultdict(list)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    for parts in filled.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [at for at, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_run_is_its_stages_in_turn(spark, sf):
    docs = table(spark, sf, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), docs.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf).drop("sequence_id", "offset")
    assert bag(corpus_pipeline.run(spark, sf).drop("sequence_id", "offset").collect()) == bag(last.collect())
