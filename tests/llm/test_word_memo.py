from __future__ import annotations

import os
import subprocess
import sys

import numpy as np
import public_tokenizers
import pytest

from panelkit.llm import byte_tokens
from panelkit.llm.word_memo import WordMemo


def spelt(word):
    return [ord(c) for c in word]


def memo_of(limit, longest, learnt):
    """Ids are the letters' codes; learnt words are listed, those with an ``x`` in a part of their own, as for odd words."""
    def learn(words):
        learnt.extend(words)
        for kind in (False, True):
            places = [i for i, w in enumerate(words) if ("x" in w) == kind]
            if places:
                yield (places, np.array([c for i in places for c in spelt(words[i])], "<u4"), np.array([len(words[i]) for i in places]))

    return WordMemo(limit, longest, learn)


@pytest.mark.parametrize("limit", [2, 5, 40, 10000])
def test_ids_whatever_the_limit(limit):
    rng, learnt = np.random.default_rng(5), []
    memo = memo_of(limit, 5, learnt)
    for _ in range(60):
        words = ["".join(rng.choice(list("abx"), rng.integers(1, 9))) for _ in range(rng.integers(0, 30))]
        ids, ends = memo.ids_of(words)
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [spelt(w) for w in words]
        assert all(len(w) <= 5 for w in memo.numbers) and len(memo.numbers) <= limit + 30


def test_used_words_stay():
    learnt = []
    memo = memo_of(4, 9, learnt)
    for i in range(50):
        memo.ids_of(["often", f"once{i}", "often"])
    assert learnt.count("often") == 1 and len(memo.numbers) <= 6


class Spy:
    """A tokenizer that lists the texts it gets."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, []

    def encode_batch_fast(self, texts, **options):
        self.texts += texts
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_frequent_word_goes_to_the_library_once(monkeypatch):
    monkeypatch.setattr(byte_tokens, "MEMO", 20)
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        coder = byte_tokens.ByteTokenizer(f.read())
    coder.model = Spy(coder.model)
    often = " ".join(["first", *["ornithorhynchus"] * 1000])
    rare = [" ".join(["first", *(f"{a}{b}{c}" for b in "abcde" for c in "abcde")]) for a in "fghij"]
    texts = [often, *rare, often]
    got = [next(coder.encode([t])) for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [coder.tokenizer.encode(t).ids for t in texts]
    assert sum(t.count("ornithorhynchus") for t in coder.model.texts) == 1


MEASURE = """
import sys
import numpy as np
from panelkit.llm import swap_packing
from panelkit.llm.workers import tidy

def resident():
    with open("/proc/self/status") as f:
        return next(int(line.split()[1]) for line in f if line.startswith("VmRSS")) / 1024

class Shared:
    with open(sys.argv[1], encoding="utf-8") as f:
        value = "mark", f.read()

rng = np.random.default_rng(6)
texts = ["".join(t) for t in rng.choice(list("abcdefghijklmnop  "), (1500, 4000))]
before = resident()
coder = swap_packing.tokenizer_of(Shared)
most = max(resident() for _ in coder.encode(texts))
del coder
swap_packing._TOKENIZERS.clear()
tidy()
print(most - before, resident() - before)
"""


def test_memory_of_a_packing_task_is_bounded_and_returned():
    path = public_tokenizers.path("word_bpe_49k.json")
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"}
    most, left = map(float, subprocess.run([sys.executable, "-c", MEASURE, path], env=env, capture_output=True, text=True,
                                           check=True).stdout.split())
    # With a thread pool and ids kept word by word it took over 350 MB.
    assert most < 280 and left < 80
