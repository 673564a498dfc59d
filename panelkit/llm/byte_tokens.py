"""Token ids of a byte-level tokenizer file, by the tokenizers library and a bounded memo of words.

A byte-level tokenizer joins white space to the word behind it by one space at most,
and a line feed between two words is a word of its own. So a text whose spaces and
line feeds stand alone may be cut ahead of each of them, and every stretch always has
the same ids. Stretches are looked up; unknown ones go to the library in one text, in
which each begins at the one token that holds its white space. Those of plain letters,
digits and signs are cut into words here, which costs less than the library's own cut.
All other texts, and those with a special token, go to the library whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
from pyspark.broadcast import Broadcast
from pyspark.sql import SparkSession
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import CharDelimiterSplit

from panelkit.llm.prefix_bpe import byte_symbols
from panelkit.llm.word_memo import Learnt, WordMemo
from panelkit.llm.workers import one_thread

# Words of the memo before half of them go. Longer words are not kept.
MEMO = 1 << 19
LONGEST = 48
# Characters whose words are looked up together.
STRETCH = 1 << 20

# Letters, digits and signs whose runs are words in every version of Unicode; an apostrophe may begin a word of its own.
LETTERS, DIGITS, SIGNS = "A-Za-zÀ-ÖØ-öø-ÿ", "0-9", r"!-&(-/:-@\[-`{-~"
PLAIN = re.compile(f"\n?[{LETTERS}{DIGITS}{SIGNS}]+").fullmatch
WORDS = re.compile(f"\n| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[{SIGNS}]+").findall


def runs_free(text: str) -> bool:
    """Whether every white space in a text is one space or line feed between two words, or ahead of the first."""
    return (text.replace("\n", "").isprintable() and "  " not in text and "\n\n" not in text
            and " \n" not in text and "\n " not in text and text[-1] not in " \n")


class ByteTokenizer:
    """Ids as packed little-endian unsigned 32-bit integers.

    ``special_text``: strings of special tokens in a text are ordinary text;
    otherwise they are their tokens, as the library has it by default.
    """

    def __init__(self, spec: str, special_text: bool = False) -> None:
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = special_text
        # The same model for words spelt in the stand-ins of bytes, with a space between them.
        self.model = Tokenizer.from_str(spec)
        self.model.no_truncation()
        self.model.no_padding()
        self.model.encode_special_tokens = True
        self.model.pre_tokenizer = CharDelimiterSplit(" ")
        # Words come here once, so the library's own cache of words only costs time.
        if hasattr(self.model.model, "_resize_cache"):
            self.model.model._resize_cache(0)
        self.symbols = {b: c for c, b in byte_symbols().items()} | {0: " "}
        marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks = re.compile("|".join(map(re.escape, marks))).search if marks and not special_text else None
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        # The stand-ins of space and line feed in byte-level vocabularies.
        self.opens = np.zeros(1 + max(vocabulary.values()), bool)
        self.opens[[i for t, i in vocabulary.items() if t[0] in "ĠĊ"]] = True
        self.memo = WordMemo(MEMO, LONGEST, self._learn)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(c.ids, "<u4") for c in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, stretches: list[str]) -> np.ndarray:
        """The ids of plain stretches, one behind the other."""
        words = WORDS("".join([w if w[0] == "\n" else " " + w for w in stretches]))
        spelt = "\0".join(words).encode().decode("latin-1").translate(self.symbols)
        return np.array(self.model.encode_batch_fast([spelt], add_special_tokens=False)[0].ids, "<u4")

    def _others(self, stretches: list[str]) -> np.ndarray:
        return self._whole(["".join([w if w[0] == "\n" else " " + w for w in stretches])])[0]

    def _learn(self, stretches: list[str]) -> Iterator[Learnt]:
        """The ids of plain stretches and of others, each kind in one text."""
        plain = [PLAIN(w) is not None for w in stretches]
        for way, kind in ((self._words, True), (self._others, False)):
            places = [i for i, x in enumerate(plain) if x == kind]
            if not places:
                continue
            ids = way([stretches[i] for i in places])
            at = np.flatnonzero(self.opens[ids])
            if len(at) != len(places):
                raise ValueError("the tokenizer does not cut ahead of every space and line feed")
            yield places, ids, np.diff(at, append=len(ids))

    def _some(self, texts: list[str]) -> list[bytes]:
        words, ends, whole = [], [0], []
        for text in texts:
            if text and runs_free(text) and not (self.marks and self.marks(text)):
                words += (text if text[0] in " \n" else "\n" + text).replace("\n", " \n").split(" ")[1:]
            else:
                whole.append(text)
            ends.append(len(words))
        ids, at = self.memo.ids_of(words)
        ids, at, others = ids.tobytes(), (4 * at[ends]).tolist(), iter(self._whole(whole))
        # The line feed put ahead of a first word is one token.
        return [ids[x if t[0] in " \n" else x + 4:y] if y > x else next(others).tobytes() for t, x, y in zip(texts, at, at[1:])]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of every text, a bounded stretch at a time."""
        some, size = [], 0
        for text in texts:
            some.append(text)
            size += len(text)
            if size >= STRETCH:
                yield from self._some(some)
                some, size = [], 0
        yield from self._some(some)


_CODERS: dict[tuple[str, bool], ByteTokenizer] = {}


def share(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer file at ``path``, read by the driver; its size does not depend on the data."""
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    return spark.sparkContext.broadcast((sha256(spec.encode()).hexdigest(), spec))


def coder_of(shared: Broadcast, special_text: bool = False) -> ByteTokenizer:
    """One tokenizer per worker process, file and treatment of special tokens."""
    mark, spec = shared.value
    one_thread()
    if (mark, special_text) not in _CODERS:
        _CODERS.clear()
        _CODERS[mark, special_text] = ByteTokenizer(spec, special_text)
    return _CODERS[mark, special_text]
