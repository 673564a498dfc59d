"""Byte-pair encoding by dynamic programming over prefixes, and its inverse.

The usual encoder merges pairs until none is left. Here the result is found
without merging: for every prefix of a word the last token of the prefix's own
encoding is unique, so one token per prefix describes all encodings.

* A suffix automaton of the vocabulary reads the word; after each byte its state
  and the suffix links above it list every token that ends there.
* A token ``t`` that ends at ``i`` is the last one of prefix ``i`` exactly when
  the last token of prefix ``i - len(t)`` may stand before it, that is, when
  encoding the two tokens' bytes would leave the boundary between them alone.
* Back-pointers from the end of the word give the ids.

Two neighbours keep their boundary when no merge across it comes first. Such a
merge joins a node of the left token's right spine with a node of the right
token's left spine while both are whole: before their own parents are built, and,
as merges of one rank are done from the left, not at the parent's rank on the right.

Texts are cut into words as the tokenizer file says (its byte-level pattern), and
words seen before are looked up in a bounded memo that only saves time.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# The cut into words of byte-level tokenizers (a fixed value).
WORDS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
         r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
# A space with white space on both sides; two spaces are looked for besides. Such runs are not cut at their spaces.
RUNS = re.compile(r"\s \s")

# Entries of the memo of words before a new one is begun; the last full one is kept beside it.
MEMO = 3 << 16
# Characters whose words are looked up together.
STRETCH = 1 << 21


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of every byte: itself where printable, else the next code points from 256."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    odd = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(odd)}


def read_vocabulary(path: str) -> dict:
    """Tokens as bytes, merges as id triples and special tokens of a byte-level BPE tokenizer file.

    Only what is implemented is accepted: byte-level words without prefix space,
    no normaliser, no merge exceptions, each merge with a result of its own.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, cut = spec["model"], spec["pre_tokenizer"]
    if spec["normalizer"] or cut["type"] != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"]:
        raise ValueError("only byte-level vocabularies without normaliser are supported")
    if model["type"] != "BPE" or model.get("ignore_merges") or model.get("unk_token") or model.get("dropout"):
        raise ValueError("only plain BPE models are supported")
    symbols, ids = byte_symbols(), model["vocab"]
    tokens = {i: bytes(symbols[c] for c in t) for t, i in ids.items()}
    pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
    merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
    if len({m[2] for m in merges}) != len(merges):
        raise ValueError("two merges have the same result")
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens |= {i: t.encode() for t, i in special.items()}
    return {"tokens": tokens, "merges": merges, "special": special}


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}i", *ids)


class SuffixAutomaton:
    """All substrings of a set of byte strings; states know the members that end in them."""

    def __init__(self, members: dict[bytes, int]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends = [(self._insert(word), word, i) for word, i in members.items()]
        held: list[list[tuple[int, int]]] = [[] for _ in self.link]
        for _, word, i in ends:
            held[self._state(word)].append((len(word), i))
        order = np.argsort(np.array(self.length), kind="stable").tolist()
        # Members that end where a state's longest string ends, longest first: its own, then those above.
        self.ending: list[tuple[tuple[int, int], ...]] = [()] * len(self.link)
        for state in order[1:]:
            above = self.ending[self.link[state]]
            self.ending[state] = (*sorted(held[state], reverse=True), *above) if held[state] else above

    def _state(self, word: bytes) -> int:
        state = 0
        for b in word:
            state = self.next[state][b]
        return state

    def _insert(self, word: bytes) -> int:
        last = 0
        for b in word:
            last = self._extend(last, b)
        return last

    def _extend(self, last: int, b: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if b in nxt[last]:
            q = nxt[last][b]
            return q if length[q] == length[last] + 1 else self._split(last, b, q)
        new = len(link)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and b not in nxt[p]:
            nxt[p][b] = new
            p = link[p]
        if p != -1:
            q = nxt[p][b]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, b, q)
        return new

    def _split(self, p: int, b: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(link)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p != -1 and nxt[p].get(b) == q:
            nxt[p][b] = copy
            p = link[p]
        return copy


class PrefixEncoder:
    """Encodes words of bytes under one vocabulary."""

    def __init__(self, vocabulary: dict) -> None:
        special = set(vocabulary["special"].values())
        words = {t: i for i, t in vocabulary["tokens"].items() if i not in special}
        self.automaton = SuffixAutomaton(words)
        self.pairs = {(a << 20) | b: rank for rank, (a, b, _) in enumerate(vocabulary["merges"])}
        self.parts = {c: (a, b, rank) for rank, (a, b, c) in enumerate(vocabulary["merges"])}
        self.special = vocabulary["special"]
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.words = regex.compile(WORDS).findall
        self.known: dict[int, bool] = {}
        self.left_spine = lru_cache(None)(lambda t: self._spine(t, 0))
        self.right_spine = lru_cache(None)(lambda t: self._spine(t, 1))
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # A token is the encoding of its own bytes unless its two parts could never meet.
        self.own = {i for i in words.values() if self._is_own(i)}

    def _is_own(self, token: int) -> bool:
        if token not in self.parts:
            return True
        a, b, rank = self.parts[token]
        return self._first_across(a, b) == rank

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """Nodes down one side of a token's merge tree, each with the rank at which its parent is built."""
        nodes, used = [], float("inf")
        while True:
            nodes.append((token, used))
            if token not in self.parts:
                return nodes
            *both, used = self.parts[token]
            token = both[side]

    def _first_across(self, a: int, b: int) -> float:
        """The smallest rank of a merge across the boundary of two neighbours."""
        first = float("inf")
        for x, x_used in self.right_spine(a):
            for y, y_used in self.left_spine(b):
                rank = self.pairs.get((x << 20) | y)
                if rank is not None and rank < x_used and rank <= y_used and rank < first:
                    first = rank
        return first

    def fits(self, a: int, b: int) -> bool:
        """Whether token ``b`` may follow token ``a`` in an encoding."""
        key = (a << 20) | b
        known = self.known.get(key)
        if known is None:
            if len(self.known) >= MEMO:
                self.known.clear()
            known = self.known[key] = self._first_across(a, b) == float("inf")
        return known

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of every word of a sorted list, packed; prefixes that neighbours share are solved once."""
        nxt, link, length, ending = self.automaton.next, self.automaton.link, self.automaton.length, self.automaton.ending
        known, own, fits = self.known, self.own, self.fits
        last, came, states, matches = [-1], [0], [0], [0]
        previous, results = b"", []
        for word in words:
            shared = 0
            for x, y in zip(previous, word):
                if x != y:
                    break
                shared += 1
            previous = word
            del last[shared + 1:], came[shared + 1:], states[shared + 1:], matches[shared + 1:]
            state, matched = states[shared], matches[shared]
            for i in range(shared, len(word)):
                b = word[i]
                while b not in nxt[state]:
                    state = link[state]
                    matched = length[state]
                state = nxt[state][b]
                matched += 1
                for size, token in ending[state]:
                    if size > matched:
                        continue
                    start = i + 1 - size
                    if start:
                        good = known.get((last[start] << 20) | token)
                        if good or good is None and fits(last[start], token):
                            break
                    elif token in own:
                        break
                else:
                    raise ValueError(f"no token ends at byte {i} of {word!r}")
                last.append(token)
                came.append(start)
                states.append(state)
                matches.append(matched)
            ids, i = [], len(word)
            while i:
                ids.append(last[i])
                i = came[i]
            ids.reverse()
            results.append(pack(ids))
        return results

    def _look_up(self, keys: set[str]) -> dict[str, bytes]:
        """The ids of stretches of text that the memo lacks. A key names the stretch of one space and
        itself, or, when it starts with two spaces, what stands behind them."""
        found, new = {}, {}
        for key in keys:
            ids = self.older.get(key)
            if ids is None:
                new[key] = self.words(key[2:] if key.startswith("  ") else " " + key)
            else:
                found[key] = ids
        spelled = {w.encode(): w for words in new.values() for w in words}
        words = sorted(spelled)
        coded = dict(zip(map(spelled.__getitem__, words), self.encode_words(words)))
        for key, words in new.items():
            found[key] = coded[words[0]] if len(words) == 1 else b"".join([coded[w] for w in words])
        if len(self.memo) + len(found) > MEMO:
            self.older, self.memo = self.memo, {}
        self.memo.update(found)
        return found

    def _keys(self, text: str) -> list[str]:
        """A text without special tokens as keys of ``_look_up``. White space joins the word behind it
        by one space at most, so a text may be cut ahead of every space that stands alone."""
        if "  " in text or RUNS.search(text):
            return ["  " + w for w in self.words(text)]
        first, *rest = text.split(" ")
        return ["  " + first, *rest] if first else rest

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of every text as packed little-endian 32-bit integers."""
        cuts, missing, look = [], set(), self.memo.get
        for text in texts:
            parts = []
            for stretch in self._stretches(text or ""):
                if isinstance(stretch, bytes):
                    parts.append(((), [stretch]))
                    continue
                keys = self._keys(stretch)
                ids = list(map(look, keys))
                if None in ids:
                    missing.update([k for k, x in zip(keys, ids) if x is None])
                    parts.append((keys, ids))
                else:
                    parts.append(((), ids))
            cuts.append(parts)
        found = self._look_up(missing) if missing else {}
        return [b"".join([b"".join([found[k] if x is None else x for k, x in zip(keys, ids)] if keys else ids)
                          for keys, ids in parts]) for parts in cuts]

    def _stretches(self, text: str) -> Iterator[str | bytes]:
        """The text between special tokens, and their packed ids."""
        if self.cut is None or "<" not in text:
            if text:
                yield text
            return
        at = 0
        for mark in self.cut.finditer(text):
            if mark.start() > at:
                yield text[at:mark.start()]
            yield pack([self.special[mark.group()]])
            at = mark.end()
        if at < len(text):
            yield text[at:]

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """As ``encode_all``, a bounded stretch of texts at a time."""
        some, size = [], 0
        for text in texts:
            some.append(text)
            size += len(text or "")
            if size >= STRETCH:
                yield from self.encode_all(some)
                some, size = [], 0
        yield from self.encode_all(some)


class Vocabulary:
    """The bytes and the decimal number of every id."""

    def __init__(self, tokens: dict[int, bytes]) -> None:
        self.spelled = tokens
        self.decimal = {i: str(i) for i in tokens}

    def decode(self, ids: Sequence[int]) -> str:
        """The text that ids spell; bytes that are not UTF-8 become U+FFFD."""
        spelled = self.spelled
        return b"".join([spelled[i] for i in ids]).decode("utf-8", "replace")

    def numbers(self, ids: Sequence[int]) -> str:
        """The decimal ids, joined by commas."""
        decimal = self.decimal
        return ",".join([decimal[i] for i in ids])


_ENCODERS: dict[str, PrefixEncoder] = {}


def encoder_of(shared: Broadcast) -> PrefixEncoder:
    """One encoder per worker process and vocabulary."""
    mark, vocabulary = shared.value
    if mark not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[mark] = PrefixEncoder(vocabulary)
    return _ENCODERS[mark]


def share_vocabulary(df: DataFrame, path: str) -> Broadcast:
    """The vocabulary at ``path``, read by the driver; its size is that of the file, whatever the data."""
    with open(path, "rb") as f:
        mark = sha256(f.read()).hexdigest()
    return df.sparkSession.sparkContext.broadcast((mark, read_vocabulary(path)))


def encode_to(df: DataFrame, path: str, fields: list[T.StructField], derive: Callable[[bytes, Vocabulary], tuple],
              text: str = "text") -> DataFrame:
    """Replace column ``text`` by what ``derive`` makes of a text's ids: one value per field.

    ``derive`` gets the ids as packed little-endian 32-bit integers, and the
    vocabulary, whose ``decode`` gives the text of such ids. See ``encode``.
    """
    rest = [f for f in df.schema.fields if f.name != text]
    if clash := {f.name for f in rest} & {f.name for f in fields}:
        raise ValueError(f"the frame already has columns {sorted(clash)}")
    shared = share_vocabulary(df, path)
    schema = T.StructType([*rest, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder_of(shared)
        vocabulary = Vocabulary(shared.value[1]["tokens"])
        kinds = [to_arrow_type(f.dataType) for f in fields]
        for batch in batches:
            rows = [derive(ids, vocabulary) for ids in coder.encode(batch.column(text).to_pylist())]
            new = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in rest), *new], schema.names)

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Replace column ``text`` by its token ids ``out`` (array of int).

    The ids are those of the tokenizer file at ``path`` without added special
    tokens; special tokens written in a text count as such. A null or empty text
    has no ids. Equal rows stay separate rows, an empty frame stays empty. Other
    columns pass through; one named ``out`` is refused.
    """
    return encode_to(df, path, [T.StructField(out, T.ArrayType(T.IntegerType()))],
                     lambda ids, _: (np.frombuffer(ids, "<i4"),), text)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """Replace column ``ids`` by the text its tokens spell, special tokens included.

    Bytes that are not UTF-8 become U+FFFD. Null or empty ids give an empty text;
    an unknown id is an error.
    """
    rest = [f for f in df.schema.fields if f.name != ids]
    if any(f.name == out for f in rest):
        raise ValueError(f"the frame already has a column {out}")
    shared = share_vocabulary(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(shared.value[1]["tokens"])
        for batch in batches:
            texts = [vocabulary.decode(x or ()) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in rest), pa.array(texts, pa.string())], [*(f.name for f in rest), out])

    return df.mapInArrow(run, T.StructType([*rest, T.StructField(out, T.StringType())]))
