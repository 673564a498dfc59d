"""Token pieces packed into sequences by local search.

Documents are tokenized, ended by a separator and cut only where they exceed a
sequence. Pieces that fill a sequence are done. The others are dealt into groups
of a few thousand, all with the same mix of sizes; each group is packed by
itself: best fit gives a start; then the bins are filled one by one from all
emptier ones, and the emptiest bins give their pieces away. A piece moves to a
fuller bin, or is exchanged one for one, two for one or one for two with pieces of
it, whenever that adds to the fuller bin without overfilling it. Each step raises
the sum of squared fills, so the search ends; bins that become empty are gone. The emptiest bins of all groups are then packed again together, in fewer
groups, until one group is left. A task holds one group.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from hashlib import sha256
from heapq import heapify, heappop, heappush
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer, normalizers
from tokenizers.pre_tokenizers import CharDelimiterSplit

from panelkit.llm.hash_tree import number_within
from panelkit.llm.names import free_names
from panelkit.llm.prefix_bpe import byte_symbols
from panelkit.llm.word_memo import Learnt, WordMemo
from panelkit.llm.workers import one_thread, tidy
from panelkit.session import materialise

# Pieces of a group, and the share of its bins that may be packed again in the next round.
GROUP = 4096
AGAIN = 0.25
# A bin is worth packing again while this share of it is free.
SLACK = 0.02
# What the last token of a word ends with (a fixed value).
WORD_END = "</w>"
# Emptiest bins tried in vain, one after the other, before the search of a group ends.
PATIENCE = 8
# Words of the memo before half of them go. Longer words are not kept.
MEMO = 1 << 19
LONGEST = 64
# Characters whose words are looked up together.
STRETCH = 1 << 20


# A word that the tokenizer cuts into its letters and the sign behind them, if any.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]?)").fullmatch


class WordTokenizer:
    """Ids by a tokenizer that never looks across white space; known words come from a bounded memo."""

    def __init__(self, spec: str) -> None:
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # The same model for words spelt in small letters and the stand-ins of bytes, with a space between them.
        self.model = Tokenizer.from_str(spec)
        self.model.no_truncation()
        self.model.no_padding()
        self.model.encode_special_tokens = True
        self.model.normalizer = normalizers.Sequence([])
        self.model.pre_tokenizer = CharDelimiterSplit(" ")
        self.symbols = {b: c for c, b in byte_symbols().items()} | {32: " "}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(1 + max(vocabulary.values()), bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.memo = WordMemo(MEMO, LONGEST, self._learn)

    def _words(self, text: str | None) -> list[str]:
        if not text:
            return []
        # These four separate words for Python, but are symbols for the tokenizer.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [text]
        return text.split()

    def _learn(self, words: list[str]) -> Iterator[Learnt]:
        """Plain words are given to the library as one text, cut into letters and signs, which costs it less a word."""
        plain, parts, pieces, odd = [], [], [0], []
        for i, word in enumerate(words):
            match = PLAIN(word)
            if match is None:
                odd.append(i)
                continue
            plain.append(i)
            parts.append(match[1])
            if match[2]:
                parts.append(match[2])
            pieces.append(len(parts))
        if plain:
            spelt = " ".join(parts).lower().encode().decode("latin-1").translate(self.symbols)
            ids = np.array(self.model.encode_batch_fast([spelt], add_special_tokens=False)[0].ids, "<u4")
            # Every part ends with the one token that ends a word.
            ends = np.concatenate(([0], np.flatnonzero(self.ends[ids]) + 1))
            if len(ends) != len(parts) + 1:
                raise ValueError("the tokenizer does not mark the ends of words")
            yield plain, ids, np.diff(ends[pieces])
        if odd:
            coded = [np.array(c.ids, "<u4") for c in
                     self.tokenizer.encode_batch_fast([words[i] for i in odd], add_special_tokens=False)]
            yield odd, np.concatenate(coded), np.array([len(x) for x in coded], np.int64)

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        words, ends = [], [0]
        for text in texts:
            words += self._words(text)
            ends.append(len(words))
        ids, at = self.memo.ids_of(words)
        ids, at = ids.tobytes(), (4 * at[ends]).tolist()
        return [ids[x:y] for x, y in zip(at, at[1:])]

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Packed little-endian unsigned 32-bit ids of every text, a bounded stretch at a time."""
        some, size = [], 0
        for text in texts:
            some.append(text)
            size += len(text or "")
            if size >= STRETCH:
                yield from self.encode_all(some)
                some, size = [], 0
        if some:
            yield from self.encode_all(some)


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer_of(shared: Broadcast) -> WordTokenizer:
    """One tokenizer per worker process and file."""
    mark, spec = shared.value
    one_thread()
    if mark not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[mark] = WordTokenizer(spec)
    return _TOKENIZERS[mark]


PIECE_FIELDS = [T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]


def token_pieces(df: DataFrame, path: str, capacity: int, end: int, text: str = "text", ids: str | None = None) -> DataFrame:
    """One row per piece of a document, in place of column ``text``.

    A document is its ids under the word tokenizer at ``path`` and the id ``end``,
    so a null or empty text is one piece of length 1. Pieces are ``capacity`` long,
    the last of a document may be shorter. Column ``ids`` holds the ids, if named.
    Other columns pass through; names of the new ones must be free.
    """
    rest = [f for f in df.schema.fields if f.name != text]
    new = [*PIECE_FIELDS, *([T.StructField(ids, T.ArrayType(T.IntegerType()))] if ids else [])]
    if clash := {f.name for f in rest} & {f.name for f in new}:
        raise ValueError(f"the frame already has columns {sorted(clash)}")
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    shared = df.sparkSession.sparkContext.broadcast((sha256(spec.encode()).hexdigest(), spec))
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer_of(shared)
        for batch in batches:
            row, piece, start, length, crc, cuts = [], [], [], [], [], []
            for i, coded in enumerate(coder.encode(batch.column(text).to_pylist())):
                coded += last
                for k, at in enumerate(range(0, len(coded), 4 * capacity)):
                    cut = coded[at:at + 4 * capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(cut) // 4)
                    crc.append(zlib.crc32(cut))
                    if ids:
                        cuts.append(np.frombuffer(cut, "<i4"))
            kept = batch.take(pa.array(row, pa.int64()))
            columns = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            if ids:
                columns.append(pa.array(cuts, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([*(kept.column(f.name) for f in rest), *columns],
                                             [*(f.name for f in rest), *(f.name for f in new)])
        # The worker may serve another stage next; reading the file again costs a task little.
        del coder
        _TOKENIZERS.clear()
        tidy()

    return df.mapInArrow(run, T.StructType([*rest, *new]))


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Items by falling size, each into the fullest bin that has room for it."""
    bins: list[list[int]] = []
    gaps: list[tuple[int, int]] = []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = bisect_left(gaps, (sizes[item], -1))
        if at == len(gaps):
            gap, chosen = capacity, len(bins)
            bins.append([])
        else:
            gap, chosen = gaps.pop(at)
        bins[chosen].append(item)
        insort(gaps, (gap - sizes[item], chosen))
    return bins


def best_exchange(into: list[int], out_of: list[int], gap: int, sizes: list[int]) -> tuple[int, tuple, tuple]:
    """The exchange that adds most to ``into``, up to ``gap``: what it adds, what comes in and what goes out."""
    best: tuple[int, tuple, tuple] = (0, (), ())
    single = [(sizes[x], (x,)) for x in out_of]
    double = [(a + b, x + y) for (a, x), (b, y) in combinations(single, 2)]
    going = [(0, ()), *((sizes[x], (x,)) for x in into)]
    pairs = [(sizes[x] + sizes[y], (x, y)) for x, y in combinations(into, 2)]
    for incoming, outgoing in ((single, going), (double, going[1:]), (single, pairs)):
        for more, x in incoming:
            for less, y in outgoing:
                if best[0] < more - less <= gap:
                    best = (more - less, x, y)
    return best


def empty_bins(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """Exchange pieces towards fuller bins until no bin of the emptiest can be emptied further."""
    bins = [list(b) for b in bins]
    fill = [sum(sizes[i] for i in b) for b in bins]
    fewest = -(-sum(fill) // capacity)
    alive, stuck = {b for b in range(len(bins)) if bins[b]}, set()
    while len(alive) > fewest and len(stuck) < min(PATIENCE, len(alive)):
        giver = min(alive - stuck, key=lambda b: (fill[b], b))
        gave = False
        for taker in sorted(alive - {giver}, key=lambda b: (-fill[b], b)):
            while bins[giver] and fill[giver] <= fill[taker] < capacity:
                more, come, go = best_exchange(bins[taker], bins[giver], capacity - fill[taker], sizes)
                if not more:
                    break
                bins[taker] = [i for i in bins[taker] if i not in go] + list(come)
                bins[giver] = [i for i in bins[giver] if i not in come] + list(go)
                fill[taker] += more
                fill[giver] -= more
                gave = True
            if not bins[giver]:
                break
        if not bins[giver]:
            alive.discard(giver)
            stuck.clear()
        elif not gave:
            stuck.add(giver)
    return [bins[b] for b in sorted(alive)]


def fill_up(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """Fill bins one by one, the fullest first, by exchanges with all emptier ones.

    A bin takes in the piece that adds most, for nothing, for one of its pieces or
    for two of them; the pieces of emptier bins are kept sorted by size.
    """
    bins = [list(b) for b in bins]
    fill = [sum(sizes[i] for i in b) for b in bins]
    home = {i: b for b, items in enumerate(bins) for i in items}
    waiting = [(-fill[b], b) for b in range(len(bins))]
    heapify(waiting)
    pool = sorted((sizes[i], i) for i in home)
    done: set[int] = set()
    while waiting:
        negative, taker = heappop(waiting)
        if taker in done or -negative != fill[taker]:
            continue
        done.add(taker)
        for i in bins[taker]:
            del pool[bisect_left(pool, (sizes[i], i))]
        while fill[taker] < capacity and bins[taker]:
            gap, best = capacity - fill[taker], (0, -1, ())
            for out in ((), *((i,) for i in bins[taker]), *combinations(bins[taker], 2)):
                less = sum(sizes[i] for i in out)
                at = bisect_left(pool, (less + gap + 1, -1)) - 1
                if at >= 0 and pool[at][0] - less > best[0]:
                    best = (pool[at][0] - less, pool[at][1], out)
            more, item, out = best
            if not more:
                break
            giver = home[item]
            del pool[bisect_left(pool, (sizes[item], item))]
            bins[giver].remove(item)
            bins[taker].append(item)
            home[item] = taker
            for i in out:
                bins[taker].remove(i)
                bins[giver].append(i)
                home[i] = giver
                insort(pool, (sizes[i], i))
            fill[taker] += more
            fill[giver] -= more
            heappush(waiting, (-fill[giver], giver))
    return [b for b in bins if b]


def pack_group(sizes: list[int], capacity: int) -> list[list[int]]:
    return empty_bins(fill_up(best_fit(sizes, capacity), sizes, capacity), sizes, capacity)


def _packer(size: str, capacity: int, last: bool, number: str, place: str, open_: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def of(rows: pd.DataFrame) -> pd.DataFrame:
        # Bins depend on nothing but the sizes of the group.
        rows = rows.sort_values(size, ascending=False, kind="stable", ignore_index=True)
        numbers, places, again = _pack_sizes(rows[size].tolist(), capacity, last)
        return rows.assign(**{number: np.array(numbers, np.int64), place: np.array(places, np.int64), open_: np.array(again, bool)})

    return of


def _pack_sizes(sizes: list[int], capacity: int, last: bool) -> tuple[list[int], list[int], list[bool]]:
    """The bin of every item, its place there, and whether the bin is packed again."""
    bins = pack_group(sizes, capacity)
    fills = [sum(sizes[i] for i in b) for b in bins]
    loose = [b for b in sorted(range(len(bins)), key=lambda b: (fills[b], b)) if capacity - fills[b] >= SLACK * capacity]
    again = set() if last else set(loose[:max(1, int(AGAIN * len(bins)))])
    number, offset, open_ = [0] * len(sizes), [0] * len(sizes), [False] * len(sizes)
    for b, items in enumerate(bins):
        at = 0
        for i in items:
            number[i], offset[i], open_[i] = b, at, b in again
            at += sizes[i]
    return number, offset, open_


def dealt(df: DataFrame, size: str, groups: int, out: str) -> DataFrame:
    """Add ``out``, a group from 0, so that every group has the same mix of sizes.

    All rows are numbered by falling size and dealt in turn. Rows of one size differ in
    nothing that matters, so the sizes of a group do not depend on how the frame is split.
    """
    key, n, before, slot = free_names(df.columns, "_size", "_n", "_before", "_slot")
    counts = df.groupBy(F.col(size).alias(key)).agg(F.count(F.lit(1)).alias(n))
    # One row per size.
    larger = Window.orderBy(F.col(key).desc()).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(key, F.coalesce(F.sum(n).over(larger), F.lit(0)).alias(before))
    numbered = number_within(df, size, slot).join(F.broadcast(counts), F.col(size) == F.col(key))
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns], ((F.col(before) + F.col(slot)) % groups).alias(out))


def pack(df: DataFrame, capacity: int, size: str = "length", sequence: str = "sequence_id", offset: str = "offset",
         group: int = GROUP) -> DataFrame:
    """Add the sequence of every row and its place there.

    ``size`` is an integer from 1 to ``capacity``; anything else is an error.
    Sequences hold at most ``capacity``; places are gapless from 0. Equal rows
    are separate pieces. How many sequences there are depends on the sizes alone.
    An empty frame stays empty. Other columns pass through, whatever their names;
    only those of the two new columns are refused.
    """
    if clash := {sequence, offset} & set(df.columns):
        raise ValueError(f"the frame already has columns {sorted(clash)}")
    row, of, number, place, open_ = free_names([*df.columns, sequence, offset], "_id", "_group", "_bin", "_offset", "_open")
    wrong = F.col(size).isNull() | (F.col(size) < 1) | (F.col(size) > capacity)
    sized = df.withColumn(size, F.when(wrong, F.raise_error(F.lit(f"{size} must be from 1 to {capacity}"))).otherwise(F.col(size)))
    rows = materialise(sized, "pieces").withColumn(row, F.monotonically_increasing_id())
    columns = [F.col(f"`{c}`") for c in df.columns]
    done = [rows.where(F.col(size) == capacity).select(
        *columns, F.col(row).alias(sequence), F.lit(0).cast("bigint").alias(offset))]
    todo = rows.where(F.col(size) < capacity).select(*columns)
    schema = T.StructType([*todo.schema.fields, T.StructField(of, T.LongType()), T.StructField(number, T.LongType()),
                           T.StructField(place, T.LongType()), T.StructField(open_, T.BooleanType())])
    level, count = 1, todo.count()
    while count:
        groups = -(-count // group)
        last = groups == 1
        packer = _packer(size, capacity, last, number, place, open_)
        packed = materialise(dealt(todo, size, groups, of).groupBy(of).applyInPandas(packer, schema), "packed")
        # Levels and groups share a number with the bin; sequences of one piece have small numbers.
        name = F.lit(level << 58) + F.shiftleft(F.col(of), 24) + F.col(number)
        done.append(packed.where(~F.col(open_)).select(*columns, name.alias(sequence), F.col(place).alias(offset)))
        todo = packed.where(F.col(open_)).select(*columns)
        level, count = level + 1, 0 if last else todo.count()
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def assemble(pieces: DataFrame, ids: str = "ids", sequence: str = "sequence_id", offset: str = "offset") -> DataFrame:
    """The ids of every sequence in order; a sequence is at most ``capacity`` long."""
    placed = F.array_sort(F.collect_list(F.struct(F.col(offset), F.col(ids))))
    return pieces.groupBy(sequence).agg(F.flatten(F.transform(placed, lambda p: p[ids])).alias(ids))
