"""Two tokenizers' tokens over the same bytes, aligned by merging their ends along merge paths.

Tokenizer A is a byte-level file, applied to a space and the text; B is a sentencepiece
model, applied to the text, which puts the space there itself. When both spell the same
bytes, the ends of their tokens are two rising lists. Merging them visits every stretch
of bytes that no end cuts: it lies in exactly one token of A and one of B, which is one
overlap (a link); where an end of A equals one of B, a group ends.

The merge is cut into pieces of equal work: a piece begins on every ``PIECE``-th diagonal
of the grid of A ends and B ends, and a binary search on the diagonal says how many ends
of each list lie before it. Pieces need nothing from each other and are merged side by
side in numpy, whether a text spans many pieces or a piece many texts. A piece numbers
its groups from 0; sums over the pieces before it stitch groups across pieces.

How many documents hold a pair of ids linked is counted in Spark. A task works on blocks
of documents of bounded size and writes, per block, its distinct pairs with the documents
that hold them, and, per document, its links as places in that list. So a pair comes to a
shuffle once a block, the sums come back to the block, and no task needs all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.byte_tokens import ByteTokenizer
from panelkit.llm.prefix_bpe import byte_symbols
from panelkit.session import materialise

# Ends that a piece merges.
PIECE = 1024
# Characters that are aligned together, and characters of a block.
STRETCH = 1 << 21
BLOCK = 1 << 23

LAST = np.iinfo(np.int64).max


def diagonal_splits(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many elements of ``a`` are among the first ``d`` of both lists, for every diagonal ``d``; ``a`` goes first on ties."""
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        mid = (low[open_] + high[open_]) // 2
        right = a[mid] <= b[diagonals[open_] - 1 - mid]
        low[open_[right]] = mid[right] + 1
        high[open_[~right]] = mid[~right]


def merge_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links and groups of two strictly rising lists of ends over the same bytes.

    Returns the tokens of A and of B of every link in order, the group of every
    link, and for every group the number of tokens of A and of B up to its end.
    """
    total = len(a) + len(b)
    starts = np.arange(0, total, piece)
    i = diagonal_splits(a, b, starts)
    j = starts - i
    ahead_a, ahead_b = np.append(a, LAST), np.append(b, LAST)
    behind_a = np.concatenate(([-1], a))
    steps = min(piece, total)
    at_a, at_b = np.empty((steps, len(starts)), np.int64), np.empty((steps, len(starts)), np.int64)
    cuts = np.empty((steps, len(starts)), bool)
    for step in range(steps):
        y = ahead_b[j]
        take = ahead_a[i] <= y
        at_a[step], at_b[step] = i, j
        # An end of B that equals the end of A just taken bounds no bytes, but ends a group.
        cuts[step] = ~take & (behind_a[i] == y)
        i = np.minimum(i + take, len(a))
        j = np.minimum(j + ~take, len(b))
    # A piece's groups are numbered from 0 and shifted by the groups that end in pieces before it.
    cuts = cuts.T.ravel()[:total]
    inside = np.add.reduceat(cuts, starts, dtype=np.int64) if total else np.zeros(0, np.int64)
    shift = np.repeat(np.cumsum(inside) - inside, np.diff(np.append(starts, total)))
    within = np.cumsum(cuts) - np.repeat(np.concatenate(([0], np.cumsum(inside)[:-1])) if total else inside, np.diff(np.append(starts, total)))
    at_a, at_b = at_a.T.ravel()[:total], at_b.T.ravel()[:total]
    return at_a[~cuts], at_b[~cuts], (shift + within)[~cuts], at_a[cuts], at_b[cuts] + 1


class Aligned:
    """The tokens, links and groups of some texts; ``*_of`` bounds each text's share of a flat array."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], size_a: np.ndarray, size_b: np.ndarray) -> None:
        self.a, self.b = (np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in (a, b))
        self.a_of, self.b_of = (np.concatenate(([0], np.cumsum([len(t) for t in x]))).astype(np.int64) for x in (a, b))
        self.link_a, self.link_b, _, self.group_a, self.group_b = merge_ends(np.cumsum(size_a[self.a]), np.cumsum(size_b[self.b]))
        self.links_of = np.searchsorted(self.link_a, self.a_of)
        self.groups_of = np.searchsorted(self.group_a, self.a_of, "right")
        self.groups_of[0] = 0


class Aligner:
    """Both tokenizers, the bytes of their tokens, and the alignment of texts."""

    def __init__(self, spec: str, model: bytes) -> None:
        self.coder = ByteTokenizer(spec, special_text=True)
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        symbols = byte_symbols()
        vocabulary = self.coder.tokenizer.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (1 + max(vocabulary.values()))
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(symbols[c] for c in token) if all(c in symbols for c in token) else token.encode()
        self.b_bytes = [bytes([int(self.pieces.id_to_piece(i)[3:5], 16)]) if self.pieces.is_byte(i)
                        else self.pieces.id_to_piece(i).replace("▁", " ").encode() for i in range(len(self.pieces))]
        self.a_size, self.b_size = (np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        # Decimal ids with the sign behind them: the last of a group's A, of its B, and any other.
        ends = ("|", ";", ",")
        self.a_text, self.b_text = (np.array([f"{i}{s}" for s in ends for i in range(len(x))], object) for x in (self.a_bytes, self.b_bytes))

    def align(self, texts: list[str | None]) -> Aligned:
        """Texts that are null, empty or spelt differently have no tokens."""
        full = [i for i, t in enumerate(texts) if t]
        nothing = np.zeros(0, np.int64)
        a, b = [nothing] * len(texts), [nothing] * len(texts)
        if full:
            coded_a = self.coder.encode([" " + texts[i] for i in full])
            coded_b = self.pieces.encode([texts[i] for i in full], num_threads=1)
            byte_a, byte_b = self.a_bytes.__getitem__, self.b_bytes.__getitem__
            for i, x, y in zip(full, coded_a, coded_b):
                x = np.frombuffer(x, "<u4")
                raw = (" " + texts[i]).encode()
                if b"".join(map(byte_b, y)) == raw and b"".join(map(byte_a, x.tolist())) == raw:
                    a[i], b[i] = x, np.array(y, np.int64)
        return Aligned(a, b, self.a_size, self.b_size)

    def digests(self, found: Aligned) -> list[str]:
        """SHA-256 of every text's groups, written ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
        groups = np.arange(len(found.group_a))
        begin_a, begin_b = (np.concatenate(([0], x[:-1])) if len(x) else x for x in (found.group_a, found.group_b))
        of_a, of_b = np.repeat(groups, found.group_a - begin_a), np.repeat(groups, found.group_b - begin_b)
        n_a, n_b = len(found.a), len(found.b)
        text = np.empty(n_a + n_b, object)
        ends_a, ends_b = np.arange(1, n_a + 1) == found.group_a[of_a], np.arange(1, n_b + 1) == found.group_b[of_b]
        text[np.arange(n_a) + begin_b[of_a]] = self.a_text[found.a + np.where(ends_a, 0, 2) * len(self.a_bytes)]
        text[np.arange(n_b) + found.group_a[of_b]] = self.b_text[found.b + np.where(ends_b, 1, 2) * len(self.b_bytes)]
        text = text.tolist()
        bounds = (found.a_of + found.b_of).tolist()
        return [sha256("".join(text[x:y])[:-1].encode()).hexdigest() if y > x else "" for x, y in zip(bounds, bounds[1:])]


_ALIGNERS: dict[str, Aligner] = {}


def _aligner(shared: Broadcast) -> Aligner:
    """One per worker process and pair of files."""
    mark, spec, model = shared.value
    if mark not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[mark] = Aligner(spec, model)
    return _ALIGNERS[mark]


def _share(df: DataFrame, path_a: str, path_b: str) -> Broadcast:
    """Both files, read by the driver; their sizes do not depend on the data."""
    with open(path_a, encoding="utf-8") as f, open(path_b, "rb") as g:
        spec, model = f.read(), g.read()
    return df.sparkSession.sparkContext.broadcast((sha256(spec.encode() + model).hexdigest(), spec, model))


def _stretches(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Rows and their texts, a bounded number of characters at a time."""
    for batch in batches:
        texts, first, size = batch.column(text).to_pylist(), 0, 0
        for i, t in enumerate(texts):
            size += len(t or "")
            if size >= STRETCH or i + 1 == len(texts):
                yield batch.slice(first, i + 1 - first), texts[first:i + 1]
                first, size = i + 1, 0


def _others(df: DataFrame, text: str, new: list[T.StructField]) -> list[T.StructField]:
    rest = [f for f in df.schema.fields if f.name != text]
    if clash := {f.name for f in rest} & {f.name for f in new}:
        raise ValueError(f"the frame already has columns {sorted(clash)}")
    return rest


def _lists(bounds: np.ndarray, **columns: np.ndarray) -> pa.Array:
    """Lists of 32-bit integers, or of structs of them if there are several columns."""
    arrays = [pa.array(c, pa.int32()) for c in columns.values()]
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), arrays[0] if len(arrays) == 1 else
                                    pa.StructArray.from_arrays(arrays, list(columns)))


def _pair_type(a: str, b: str) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(a, T.IntegerType()), T.StructField(b, T.IntegerType())]))


ALIGNMENT = [T.StructField("a_ids", T.ArrayType(T.IntegerType())), T.StructField("b_ids", T.ArrayType(T.IntegerType())),
             T.StructField("groups", _pair_type("a_end", "b_end")), T.StructField("links", _pair_type("a", "b"))]


def align(df: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """Replace column ``text`` by its alignment.

    ``a_ids`` and ``b_ids`` are the ids; ``groups`` counts the tokens of A and B up to
    the end of every group; ``links`` holds the places (from 0) of every two tokens that
    share bytes. Strings of special tokens are plain text. Texts that are null, empty,
    or not spelt alike by both (as by a model that changes characters) have empty lists.
    Equal rows stay separate, an empty frame stays empty, other columns pass through;
    one with a new column's name is refused.
    """
    rest = _others(df, text, ALIGNMENT)
    shared = _share(df, path_a, path_b)
    schema = T.StructType([*rest, *ALIGNMENT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in _stretches(batches, text):
            found = _aligner(shared).align(texts)
            before = lambda of, each: np.repeat(of[:-1], np.diff(each))
            new = [_lists(found.a_of, a=found.a), _lists(found.b_of, b=found.b),
                   _lists(found.groups_of, a_end=found.group_a - before(found.a_of, found.groups_of),
                          b_end=found.group_b - before(found.b_of, found.groups_of)),
                   _lists(found.links_of, a=found.link_a - before(found.a_of, found.links_of),
                          b=found.link_b - before(found.b_of, found.links_of))]
            yield pa.RecordBatch.from_arrays([*(rows.column(f.name) for f in rest), *new], schema.names)

    return df.mapInArrow(run, schema)


def pack_numbers(values: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Numbers below 2^35 as bytes of seven bits, the lowest first, and where each begins."""
    sizes = 1 + sum((values >> shift > 0).astype(np.int64) for shift in (7, 14, 21, 28))
    at = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    for k in range(5):
        some = np.flatnonzero(sizes > k)
        out[at[some] + k] = (values[some] >> 7 * k & 127) | np.where(sizes[some] > k + 1, 128, 0)
    return out.tobytes(), np.append(at, len(out))


def unpack_numbers(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of ``pack_numbers``, and where each begins."""
    raw = np.frombuffer(data, np.uint8).astype(np.int64)
    if not len(raw):
        return raw, raw
    at = np.concatenate(([0], np.flatnonzero(raw < 128)[:-1] + 1))
    place = np.arange(len(raw)) - np.repeat(at, np.diff(np.append(at, len(raw))))
    return np.add.reduceat((raw & 127) << 7 * place, at), at


STATISTICS = [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] + [
    T.StructField("groups_sha256", T.StringType())]
_CODED = [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")] + [T.StructField("groups_sha256", T.StringType())]
_PAIRS = T.ArrayType(T.StructType([T.StructField("pair", T.LongType()), T.StructField("held", T.LongType())]))


class _Block:
    """Documents of one task whose links are listed together."""

    def __init__(self, number: int) -> None:
        self.number, self.size, self.rows = number, 0, 0
        self.parts: list[tuple[pa.Array, list[pa.Array]]] = []
        self.pairs: list[np.ndarray] = []
        self.owner: list[np.ndarray] = []

    def add(self, rest: pa.Array, texts: list[str | None], aligner: Aligner) -> None:
        found = aligner.align(texts)
        self.pairs.append(found.a[found.link_a] << 32 | found.b[found.link_b])
        self.owner.append(self.rows + np.repeat(np.arange(len(texts)), np.diff(found.links_of)))
        counts = [pa.array(np.diff(of)) for of in (found.a_of, found.b_of, found.groups_of, found.links_of)]
        self.parts.append((rest, [*counts, pa.array(aligner.digests(found), pa.string())]))
        self.rows += len(texts)
        self.size += sum(len(t or "") for t in texts)

    def flush(self, schema: pa.Schema) -> pa.Table:
        """A row per document with its links as gaps between places in the block's pairs and their numbers, and one with the pairs."""
        pairs, place = np.unique(np.concatenate(self.pairs), return_inverse=True)
        held, times = np.unique(np.concatenate(self.owner) * max(len(pairs), 1) + place, return_counts=True)
        owner, code = np.divmod(held, max(len(pairs), 1))
        first = np.searchsorted(owner, np.arange(self.rows + 1))
        gaps = np.diff(code, prepend=0)
        begins = first[:-1][first[:-1] < first[1:]]
        gaps[begins] = code[begins]
        data, at = pack_numbers(np.stack((gaps, times), 1).ravel())
        bounds = at[2 * first]
        links = [data[x:y] for x, y in zip(bounds.tolist(), bounds[1:].tolist())]
        listed = pa.array([[{"pair": p, "held": h} for p, h in zip(pairs.tolist(), np.bincount(code, minlength=len(pairs)).tolist())]],
                          schema.field("pairs").type)
        rest = pa.concat_arrays([r for r, _ in self.parts])
        columns = [pa.concat_arrays([new[k] for _, new in self.parts]) for k in range(len(_CODED))]
        documents = [rest, pa.array(np.full(self.rows, self.number)), *columns, pa.array(links, pa.binary()), pa.nulls(self.rows, listed.type)]
        dictionary = [pa.nulls(1, rest.type), pa.array([self.number], pa.int64()), *(pa.nulls(1, c.type) for c in columns),
                      pa.nulls(1, pa.binary()), listed]
        return pa.concat_tables([pa.Table.from_arrays(x, schema=schema) for x in (documents, dictionary)])


def _block_sums(rows: pa.Table, pairs: pa.Table) -> pa.Table:
    """Sums over the links of every document of a block, from the counts of the block's pairs."""
    size = len(pairs)
    code = pairs.column("code").to_numpy()
    count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    count[code], best[code] = pairs.column("n").to_numpy(), pairs.column("best").to_numpy()
    packed = rows.column("links").to_pylist()
    numbers, at = unpack_numbers(b"".join(packed))
    # Gaps and times take turns; a document begins where its bytes do.
    first = np.searchsorted(at, np.concatenate(([0], np.cumsum([len(p) for p in packed])))) // 2
    gaps, times = numbers[::2], numbers[1::2]
    run = np.concatenate(([0], np.cumsum(gaps)))
    place = run[1:] - np.repeat(run[first[:-1]], np.diff(first))
    sums = [np.concatenate(([0], np.cumsum(times * x[place])))[first] for x in (best, count)]
    out = rows.select(["rest", *(f.name for f in _CODED)])
    for name, s in zip(("n_best", "count_sum"), sums):
        out = out.append_column(name, pa.array(np.diff(s)))
    return out


def link_statistics(df: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """Replace column ``text`` by numbers of its alignment (see ``align``).

    ``n_a``, ``n_b``, ``n_groups`` and ``n_links`` count tokens, groups and links. An id
    pair's count is the number of documents of the frame that hold it linked; ``count_sum``
    adds the counts of a document's links, ``n_best`` counts those whose count is the
    highest of their A id, ties included. ``groups_sha256`` digests the groups' ids. Texts
    without tokens have zeros and an empty digest. Each row is a document, equal ones too.
    An empty frame stays empty; other columns pass through, one with a new column's name
    is refused.
    """
    rest = _others(df, text, STATISTICS)
    shared = _share(df, path_a, path_b)
    # Other columns travel in one struct, so that none can clash with a helper column.
    packed = df.select(F.struct(*[F.col(f"`{f.name}`") for f in rest]).alias("rest") if rest else F.struct(F.lit(0).alias("none")).alias("rest"),
                       F.col(f"`{text}`").alias("text"))
    schema = T.StructType([T.StructField("rest", packed.schema["rest"].dataType), T.StructField("block", T.LongType()), *_CODED,
                           T.StructField("links", T.BinaryType()), T.StructField("pairs", _PAIRS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block, arrow = TaskContext.get().partitionId() << 32, None, None
        for rows, texts in _stretches(batches, "text"):
            if block is None:
                block = _Block(number)
            arrow = pa.schema([pa.field("rest", rows.schema.field("rest").type), pa.field("block", pa.int64()),
                               *(pa.field(f.name, pa.string() if f.name == "groups_sha256" else pa.int64()) for f in _CODED),
                               pa.field("links", pa.binary()),
                               pa.field("pairs", pa.list_(pa.struct([("pair", pa.int64()), ("held", pa.int64())])))])
            block.add(rows.column("rest"), texts, _aligner(shared))
            if block.size >= BLOCK:
                yield from block.flush(arrow).to_batches()
                number, block = number + 1, None
        if block is not None:
            yield from block.flush(arrow).to_batches()

    coded = materialise(packed.mapInArrow(run, schema), "aligned")
    pairs = coded.where("pairs is not null").select("block", F.posexplode("pairs").alias("code", "p")).select(
        "block", F.col("code").cast("bigint").alias("code"), "p.pair", "p.held")
    counts = pairs.groupBy("pair").agg(F.sum("held").alias("n"))
    # The pairs of one A id are at most as many as B has ids.
    highest = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))
    counts = counts.select("pair", "n", (F.col("n") == highest).cast("bigint").alias("best"))
    back = pairs.join(counts, "pair").select(F.col("block").alias("of"), "code", "n", "best")
    documents = coded.where("pairs is null").drop("pairs")
    out_schema = T.StructType([coded.schema["rest"], *_CODED, *STATISTICS[4:6]])
    summed = documents.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(_sums_of(), out_schema)
    return summed.select(*([F.col(f"rest.`{f.name}`").alias(f.name) for f in rest]), *[f.name for f in STATISTICS])


def _sums_of() -> Callable[[pa.Table, pa.Table], pa.Table]:
    def of(rows: pa.Table, pairs: pa.Table) -> pa.Table:
        return _block_sums(rows, pairs)

    return of
