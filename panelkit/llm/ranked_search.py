"""Ranked search by terms, one term at a time with a limited number of accumulators.

Documents are indexed in blocks of bounded size: a block lists, for every term of the
queries, its documents and how often they hold the term. Counts of documents per term
and the totals are summed in Spark, so all blocks score alike.

A task takes the blocks it has, one after the other, and every query in turn. Terms are
taken from the rarest on, and each adds to an accumulator per document that holds it.
Before a term, the most that it and all later terms can add to a document of the block is
compared with the ``k``-th highest partial score, over this block's accumulators and the
best documents of the blocks before. Once that is higher, no new accumulator is made,
as its document could not come under the best ``k``; those that exist are updated by all
later terms, so their scores are exact. The best ``k`` of every task are ranked in Spark.

Queries of any number are handled in groups of bounded size; the index of a group holds
the group's terms.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.session import materialise

# Words of the queries that are searched together, whatever their number.
GROUP_WORDS = 1 << 18
# Bytes of text and documents of a block.
BLOCK_BYTES = 1 << 23
BLOCK_DOCUMENTS = 1 << 16
# Tasks whose best documents are ranked together first.
FOLD = 1024
# What a term adds is its weight times SCALE * tf div (1000 * tf + 20 * m); m of a document lies at 50 and its share of 50.
SCALE = 1_000_000_000

# A-Z become small letters, all other bytes that are no term's become spaces.
FOLDED = bytes(b if chr(b).isalnum() and b < 128 or b > 127 else 32 for b in bytes(range(128)).lower() + bytes(range(128, 256)))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8: runs of ASCII letters and digits, A-Z in small letters, and of all other characters beyond ASCII."""
    return text.translate(FOLDED).split()


INDEX = T.StructType([
    T.StructField("documents", T.LongType()), T.StructField("words", T.LongType()),
    T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("sizes", T.ArrayType(T.LongType())),
    T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("lengths", T.ArrayType(T.IntegerType())),
    T.StructField("places", T.ArrayType(T.IntegerType())), T.StructField("times", T.ArrayType(T.IntegerType()))])


def _one(values: np.ndarray | list, kind: pa.DataType) -> pa.Array:
    return pa.array([values], pa.list_(kind))


def index_block(ids: list[int | None], texts: list[bytes], numbers: dict[bytes, int]) -> pa.RecordBatch:
    """One row: the postings of the terms in ``numbers``, by term and then by document."""
    sizes, found, owner = [], [], []
    look = numbers.get
    for place, text in enumerate(texts):
        words = terms_of(text)
        sizes.append(len(words))
        known = [x for x in map(look, words) if x is not None]
        found.extend(known)
        owner.append(len(known))
    key = np.array(found, np.int64) * max(len(texts), 1) + np.repeat(np.arange(len(texts)), owner)
    key, times = np.unique(key, return_counts=True)
    term, place = np.divmod(key, max(len(texts), 1))
    terms, lengths = np.unique(term, return_counts=True)
    return pa.RecordBatch.from_arrays(
        [pa.array([sum(s > 0 for s in sizes)]), pa.array([sum(sizes)]), _one(ids, pa.int64()), _one(sizes, pa.int64()),
         *(_one(x.astype(np.int32), pa.int32()) for x in (terms, lengths, place, times))], INDEX.names)


def index_documents(documents: DataFrame, numbers: dict[bytes, int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of all documents for numbered terms, in blocks."""
    shared = documents.sparkSession.sparkContext.broadcast(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(i)
                texts.append(t)
                size += len(t)
                if size >= BLOCK_BYTES or len(ids) == BLOCK_DOCUMENTS:
                    yield index_block(ids, texts, shared.value)
                    ids, texts, size = [], [], 0
        if ids:
            yield index_block(ids, texts, shared.value)

    rows = documents.select(F.col(f"`{doc_id}`").cast("bigint").alias("id"),
                            F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, INDEX)


class Best:
    """The best documents of a query so far: highest score first, then null ids, then smaller ids."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.scores, self.ids, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        scores, ids, known = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.known, known)))
        kept = np.lexsort((ids, known, -scores))[:self.k]
        self.scores, self.ids, self.known = scores[kept], ids[kept], known[kept]


class Block:
    """Postings of a block with what each adds before its term's weight."""

    def __init__(self, row: dict, total_documents: int, total_words: int) -> None:
        ids = row["ids"]
        self.known = ids.is_valid().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        sizes, lengths, self.places, times = (row[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("sizes", "lengths", "places", "times"))
        m = 100 - 50 + 50 * sizes * total_documents // max(total_words, 1)
        self.adds = SCALE * times // (1000 * times + 20 * m[self.places])
        ends = np.cumsum(lengths)
        terms = row["terms"].to_numpy(zero_copy_only=False).tolist()
        self.lists = {t: (x, y) for t, x, y in zip(terms, (ends - lengths).tolist(), ends.tolist())}
        most = np.maximum.reduceat(self.adds, ends - lengths) if len(terms) else ends
        self.most = dict(zip(terms, most.tolist()))


def search_block(block: Block, query: list[tuple[int, int]], best: Best) -> int:
    """Bring a query's best documents up to date with a block; ``query`` has terms and weights, the rarest first.

    Returns the number of accumulators.
    """
    query = [(term, weight) for term, weight in query if weight and term in block.lists]
    if not query:
        return 0
    rest = np.cumsum([weight * block.most[term] for term, weight in query][::-1])[::-1].tolist()
    scores = np.zeros(len(block.ids), np.int64)
    closed, k = False, best.k
    for (term, weight), bound in zip(query, rest):
        first, end = block.lists[term]
        places, adds = block.places[first:end], block.adds[first:end]
        if not closed:
            partial = np.concatenate((best.scores, scores[scores > 0]))
            closed = len(partial) >= k and int(np.partition(partial, len(partial) - k)[len(partial) - k]) > bound
            if closed:
                alive = scores > 0
        if closed:
            held = alive[places]
            places, adds = places[held], adds[held]
        scores[places] += weight * adds
    made = np.flatnonzero(scores)
    if len(best.scores) == k:
        made = made[scores[made] >= best.scores[-1]]
    best.add(scores[made], block.ids[made], block.known[made])
    return len(made)


FOUND = T.StructType([T.StructField("task", T.IntegerType()), T.StructField("query", T.IntegerType()),
                      T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])


def _best_rows(found: DataFrame, by: list, k: int) -> DataFrame:
    window = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def _search_group(documents: DataFrame, queries: list[tuple], k: int, doc_id: str, text: str, item_type: T.DataType) -> DataFrame:
    spark = documents.sparkSession
    words = [list(dict.fromkeys(terms_of((t or "").encode()))) for _, t in queries]
    numbers = {w: i for i, w in enumerate(dict.fromkeys(w for ws in words for w in ws))}
    index = materialise(index_documents(documents, numbers, doc_id, text), "index")
    totals = index.agg(F.coalesce(F.sum("documents"), F.lit(0)).alias("documents"), F.coalesce(F.sum("words"), F.lit(0)).alias("words")).first()
    # One row per term of the queries.
    held = dict(index.select(F.explode(F.arrays_zip("terms", "lengths")).alias("t")).groupBy("t.terms").agg(
        F.sum("t.lengths").alias("n")).toLocalIterator())
    weight = {t: math.floor(1000 * math.log((2 * totals.documents + 2) / (2 * n + 1))) for t, n in held.items()}
    plans = [sorted(((numbers[w], weight[numbers[w]]) for w in ws if numbers[w] in held), key=lambda t: (held[t[0]], t[0])) for ws in words]
    shared = spark.sparkContext.broadcast((plans, totals.documents, totals.words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans, total_documents, total_words = shared.value
        best = [Best(k) for _ in plans]
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block({c: batch.column(c)[i].values for c in ("ids", "sizes", "terms", "lengths", "places", "times")},
                              total_documents, total_words)
                for plan, found in zip(plans, best):
                    search_block(block, plan, found)
        task = TaskContext.get().partitionId()
        for query, found in enumerate(best):
            if n := len(found.ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, task, np.int32)), pa.array(np.full(n, query, np.int32)),
                     pa.array(found.ids, mask=~found.known), pa.array(found.scores)], FOUND.names)

    found = index.select("ids", "sizes", "terms", "lengths", "places", "times").mapInArrow(run, FOUND)
    folded = _best_rows(found, ["query", F.floor(F.col("task") / FOLD)], k)
    ranked = _best_rows(folded, ["query"], k).select("query", "rank", "doc_id", "score")
    items = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(queries)],
                                  T.StructType([T.StructField("query", T.IntegerType()), T.StructField("item_id", item_type)]))
    return ranked.join(items, "query").select("item_id", "rank", "doc_id", "score")


def search(documents: DataFrame, queries: DataFrame, k: int = 50, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``k`` highest-scoring documents of every query, all if fewer score above 0.

    Columns ``item_id``, ``rank`` (from 1), ``doc_id`` (long) and ``score`` (long). N documents
    have a term, L terms all in all; a document of n terms has m = 50 + 50 * n * N div L, a term
    in df documents weighs floor(1000 * ln((2 N + 2) / (2 df + 1))), and adds its weight times
    10^9 tf div (1000 tf + 20 m) to a document that holds it tf times. Equal scores go by
    ascending ``doc_id``, null first; rows of one id are separate documents. Null and empty texts
    have no terms, so such a query has no rows. Each row of ``queries`` is a query of its own.
    Empty frames give an empty result; other columns have no influence, whatever their names.
    """
    items = queries.select(F.col(f"`{item_id}`").alias("item"), F.col(f"`{item_text}`").alias("words"))
    item_type = items.schema["item"].dataType
    size = items.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()[0]
    # A word and the space behind it have two bytes at least; queries go to groups by their hash.
    groups = 1 + size // (2 * GROUP_WORDS)
    out = None
    for group in range(groups):
        some = [tuple(r) for r in items.where(F.pmod(F.xxhash64("item", "words"), F.lit(groups)) == group).collect()]
        found = _search_group(documents, some, k, doc_id, text, item_type)
        out = found if out is None else out.unionByName(found)
    return out


def search_sql(k: int = 50) -> str:
    """The same ranking over the tables ``documents`` and ``benchmark``."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = (rf"regexp_extract_all(translate(coalesce(text, ''), '{capitals}', '{capitals.lower()}'), "
             r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS words FROM documents),
totals AS (SELECT count(*) FILTER (len(words) > 0) AS n_docs, coalesce(sum(len(words)), 0)::BIGINT AS n_words FROM d),
q AS (SELECT DISTINCT i, item_id, unnest(words) AS term
      FROM (SELECT row_number() OVER () AS i, item_id, {words} AS words FROM benchmark)),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf
       FROM (SELECT r, doc_id, len(words)::BIGINT AS n, unnest(words) AS term FROM d)
       WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), totals),
scored AS (
  SELECT q.i, q.item_id, tf.r, tf.doc_id,
         sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (100 - 50 + (50 * tf.n * n_docs) // n_words))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term), totals
  GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {k}"""
