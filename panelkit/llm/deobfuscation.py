"""Toxicity of documents, scored on text restored from leetspeak, spacing and repetition.

A character language model of letter trigrams is counted over all documents. A
word that looks disguised becomes a lattice: a digit or sign stands for one of
its letters or for nothing, a letter repeated three times or more for fewer of
it, letters set apart by spaces or signs for one word or several. Viterbi decoding
takes the likeliest restored words under the language model and the costs of the
channel; a number or a mark at the end of a sentence competes as what it is.

Restored words and their openings get weights from a bounded sample of labelled
documents: how much more often they occur in toxic ones. A logistic model then
judges a document by the number, share and weight of such words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.names import free_names
from panelkit.llm.workers import tidy
from panelkit.session import materialise

# Labelled documents that weights and the final model are fitted on, about; terms that get a weight, at most.
SAMPLE, TERMS = 20_000, 20_000
# Openings of words that are terms of their own, in letters.
OPENINGS = (4, 5, 6, 7)
# A term needs this much more use in toxic documents, seen in so many of them.
LEAST_RATIO, LEAST_DOCS = 4.0, 5
# Folds: remainder of the key's CRC-32; documents of fold 0 are never learnt from.
FOLDS = 5
MEMO = 1 << 18
# Terms that a task counts before it hands them on.
COUNTED = 1 << 17
# Characters whose trigrams are counted together.
STRETCH = 1 << 20

# Letters of the model and what signs can stand for.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœ"
SIGNS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "@": "a",
         "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¥": "y", "×": "x"}
PUNCTUATION = ".,;:!?\"'`()[]{}<>…«»“”‘’-–—*#%&|~_=/\\^+$@"
SOFT = ".,;:?\"'`()[]{}<>…«»“”‘’-–—*#%&~_=/\\^"

SIZE = len(LETTERS) + 2  # 0 is the edge of a word, the last any other letter
OTHER = SIZE - 1
CODE = {c: i for i, c in enumerate(LETTERS, 1)}
# The last entry stands for everything beyond.
TABLE = np.zeros(0x251, np.int64)
TABLE[[ord(c) for c in CODE if ord(c) < 0x250]] = [i for c, i in CODE.items() if ord(c) < 0x250]
for _c in range(0xC0, 0x250):
    if TABLE[_c] == 0 and chr(_c).isalpha():
        TABLE[_c] = OTHER

# Costs of the channel, and what every restored letter earns, so that short words are not favoured.
SIGN_COST, DROP_SIGN, DROP_DIGIT, DROP_REPEAT, EARNED = 0.5, 1.5, 10.0, 0.5, 2.5
# Leaving out "!" before a word, where plain writing has none; a digit of a possible number.
DROP_FIRST, PLAIN_DIGIT = 4.0, 1.5
# How much less likely than the best a cut into words may be that still gives words, of so many letters at most.
NEAR, LONGEST = 3.0, 32
SPACED = re.compile(r"(?<![^\W_])[\w@$!|+]([ .\-_*])[\w@$!|+](?:\1[\w@$!|+])+(?![^\W_])")
REPEATED = re.compile(r"(.)\1\1")
# Marks that end a sentence, and numbers with separators: as what they are they cost nothing.
ENDING = re.compile(r"[!|+]+\Z")
NUMERAL = re.compile(r"[+$€£¥]?\d+(?:[ .,:/_*×+-]\d+)+[%€£¥$+!]*")
READABLE = frozenset(SIGNS)

# What SPACED looks at in a character: bit 1 a letter of a run, bit 2 a letter or digit, the rest which separator.
# The last entry stands for everything beyond, which may be any of the first two.
APART = " .-_*"
KINDS = np.array([(c.isalnum() or c in "_@$!|+") | c.isalnum() << 1 | (APART.find(c) + 1) << 2 for c in map(chr, range(0x250))] + [1], np.uint8)


def run_starts(texts: list[str]) -> Iterator[list[int]]:
    """For every text the places where ``SPACED`` can match, found in all texts at once."""
    joined = "\n".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum([len(t) + 1 for t in texts])
    places = np.zeros(0, np.int64)
    if len(points) > 4:
        kinds = KINDS[np.minimum(points, len(KINDS) - 1)]
        apart = kinds >> 2
        found = (apart[1:-3] == apart[3:-1]) & (apart[1:-3] > 0)
        found &= (kinds[:-4] & kinds[2:-2] & kinds[4:] & 1).astype(bool)
        found[1:] &= kinds[:-5] & 2 == 0
        places = np.flatnonzero(found)
    cuts = np.searchsorted(places, ends).tolist()
    first = 0
    for start, cut in zip((ends - [len(t) + 1 for t in texts]).tolist(), cuts):
        yield (places[first:cut] - start).tolist()
        first = cut


def runs(text: str, starts: list[int]) -> Iterator[re.Match]:
    """The matches of ``SPACED`` in a text, from the places where it can match."""
    end = 0
    for at in starts:
        if at >= end and (m := SPACED.match(text, at)):
            end = m.end()
            yield m


def trigram_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows ``gram`` and ``n``: counts of letter trigrams over all texts, edges of words included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE ** 3, np.int64)
        some, size = [], 0

        def count() -> None:
            points = np.frombuffer("  ".join(["", *some, ""]).lower().encode("utf-32-le", "surrogatepass"), "<u4")
            codes = TABLE[np.minimum(points, len(TABLE) - 1)]
            grams = (codes[:-2] * SIZE + codes[1:-1]) * SIZE + codes[2:]
            total[:] += np.bincount(grams, minlength=len(total))
            some.clear()

        for batch in batches:
            for x in batch.column(0).to_pylist():
                if not x:
                    continue
                some.append(x)
                size += len(x)
                if size >= STRETCH:
                    count()
                    size = 0
        if some:
            count()
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(total[there])], ["gram", "n"])
        tidy()

    per_task = df.select(F.col(f"`{text}`")).mapInArrow(run, "gram int, n long")
    return per_task.groupBy("gram").agg(F.sum("n").alias("n"))


def language_model(counts: DataFrame, weight: float = 5.0) -> np.ndarray:
    """Log probabilities of a letter after two others; at most ``SIZE ** 3`` counts reach the driver."""
    n = np.zeros(SIZE ** 3)
    for row in counts.collect():
        n[row.gram] = row.n
    n = n.reshape(SIZE, SIZE, SIZE)
    one = n.sum(axis=(0, 1)) + 1
    two = n.sum(axis=0)
    p1 = one / one.sum()
    p2 = (two + weight * p1) / (two.sum(axis=1, keepdims=True) + weight)
    return np.log((n + weight * p2[None]) / (n.sum(axis=2, keepdims=True) + weight)).astype(np.float32)


class Restorer:
    """Restores single words by Viterbi decoding.

    A state is the pair of the last two letters. A path keeps its letters as a chain of
    (letter, chain before), which paths share, so a step costs the same wherever it is in
    a word, and no state is given up before the end.
    """

    def __init__(self, model: np.ndarray) -> None:
        # Lists, one of them flat: single look-ups in an array cost more than the step itself.
        self.model, self.flat = model.tolist(), model.ravel().tolist()
        self.coded: dict[str, list[tuple[str, int, float]]] = {}

    def arcs(self, char: str) -> list[tuple[str, float]]:
        """What a character can stand for, with costs."""
        if char.isalpha():
            return [(char, 0.0)]
        found = [(x, SIGN_COST) for x in SIGNS.get(char, "")]
        return [*found, ("", DROP_DIGIT if char.isdigit() else DROP_SIGN if found else 0.0)]

    def coded_arcs(self, char: str) -> list[tuple[str, int, float]]:
        """The same with codes; those of the model's characters are kept."""
        known = self.coded.get(char)
        if known is None:
            known = [(x, CODE.get(x, OTHER), cost) for x, cost in self.arcs(char)]
            if char in CODE or char in SIGNS:
                self.coded[char] = known
        return known

    def decode(self, word: str, several: bool = False) -> str:
        """The likeliest restored form of a word in lower case; with ``several``, of words written without a break."""
        return self.best(word, several)[1]

    def best(self, word: str, several: bool = False, first: float | None = None) -> tuple[float, str]:
        """The likeliest form and its score; ``first`` is the cost of leaving out a sign at the start."""
        model = self.flat
        paths: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
        for i, char in enumerate(word):
            arcs = self.coded_arcs(char)
            if first is not None and i == 0:
                arcs = [(x, c, cost if x else first) for x, c, cost in arcs]
            run = char == word[i - 1] if i else False
            letters = {x for x, _, _ in arcs} if run and (word[i + 1:i + 2] == char or word[i - 2:i - 1] == char) else ()
            new: dict[int, tuple[float, tuple | None]] = {}
            for state, (score, out) in paths.items():
                options = [*arcs, ("", 0, DROP_REPEAT)] if letters and out and out[0] in letters else arcs
                for letter, code, cost in options:
                    if letter:
                        key, value = state % SIZE * SIZE + code, score - cost + EARNED + model[state * SIZE + code]
                        if key not in new or value > new[key][0]:
                            new[key] = value, (letter, out)
                    else:
                        value = score - cost
                        if state not in new or value > new[state][0]:
                            new[state] = value, out
            if several and i + 1 < len(word):
                # The edge of a word, then a new one.
                for state, (score, out) in list(new.items()):
                    if state % SIZE:
                        key, value = state % SIZE * SIZE, score + model[state * SIZE]
                        if key not in new or value > new[key][0]:
                            new[key] = value, (" ", out)
            paths = new
        # After a break the edge is there already.
        score, chain = max(((score + (model[state * SIZE] if state % SIZE or out is None else 0.0), out)
                            for state, (score, out) in paths.items()), key=lambda p: p[0])
        found = []
        while chain is not None:
            letter, chain = chain
            found.append(letter)
        return score, "".join(reversed(found))

    def restore(self, word: str) -> str:
        """A word without white space as it was meant; empty if it is a number or no word."""
        return self.readings(word)[0]

    def readings(self, word: str) -> list[str]:
        """The word as it was meant, and its reading with marks at the end as letters where that scores higher."""
        low = word.lower()
        whole = low.strip(SOFT)
        if whole.isalpha() and not REPEATED.search(whole):
            return [whole]
        core = low.strip(PUNCTUATION)
        bare = ENDING.sub("", whole)
        if not any(c.isalpha() for c in whole):
            return [self.unlettered(whole)]
        first = self.first(whole)
        if core.isalpha() and len(core) == len(bare) and not REPEATED.search(core):
            if bare == whole:
                return [core]
            score, plain = self.best(core)[0], core
        else:
            score, plain = self.best(bare, first=first)
        if bare != whole:
            read = self.best(whole, first=first)
            if read[0] > score and read[1] != plain:
                return [plain, read[1]]
        return [plain]

    @staticmethod
    def first(word: str) -> float | None:
        """What leaving out the first sign costs, if not the same as elsewhere."""
        return DROP_FIRST if word[0] == "!" else None

    def unlettered(self, word: str) -> str:
        """What signs and digits spell, unless they are likelier a number or marks."""
        if not any(c in READABLE for c in word):
            return ""
        free = ENDING.sub("", word)
        plain = 0.0 if NUMERAL.fullmatch(word) else -sum(PLAIN_DIGIT if c.isdigit() else DROP_SIGN for c in free if c in READABLE)
        score, out = max(self.best(free), self.best(word)) if free else self.best(word)
        return out if score > plain + self.flat[0] else ""

    def near_words(self, letters: str) -> list[str]:
        """Words of every cut of ``letters`` that is about as likely as the best one."""
        model, n = self.flat, len(letters)
        codes = [CODE.get(x, OTHER) for x in letters]

        def words_from(i: int) -> Iterator[tuple[int, float]]:
            """Ends and scores of the words that start at ``i``."""
            score, a, b = 0.0, codes[i - 1] if i else 0, 0
            for j in range(i, min(n, i + LONGEST)):
                score, a, b = score + model[(a * SIZE + b) * SIZE + codes[j]], b, codes[j]
                yield j + 1, score + model[(a * SIZE + b) * SIZE]

        # Words are scored again for each use, as a list of all would be long for a long run.
        before, after = [0.0] + [-np.inf] * n, [-np.inf] * n + [0.0]
        for i in range(n):
            for j, score in words_from(i):
                before[j] = max(before[j], before[i] + score)
        for i in range(n - 1, -1, -1):
            after[i] = max(score + after[j] for j, score in words_from(i))
        return [letters[i:j] for i in range(n) for j, score in words_from(i) if before[i] + score + after[j] >= before[n] - NEAR]

    def spaced(self, text: str, starts: list[int] | None = None) -> list[str]:
        """Words whose letters are set apart by one kind of sign; ``starts`` are the places of ``run_starts``.

        A run counts as one word, as one after a word of one letter, and as several
        words in all likely cuts; what more than one reading has counts once.
        """
        out: list[str] = []
        for m in runs(text, next(run_starts([text])) if starts is None else starts):
            x = m.group().lower().replace(m.group(1), "")
            if any(c.isalpha() for c in x):
                readings = [self.best(w, several, self.first(w))[1].split() for w in (x, x[1:]) for several in (False, True)]
                readings.append(self.near_words("".join(readings[1])))
            elif NUMERAL.fullmatch(m.group()):
                continue
            else:
                readings = [[self.unlettered(x)]]
            found: Counter[str] = Counter()
            for words in readings:
                found |= Counter(w for w in words if w)
            out += found.elements()
        return out


def terms_of(word: str) -> list[str]:
    """A restored word and its openings."""
    return [f"={word}", *(word[:n] for n in OPENINGS if len(word) > n)]


@dataclass(frozen=True)
class Judge:
    """Weights of terms and of the final model over ``evidence``."""

    weights: dict[str, float]
    mean: np.ndarray
    scale: np.ndarray
    slope: np.ndarray
    base: float

    def score(self, evidence: np.ndarray) -> np.ndarray:
        z = self.base + ((evidence - self.mean) / self.scale) @ self.slope
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Reader:
    """Evidence in a text: what its words weigh. Weights of words come from a bounded memo that only saves time."""

    def __init__(self, model: np.ndarray, weights: dict[str, float]) -> None:
        self.restorer, self.weights = Restorer(model), weights
        self.memo: dict[str, float] = {}

    def weigh(self, word: str) -> float:
        # The same as over ``terms_of``, without a list of them.
        weight, size = self.weights.get, len(word)
        best = weight(f"={word}", 0.0) if word else 0.0
        for n in OPENINGS:
            if size <= n:
                break
            found = weight(word[:n], 0.0)
            if found > best:
                best = found
        return best

    def evidence(self, text: str | None, starts: list[int] | None = None) -> list[float]:
        words = text.split() if text else []
        found = list(map(self.memo.get, words))
        if None in found:
            for i, w in enumerate(found):
                if w is None:
                    found[i] = weight = max(map(self.weigh, self.restorer.readings(words[i])))
                    if len(self.memo) >= MEMO:
                        self.memo.clear()
                    if len(words[i]) < 64:
                        self.memo[words[i]] = weight
        apart = self.restorer.spaced(text, starts) if text else []
        hits = [w for w in found if w] + [w for w in map(self.weigh, apart) if w]
        n, total = len(words), sum(hits)
        return [np.log1p(len(hits)), np.log1p(n), np.log((len(hits) + 0.3) / (n + 30)), total / (n + 30), max(hits, default=0.0)]


def with_starts(texts: Iterable[str | None]) -> Iterator[tuple[str, list[int]]]:
    """Every text, null as empty, with the places of its runs; a bounded stretch of texts is looked at together."""
    some, size = [], 0
    for text in texts:
        some.append(text or "")
        size += len(some[-1])
        if size >= STRETCH:
            yield from zip(some, run_starts(some))
            some, size = [], 0
    if some:
        yield from zip(some, run_starts(some))


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % FOLDS == 0


def labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, bound: int) -> DataFrame:
    """``_key``, ``_text`` and ``_label`` of about ``bound`` documents outside fold 0, never more than a little over it.

    A key has its highest label. Rows of equal key and text count once. Documents are chosen by
    the hash of key and text after they have met their labels, so a key with very many documents
    is sampled like any others.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(F.col(key))).groupBy(
        F.col(key).alias("_key")).agg(F.max(F.col(label).cast("int")).alias("_label"))
    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).withColumn("_hash", F.xxhash64("_key", "_text"))
    many = rows.select("_key", "_hash").join(known, "_key").select("_key", "_hash").distinct().count()
    if many > bound:
        # A share of 95 % of the bound: chance adds a few hundredths of it at most.
        rows = rows.where(F.pmod("_hash", F.lit(1_000_000)) < int(0.95 * bound / many * 1_000_000))
    return rows.join(known, "_key").dropDuplicates(["_key", "_hash"]).drop("_hash")


def term_weights(sample: DataFrame, model: Broadcast) -> dict[str, float]:
    """Log ratios of use in toxic and other documents, for terms used clearly more in toxic ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model.value)
        # Uses of a term, and documents that use it, by term and label.
        seen: dict[tuple[str, int], list[int]] = {}
        # What words read as, in a bounded memo that only saves time.
        known: dict[str, tuple[int, list[str]]] = {}

        def read(words: list[str]) -> tuple[int, list[str]]:
            return len(words), [t for w in words if w for t in terms_of(w)]

        def counted() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays(
                [pa.array([t for t, _ in seen], pa.string()), pa.array([y for _, y in seen], pa.int32()),
                 pa.array([n for n, _ in seen.values()], pa.int64()), pa.array([k for _, k in seen.values()], pa.int64())],
                ["term", "label", "n", "docs"])
            seen.clear()
            return found

        for batch in batches:
            for (text, starts), label in zip(with_starts(batch.column("_text").to_pylist()), batch.column("_label").to_pylist()):
                words = text.split()
                for word in words:
                    if word not in known:
                        known[word] = read(restorer.readings(word))
                found = [*map(known.__getitem__, words), read(restorer.spaced(text, starts))]
                own = Counter(chain.from_iterable(terms for _, terms in found))
                own[""] = sum(n for n, _ in found)
                if len(known) > MEMO // 4:
                    known.clear()
                for term, n in own.items():
                    both = seen.setdefault((term, label), [0, 0])
                    both[0] += n
                    both[1] += 1
                if len(seen) >= COUNTED:
                    yield counted()
        yield counted()
        tidy()

    rows = sample.mapInArrow(run, "term string, label int, n long, docs long")
    sides = rows.groupBy("term").agg(*[F.sum(F.when(F.col("label") == y, F.col(c)).otherwise(0)).alias(f"{c}{y}")
                                       for y in (0, 1) for c in ("n", "docs")])
    sides = materialise(sides, "terms")
    whole = sides.where("term = ''").collect()
    if not whole or not whole[0].n1:
        return {}
    ratio = ((F.col("n1") + 0.1) / whole[0].n1) / ((F.col("n0") + 0.5) / max(whole[0].n0, 1))
    known = sides.where((F.col("term") != "") & (F.col("docs1") >= LEAST_DOCS)).withColumn("ratio", ratio).where(
        F.col("ratio") >= LEAST_RATIO).orderBy(F.desc("docs1"), "term").limit(TERMS)
    return {r.term: float(np.log(r.ratio)) for r in known.select("term", "ratio").collect()}


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> tuple[np.ndarray, float]:
    """Slopes and base of a logistic model, by Newton steps."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    damp = np.r_[np.full(x.shape[1] - 1, ridge * len(x)), 1e-6]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(damp + 1e-9)
        w = w + np.linalg.solve(hess, x.T @ (y - p) - damp * w)
    return w[:-1], float(w[-1])


def evidence_column(model: Broadcast, weights: Broadcast, text: Column) -> Column:
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(model.value, weights.value)
        for some in texts:
            yield pd.Series([reader.evidence(text, starts) for text, starts in with_starts(some)], dtype=object)
        del reader
        tidy()

    return of(text)


def fit_judge(sample: DataFrame, model: Broadcast, bound: int = SAMPLE) -> Judge:
    """Weights and final model from labelled documents, of which at most ``bound`` rows of numbers reach the driver;
    without both labels the score is their share."""
    sample = materialise(sample, "labelled")
    weights = term_weights(sample, model)
    shared = sample.sparkSession.sparkContext.broadcast(weights)
    rows = sample.select("_key", "_label", evidence_column(model, shared, F.col("_text")).alias("x")).orderBy("_key", "x").limit(bound).collect()
    x, y = np.array([r.x for r in rows], float).reshape(len(rows), 5), np.array([r._label for r in rows], float)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 2)
        return Judge({}, np.zeros(5), np.ones(5), np.zeros(5), float(np.log(share / (1 - share))))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    slope, base = _logistic((x - mean) / scale, y)
    return Judge(weights, mean, scale, slope, base)


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          bound: int = SAMPLE) -> DataFrame:
    """Add ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) to every document.

    The language model is counted over all texts. Null and empty texts are scored
    as texts without words. Rows with a null key are not learnt from and not held
    out. Equal rows stay separate rows, an empty frame stays empty. Other columns
    pass through; names of the new ones are refused.
    """
    if clash := {"held_out", "score", "predicted"} & set(docs.columns):
        raise ValueError(f"the frame already has columns {sorted(clash)}")
    context = docs.sparkSession.sparkContext
    model = context.broadcast(language_model(trigram_counts(docs, text)))
    fitted = fit_judge(labelled(docs, labels, key, text, label, bound), model, bound)
    weights, shared = context.broadcast(fitted.weights), context.broadcast(fitted)

    @F.pandas_udf(T.DoubleType())
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(np.array(x.to_list(), float).reshape(len(x), 5)))

    found, = free_names(docs.columns, "_x")
    read = docs.withColumn(found, evidence_column(model, weights, F.col(f"`{text}`")))
    scored = read.withColumn("score", score(F.col(found))).drop(found)
    return scored.withColumns({
        "held_out": F.coalesce(held_out(F.col(f"`{key}`")), F.lit(False)),
        "predicted": (F.col("score") >= 0.5).cast("int")})
