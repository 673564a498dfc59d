"""Secrets by regular expressions behind an inverted index of trigrams.

Each rule's expression is turned into a Boolean query over trigrams. One pass
over the texts writes the postings of the trigrams that any query names; the
postings of a document are put together again, and the rules whose query holds
there are verified on its whole text. A rule without mandatory trigrams scans
every text. All of it is built-in expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.names import free_names
from panelkit.llm.trigram_query import Clause, trigram_query

# Put around a match while its place is found; a text's own are replaced first by
# a third character, which rules treat as any other control character.
OPEN, CLOSE, STAND_IN = "\u0001", "\u0002", "\u0003"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; those whose ``group`` is shorter than ``least`` are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# Runs of a class are found whole, so their least lengths may stand in the expression.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
# A key runs to its END line, over anything but another line of five dashes. One that is cut off runs over its
# headers and base64 lines; lines joined by blanks are told from prose by their length. Repeats of
# groups are bounded, as Java's matcher takes stack for each.
_KEY = r"[A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
_LINE = r"[A-Za-z0-9+/=]{16}[A-Za-z0-9+/=\\\r\n]*"
_JOINED = r"(?:[ \t>]+[A-Za-z0-9+/=]{40}[A-Za-z0-9+/=\\\r\n]*){0,24}"
_TO_END = r"[^-]*(?:-{1,4}[^-]+){0,200}-----END " + _KEY
_CUT_OFF = r"(?:(?:[ \t\r\n]*[A-Za-z][A-Za-z-]{1,30}: [^\r\n]*){0,8}(?:[ \t\r\n>]|\\[nr]){0,8}" + _LINE + _JOINED * 8 + ")?"
RULES = (
    *BASE,
    Rule("private_key", f"-----BEGIN {_KEY}(?:{_TO_END}|{_CUT_OFF})"),
    Rule("github", r"gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9._~+/-]{20,}"),
    Rule("url_login", r"""[A-Za-z][A-Za-z0-9+.-]{1,30}://[^ \t\r\n/?#@:"'<>]*:[^ \t\r\n/@"'<>]+@"""),
)


def queries_of(rules: Sequence[Rule]) -> tuple[list[str], list[list[Clause]]]:
    """The trigrams that the rules' queries name, at most 63 a word of the index, and the queries."""
    queries = [trigram_query(r.pattern) for r in rules]
    grams = sorted({g for query in queries for clause in query for need in clause for g in need})
    return grams, queries


def postings(df: DataFrame, grams: Sequence[str], doc: Column, text: str = "text") -> DataFrame:
    """Rows ``gram`` (its number) and ``doc``: the index of ``grams`` over lower-case texts."""
    # Exploded, the lower-case text is a column of its own and not computed again for every trigram.
    low = df.select(doc.alias("doc"), F.explode(F.array(F.lower(F.col(f"`{text}`")))).alias("_low"))
    held = F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(g)), F.lit(i)) for i, g in enumerate(grams)]))
    return low.select("doc", F.explode(held).alias("gram"))


def candidates(index: DataFrame, grams: Sequence[str], queries: Sequence[Sequence[Clause]]) -> DataFrame:
    """Per document that any query holds for, the bits ``rules`` of those queries; empty queries have none."""
    number = {g: i for i, g in enumerate(grams)}
    words = -(-len(grams) // 63)
    merged = index.groupBy("doc").agg(*[
        F.bit_or(F.when(F.floor(F.col("gram") / 63) == w, F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("gram") % 63).cast("int")))
                 .otherwise(F.lit(0).cast("bigint"))).alias(f"_w{w}") for w in range(words)])

    def holds(need: frozenset[str]) -> Column:
        masks = [0] * words
        for g in need:
            masks[number[g] // 63] |= 1 << (number[g] % 63)
        return reduce(Column.__and__, [F.col(f"_w{w}").bitwiseAND(F.lit(m)) == m for w, m in enumerate(masks) if m])

    def matches(query: Sequence[Clause]) -> Column:
        return reduce(Column.__and__, [reduce(Column.__or__, [holds(n) for n in clause]) for clause in query])

    bits = [F.when(matches(q), F.lit(1 << i)).otherwise(0) for i, q in enumerate(queries) if q]
    if not bits:
        return merged.select("doc", F.lit(0).cast("bigint").alias("rules")).where(F.lit(False))
    return merged.select("doc", reduce(Column.bitwiseOR, bits).cast("bigint").alias("rules")).where("rules != 0")


def spans_of(text: Column, order: int, rule: Rule) -> Column:
    """The rule's spans as an array of ``start``, ``rule`` (``order``), ``end`` and ``kind``, in code points."""
    parts = F.split(F.regexp_replace(text, rule.pattern, f"{OPEN}$0{CLOSE}"), OPEN, -1)
    zero = F.struct(F.length(F.element_at(parts, 1)).cast("bigint").alias("at"),
                    F.array().cast("array<struct<start:bigint,rule:int,end:bigint,kind:string>>").alias("spans"))

    def step(acc: Column, part: Column) -> Column:
        found = F.substring_index(part, CLOSE, 1)
        end = acc["at"] + F.length(found)
        kept = F.length(F.regexp_extract(found, rule.pattern, rule.group)) >= rule.least if rule.least else F.lit(True)
        span = F.struct(acc["at"].alias("start"), F.lit(order).alias("rule"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        return F.struct((acc["at"] + F.length(part) - 1).alias("at"),
                        F.when(kept, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(F.slice(parts, 2, F.size(parts)), zero, step, lambda acc: acc["spans"])


def scan(df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", out: str = "spans") -> DataFrame:
    """Add ``out``: all spans of all rules in a row's whole text, by start and then in the order of the rules.

    A null or empty text has no spans. Equal rows stay separate rows with equal
    spans; other columns pass through, but none may be named ``out``.
    """
    if out in df.columns:
        raise ValueError(f"the frame already has a column {out}")
    grams, queries = queries_of(rules)
    # Documents with one key would share their candidates, which verification settles.
    doc, held, whole, *places = free_names([*df.columns, out], "_doc", "_rules", "_clean", *[f"_spans_{i}" for i in range(len(rules))])
    named = df.withColumn(doc, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    index = postings(named, grams, F.col(doc), text)
    found = candidates(index, grams, queries).withColumnsRenamed({"doc": doc, "rules": held})
    joined = named.join(found, doc, "left")
    clean = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    marked = F.contains(clean, F.lit(OPEN)) | F.contains(clean, F.lit(CLOSE))
    joined = joined.withColumn(whole, F.when(marked, F.translate(clean, OPEN + CLOSE, STAND_IN * 2)).otherwise(clean))
    none = F.array().cast("array<struct<start:bigint,rule:int,end:bigint,kind:string>>")
    for i, rule in enumerate(rules):
        place = spans_of(F.col(whole), i, rule)
        if queries[i]:
            place = F.when(F.col(held).bitwiseAND(F.lit(1 << i)) != 0, place).otherwise(none)
        else:
            place = F.when(F.regexp_like(whole, F.lit(rule.pattern)), place).otherwise(none)
        joined = joined.withColumn(places[i], place)
    every = F.array_sort(F.concat(*places))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], every.alias(out))


def shown(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(kind: str, spans: str = "spans") -> Column:
    """The number of spans of one kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))


def redact(df: DataFrame, text: str = "text", spans: str = "spans", mark: str = "[secret]") -> DataFrame:
    """Replace what the spans cover by ``mark``, overlapping spans by one, and drop column ``spans``.

    Texts without spans, null ones included, stay as they are.
    """
    whole = F.col(f"`{text}`")
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(whole, acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int"))
        grown = F.when(s["start"] >= acc["at"], F.concat(acc["out"], between, F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), grown.alias("out"))

    clean = F.aggregate(F.col(spans), zero, step, lambda acc: F.concat(
        acc["out"], F.substring(whole, acc["at"].cast("int") + 1, F.length(whole))))
    return df.withColumn(text, F.when(F.size(spans) > 0, clean).otherwise(whole)).drop(spans)


def scan_sql(rules: Sequence[Rule], table: str = "documents") -> str:
    """DuckDB SQL for the digests of ``scan``: every rule on every text, without an index."""
    kinds = []
    for i, rule in enumerate(rules):
        pattern = rule.pattern.replace("'", "''")
        good = f"length(regexp_extract(m, '{pattern}', {rule.group})) >= {rule.least}" if rule.least else "true"
        kinds.append(f"""
            list_filter(list_transform(range(2, len(p{i}) + 1), lambda k: {{'start': coalesce(list_sum(list_transform(p{i}[1:k - 1], lambda x: length(replace(x, chr(2), '')))), 0)::bigint,
                'rule': {i}, 'm': split_part(p{i}[k], chr(2), 1), 'kind': '{rule.kind}'}}), lambda e: {good.replace('(m,', '(e.m,')})""")
    parts = ", ".join(f"""string_split(regexp_replace(t, '{r.pattern.replace("'", "''")}', chr(1) || '\\0' || chr(2), 'g'), chr(1)) as p{i}"""
                      for i, r in enumerate(rules))
    shown_as = "lambda e: e.kind || ':' || e.start || ':' || (e.start + length(e.m))"
    return f"""
        with clean as (select doc_id, translate(coalesce(text, ''), chr(1) || chr(2), chr(3) || chr(3)) as t from {table}),
        split as (select doc_id, {parts} from clean),
        spans as (select doc_id, list_sort(list_concat({', '.join(kinds)})) as s from split)
        select doc_id,
            len(list_filter(s, lambda x: x.kind = 'assign'))::bigint as n_assign,
            len(list_filter(s, lambda x: x.kind = 'access'))::bigint as n_access,
            len(list_filter(s, lambda x: x.kind = 'hex'))::bigint as n_hex,
            sha256(array_to_string(list_transform(list_filter(s, lambda x: x.rule < {len(BASE)}), {shown_as}), ',')) as base_sha256,
            array_to_string(list_transform(s, {shown_as}), ',') as spans
        from spans"""
