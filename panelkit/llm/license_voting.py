"""License texts found by votes on diagonals.

All rolling word pairs of all documents are hashed and joined to the places
where license templates have them. A pair at word ``p`` that a template has at
``t`` votes for the diagonal ``p - t``. Votes are counted per document, template
and diagonal; neighbouring diagonals, which a few inserted or missing words leave
behind, are merged; a merged stretch is a find when it covers enough of the
template within a span that is not much longer. Exact phrases take the same way with no
neighbours and full cover. The templates are a few hundred fixed pairs; all of it
is built-in expressions.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Share of a template's word pairs that a find needs, words between diagonals that are
# merged, and how much longer than the template a find may be.
COVER, SLACK, STRETCH = 0.8, 3, 1.25
# Templates are kept as bits of one long integer.
LONGEST = 64


@dataclass(frozen=True)
class Template:
    """``exact`` ones count every place where their words stand one after the other."""

    label: str
    text: str
    exact: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()


# Phrases, and openings of license texts in lower case without punctuation.
BASE = (
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
)
TEMPLATES = (
    *BASE,
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                    "associated documentation files"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
                    "provided that the following conditions are met"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
                    "hereby granted"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    Template("gpl-notice", "you can redistribute it and or modify it under the terms of the gnu general public license as "
                           "published by the free software foundation"),
    Template("mit-name", "released under the mit license"),
    Template("spdx", "spdx license identifier"),
)


def words_of(text: Column) -> Column:
    """The words of a text with A-Z in lower case; none for null."""
    whole = F.coalesce(text, F.lit(""))
    # These two have ASCII letters for their lower case elsewhere, but are not A-Z.
    odd = F.contains(whole, F.lit("K")) | F.contains(whole, F.lit("İ"))
    low = F.when(odd, F.translate(whole, string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.lower(whole))
    return F.array_remove(F.split(low, SEPARATORS, -1), "")


def template_pairs(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """One row per word pair of every template."""
    rows = []
    for i, t in enumerate(templates):
        if not 2 <= len(t.words) <= LONGEST:
            raise ValueError(f"a template needs 2 to {LONGEST} words")
        rows += [(i, t.label, t.exact, len(t.words), 0 if t.exact else SLACK, at, f"{a} {b}")
                 for at, (a, b) in enumerate(zip(t.words, t.words[1:]))]
    pairs = spark.createDataFrame(rows, "template int, label string, exact boolean, n int, slack int, at int, gram string")
    return pairs.withColumn("hash", F.xxhash64("gram"))


def find(df: DataFrame, templates: Sequence[Template] = TEMPLATES, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The documents with ``_row`` and ``n_words`` instead of their text, and all finds.

    Finds have ``_row``, ``label``, ``exact``, ``first`` and ``last`` (words from 0) and ``cover``. Both
    come from one pass; see ``summary`` for the usual result.
    """
    hits = votes(df, templates, text)
    rest = [c for c in df.columns if c != text]
    docs = hits.where("template is null").select("_row", *[F.col(f"_doc.`{c}`").alias(c) for c in [*rest, "n_words"]])
    return docs, merged(hits).where("found").select("_row", "label", "exact", "first", "last", "cover")


def votes(df: DataFrame, templates: Sequence[Template], text: str = "text") -> DataFrame:
    """One row per word pair that a template has, and one per document, without a template but with ``_doc``:
    its other columns and ``n_words``."""
    rest = [c for c in df.columns if c != text]
    if "n_words" in rest:
        raise ValueError("the frame already has a column n_words")
    words = df.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_rest") if rest else F.lit(None).alias("_rest"),
                      F.monotonically_increasing_id().alias("_row"), words_of(F.col(f"`{text}`")).alias("_words"))
    pairs = F.zip_with("_words", F.slice("_words", 2, F.greatest(F.size("_words"), F.lit(1))),
                       lambda a, b: F.concat(a, F.lit(" "), b))
    # The first element stands for the document itself, so that one without finds keeps a row.
    doc = F.struct(*[F.col(f"_rest.`{c}`").alias(c) for c in rest], F.size("_words").cast("bigint").alias("n_words"))
    rolled = words.select("_row", doc.alias("_doc"), F.posexplode(F.concat(F.array(F.lit(None).cast("string")), pairs)).alias("_place", "gram"))
    rolled = rolled.withColumn("_doc", F.when(F.col("_place") == 0, F.col("_doc")))
    known = F.broadcast(template_pairs(df.sparkSession, templates)).withColumnsRenamed({"gram": "_gram", "hash": "_hash"})
    same = (F.xxhash64("gram") == F.col("_hash")) & (F.col("gram") == F.col("_gram"))
    joined = rolled.join(known, same, "left").where("_place = 0 or template is not null")
    # All later steps go by document, so this is the only shuffle.
    return joined.drop("gram", "_gram", "_hash").withColumn("_place", F.col("_place") - 1).repartition("_row")


def merged(hits: DataFrame) -> DataFrame:
    """Stretches of neighbouring diagonals with the template's cover in them; rows without a template stay as they are."""
    keys = ["_row", "template", "label", "exact", "n", "slack"]
    diagonals = hits.groupBy(*keys, (F.col("_place") - F.col("at")).alias("diagonal")).agg(
        F.first("_doc", ignorenulls=True).alias("_doc"),
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("at"))).alias("bits"),
        F.min("_place").alias("first"), F.max("_place").alias("last"))
    order = Window.partitionBy("_row", "template").orderBy("diagonal")
    starts = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > F.col("slack"), F.lit(True))
    running = diagonals.withColumn("_starts", starts.cast("int")).withColumn(
        "_stretch", F.sum("_starts").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = running.groupBy(*keys, "_stretch").agg(
        F.first("_doc", ignorenulls=True).alias("_doc"), F.bit_or("bits").alias("bits"),
        F.min("first").cast("bigint").alias("first"), (F.max("last") + 1).cast("bigint").alias("last"))
    cover = F.bit_count("bits") / (F.col("n") - 1)
    short = F.col("last") - F.col("first") + 1 <= STRETCH * F.col("n")
    return whole.withColumn("cover", cover).withColumn(
        "found", F.when(F.col("exact"), F.col("cover") == 1).otherwise((F.col("cover") >= COVER) & short))


def summary(df: DataFrame, templates: Sequence[Template] = TEMPLATES, text: str = "text") -> DataFrame:
    """One row per document in place of its text: words, exact places, labels and the best cover.

    ``score`` is the largest share of a template's pairs in one stretch, 0 without
    any. A null or empty text has no words and no labels. Equal rows stay separate,
    an empty frame stays empty. Other columns pass through whatever their names; only
    ``n_words`` is refused.
    """
    rest = [c for c in df.columns if c != text]
    found = merged(votes(df, templates, text))
    exact = F.col("found") & F.col("exact")
    per_doc = found.groupBy("_row").agg(
        F.first("_doc", ignorenulls=True).alias("_doc"), F.coalesce(F.sum(exact.cast("bigint")), F.lit(0)).cast("bigint").alias("n_base"),
        F.min(F.when(exact, F.col("first"))).alias("first_word"), F.max(F.when(exact, F.col("first"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(exact, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("found"), F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max("cover"), F.lit(0.0)).alias("score"))
    return per_doc.select(*[F.col(f"_doc.`{c}`").alias(c) for c in [*rest, "n_words"]], "n_base", "first_word", "last_word",
                          "base_labels", "labels", "score")


def summary_sql(templates: Sequence[Template] = TEMPLATES, table: str = "documents") -> str:
    """DuckDB SQL for ``summary`` over ``doc_id`` and ``text``."""
    pairs = ", ".join(
        f"({i}, '{t.label}', {str(t.exact).lower()}, {len(t.words)}, {0 if t.exact else SLACK}, {at}, '{a} {b}')"
        for i, t in enumerate(templates) for at, (a, b) in enumerate(zip(t.words, t.words[1:])))
    return f"""
        with pairs(template, label, exact, n, slack, tat, gram) as (values {pairs}),
        docs as (select row_number() over () as r, doc_id, list_filter(string_split_regex(
            translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{SEPARATORS}'), lambda w: w <> '') as w from {table}),
        rolled as (select r, unnest(range(1, len(w))) as p, w from docs),
        hits as (select r, p - 1 as place, pairs.* from rolled join pairs on w[p] || ' ' || w[p + 1] = gram),
        diagonals as (select r, template, label, exact, n, slack, place - tat as d, bit_or(1::bigint << tat) as bits,
            min(place) as f, max(place) as l from hits group by r, template, label, exact, n, slack, place - tat),
        starts as (select *, coalesce(d - lag(d) over (partition by r, template order by d) > slack, true)::int as s from diagonals),
        stretches as (select *, sum(s) over (partition by r, template order by d rows unbounded preceding) as stretch from starts),
        whole as (select r, template, label, exact, n, stretch, bit_count(bit_or(bits)) / (n - 1) as cover, min(f)::bigint as f,
            max(l) + 1 as l from stretches group by r, template, label, exact, n, stretch),
        found as (select *, case when exact then cover = 1 else cover >= {COVER} and l - f + 1 <= {STRETCH} * n end as found from whole),
        per_doc as (select r, sum((found and exact)::bigint)::bigint as n_base, min(f) filter (found and exact) as first_word,
            max(f) filter (found and exact) as last_word,
            array_to_string(list_sort(list(distinct label) filter (found and exact)), ',') as base_labels,
            array_to_string(list_sort(list(distinct label) filter (found)), ',') as labels, max(cover) as score
            from found group by r)
        select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word, last_word,
            coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0)::double as score
        from docs left join per_doc using (r)"""
