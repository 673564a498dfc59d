"""From raw documents to packed training sequences.

Each stage takes the documents its predecessor kept and decides over them; all but
the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import deobfuscation, order_minhash, quality_rules, secret_index, swap_packing
from panelkit.llm.registry import ship, table
from panelkit.session import materialise


# Columns that a stage does not read travel in one struct, so that no name of the input can clash
# with a column that an operator adds.
def _apart(docs: DataFrame, *names: str) -> DataFrame:
    """Columns ``names``, and ``rest`` with all others."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    return docs.select(*names, (F.struct(*others) if others else F.lit(0)).alias("rest"))


def _together(rows: DataFrame, docs: DataFrame, *names: str) -> DataFrame:
    """The columns of ``docs`` again."""
    return rows.select(*[F.col(c) if c in names else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not judged toxic."""
    ship(spark)
    judged = deobfuscation.judge(_apart(docs, "doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return _together(judged.where("predicted = 0"), docs, "doc_id", "text")


def _numbered(docs: DataFrame, *names: str) -> DataFrame:
    """The rows written once with a ``number`` of their own, since keys may repeat."""
    return materialise(_apart(docs, *names).withColumn("number", F.monotonically_increasing_id()), "documents")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and trees keep."""
    ship(spark)
    rows = _numbered(docs, "doc_id", "text")
    judged = quality_rules.judge(rows.select("number", "doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return _together(rows.join(judged.where("kept").select("number"), "number", "left_semi"), docs, "doc_id", "text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest key, a row with a null key last."""
    ship(spark)
    rows = _numbered(docs, "doc_id", "text")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "number")
    classes = order_minhash.near_duplicates(rows.select(place.alias("place"), "text"), "place")
    kept = classes.where("kept").select(F.col("place.number").alias("number"))
    return _together(rows.join(kept, "number", "left_semi"), docs, "doc_id", "text")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret and ``n_chars`` to match."""
    clean = _together(secret_index.redact(secret_index.scan(_apart(docs, "text"))), docs, "text")
    return clean.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 2048 tokens."""
    ship(spark)
    pieces = swap_packing.token_pieces(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"),
                                       capacity=2048, end=0)
    return swap_packing.pack(pieces, 2048)


STAGES = [("toxicity", toxicity), ("quality rules", quality), ("near duplicates", near_duplicates),
          ("secret scans", secrets), ("packing", packing)]

# Fitted models, alignment and a tokenizer have no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the table documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
