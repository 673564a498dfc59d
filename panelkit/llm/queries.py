"""The operators of this subpackage on their whole tables, one query each."""

from __future__ import annotations

import uuid
import zlib
from array import array
from hashlib import sha256

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm import (
    binary_records,
    cap_filters,
    deobfuscation,
    hash_tree,
    license_voting,
    merge_alignment,
    order_minhash,
    prefix_bpe,
    quality_rules,
    ranked_search,
    secret_index,
    site_templates,
    swap_packing,
)
from panelkit.llm.registry import ORACLES, QUERIES, query, table
from panelkit.session import scratch_folder

__all__ = ["ORACLES", "QUERIES"]


def id_digests(ids: bytes, vocabulary: prefix_bpe.Vocabulary) -> tuple[int, str, str]:
    """Number of ids, and digests of their decimal list and of the text they decode to."""
    listed = array("i", ids)
    decoded = vocabulary.decode(listed)
    return len(listed), sha256(vocabulary.numbers(listed).encode()).hexdigest(), sha256(decoded.encode()).hexdigest()


@query("op10_prefix_bpe")
def prefix_bpe_digests(spark: SparkSession, sf: str) -> DataFrame:
    """Token ids of every document and the text they decode to, as digests."""
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
              T.StructField("decoded_sha256", T.StringType())]
    return prefix_bpe.encode_to(table(spark, sf, "documents").select("doc_id", "text"),
                                public_tokenizers.path("byte_bpe_50k.json"), fields, id_digests)


@query("op2_quality_trees")
def quality_trees(spark: SparkSession, sf: str) -> DataFrame:
    """Counts and verdict of every document."""
    judged = quality_rules.judge(table(spark, sf, "documents").select("doc_id", "text"),
                                 table(spark, sf, "labels").select("doc_id", "quality"))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "score")


@query("op7_hash_tree")
def hash_tree_shards(spark: SparkSession, sf: str) -> DataFrame:
    """Shards 0 to 15 of all documents, and the shard with one region more."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    sized = table(spark, sf, "documents").select(
        "doc_id", (F.octet_length(raw) + 1).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32"))
    placed = hash_tree.descend(sized, ["doc_id"], hash_tree.regular_tree(16))
    grown = hash_tree.descend(placed, ["doc_id"], hash_tree.regular_tree(17), "grown_shard")
    return hash_tree.number_within(grown, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.col("grown_shard").cast("int").alias("grown_shard"))


@query("op8_swap_packing")
def swap_packed(spark: SparkSession, sf: str) -> DataFrame:
    """All documents as pieces of sequences of at most 2048 tokens."""
    pieces = swap_packing.token_pieces(table(spark, sf, "documents").select("doc_id", "text"),
                                       public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end=0)
    return swap_packing.pack(pieces, 2048)


@query("op3_license_voting", license_voting.summary_sql())
def license_labels(spark: SparkSession, sf: str) -> DataFrame:
    """License labels and exact phrases of every document."""
    return license_voting.summary(table(spark, sf, "documents").select("doc_id", "text"))


@query("op6_secret_index", secret_index.scan_sql(secret_index.RULES))
def secret_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Secrets in every document, as digests of their places."""
    scanned = secret_index.scan(table(spark, sf, "documents").select("doc_id", "text"))
    counts = [secret_index.count_of(r.kind).cast("bigint").alias(f"n_{r.kind}") for r in secret_index.BASE]
    own = F.filter("spans", lambda s: s["rule"] < len(secret_index.BASE))
    return scanned.select("doc_id", *counts, F.sha2(secret_index.shown(own).cast("binary"), 256).alias("base_sha256"),
                          secret_index.shown(F.col("spans")).alias("spans"))


@query("op1_order_minhash")
def order_minhash_classes(spark: SparkSession, sf: str) -> DataFrame:
    """The near-duplicate class of every document, and the one that stays of each class."""
    return order_minhash.near_duplicates(table(spark, sf, "documents").select("doc_id", "text"))


@query("op4_deobfuscation")
def toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """The toxicity of every document."""
    judged = deobfuscation.judge(table(spark, sf, "documents").select("doc_id", "text"),
                                 table(spark, sf, "labels").select("doc_id", "toxic"))
    return judged.select("doc_id", "held_out", "score", "predicted")


@query("op5_site_templates")
def main_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The main text of every page."""
    return site_templates.extract(table(spark, sf, "pages").select("page_id", "url", "html")).select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query("op9_cap_filters")
def vector_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Links and components of near-duplicate vectors."""
    return cap_filters.similar_vectors(table(spark, sf, "embeddings").select("vec_id", "embedding", "label"))


def id_crc(_: int | None, ids: np.ndarray) -> tuple[int, int]:
    """Number of ids and their CRC-32 as little-endian unsigned 32-bit integers."""
    return len(ids), zlib.crc32(ids.tobytes())


@query("op13_binary_records")
def binary_records_back(spark: SparkSession, sf: str) -> DataFrame:
    """The ids of all documents, written as records in order of their key and read back."""
    folder = f"{scratch_folder(spark)}/records-{uuid.uuid4().hex}"
    index = binary_records.write_records(table(spark, sf, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), end=0)
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    back = binary_records.read_to(binary_records.with_start(index), folder, fields, id_crc, ["key", "start"])
    return back.select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


@query("op12_merge_alignment")
def alignment_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens in every document, and how common its links are."""
    return merge_alignment.link_statistics(table(spark, sf, "documents").select("doc_id", "text"),
                                           public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op11_ranked_search", ranked_search.search_sql())
def benchmark_ranking(spark: SparkSession, sf: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    return ranked_search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"), k=50)
