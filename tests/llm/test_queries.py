"""The registered queries: SQL where there is some, else rows and keys of the whole table."""

from __future__ import annotations

import pytest

import corpus_pipeline
from panelkit.llm.queries import ORACLES, QUERIES
from panelkit.llm.registry import table
from tools.check import compare, connect

TABLES = {"op5_site_templates": ("pages", "page_id"), "op9_cap_filters": ("embeddings", "vec_id")}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf, name):
    assert compare(spark, connect(sf), name, QUERIES[name], ORACLES[name], sf) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op8_swap_packing"}))
def test_query_has_every_row(spark, sf, name):
    source, key = TABLES.get(name, ("documents", "doc_id"))
    got = sorted(r[0] for r in QUERIES[name](spark, sf).select(key).collect())
    assert got == sorted(r[0] for r in table(spark, sf, source).select(key).collect())


def test_pipeline_filters_and_keeps_columns(spark, sf):
    docs = table(spark, sf, "documents")
    total = docs.count()
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            assert out.count() <= total
            docs, total = spark.createDataFrame(out.collect(), out.schema), out.count()
        else:
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}


def test_pipeline_on_nulls(spark, sf):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0)],
                                 table(spark, sf, "documents").schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == 3
