"""Registered queries against their SQL, and the pipeline against its stages done by hand."""

from __future__ import annotations

import pytest
from oracle import compare, connect

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from stratiform.llm.decontamination import Matcher, normalised
from stratiform.llm.language_id import FOREIGN, predicted, train
from stratiform.llm.ngram_join import link_documents
from stratiform.llm.quality_rules import judged
from stratiform.llm.queries import QUERIES, SQL
from stratiform.llm.tables import table

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(SQL) <= set(oracle_sql())
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    got, _, problems = compare(QUERIES[name](spark, SF), connect(SF), SQL[name])
    assert got and not problems


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_covers_its_table(spark, name):
    source = "pages" if "html" in name else "documents"
    assert QUERIES[name](spark, SF).count() == table(spark, SF, source).count()


def test_pipeline_equals_its_stages(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    good = {x["doc_id"] for x in judged(docs, labels).filter("__kept").collect()}
    left = docs.filter(docs.doc_id.isin(good))
    known = {x["doc_id"] for x in predicted(left, train(left)).collect() if x["__lang"] != "und" and x["__score"] >= 0.5 and x["__bits_per_byte"] <= FOREIGN * x["__usual_bits"]}
    left = left.filter(left.doc_id.isin(known))
    firsts = {x["component_id"] for x in link_documents(left).collect()}
    items = [(x["item_id"], normalised(x["text"])) for x in table(spark, SF, "benchmark").collect()]
    find = Matcher(items).find
    clean = {x["doc_id"] for x in left.collect() if x["doc_id"] in firsts and not find(normalised(x["text"]))}
    found = corpus_pipeline.run(spark, SF)
    assert {x["doc_id"] for x in found.collect()} == clean
    assert 0 < len(clean) < docs.count()


def test_stages_take_empty_and_keep_columns(spark, make_docs, awkward):
    for docs in (make_docs([]), awkward):
        rows = docs
        for name, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, SF)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert rows.columns == docs.columns
        rows.count()
