"""The corpus pipeline: documents through the stages below, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratiform.llm.bpe_tree import encode
from stratiform.llm.decontamination import drop_contaminated
from stratiform.llm.language_id import keep_known
from stratiform.llm.ngram_join import drop_linked
from stratiform.llm.quality_rules import keep_good
from stratiform.llm.tables import stored, table

STAGES = [
    ("quality_rules", keep_good),
    ("language_id", keep_known),
    ("ngram_join", drop_linked),
    ("decontamination", drop_contaminated),
    ("bpe_encoding", encode),
]

#: The learned stages have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
