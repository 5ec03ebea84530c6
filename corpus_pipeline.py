"""A training corpus from raw documents: five stages, each on all that the one before it kept."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import discard, materialise, shrink
from tessera.llm.decontaminate import keep_clean
from tessera.llm.exact_dedup import keep_first
from tessera.llm.language_id import keep_identified
from tessera.llm.near_dedup import keep_one
from tessera.llm.packing import ASKING, pack_documents

#: Near copies: word shingles of five, linked at a similarity of 80 hundredths.
SHINGLE, NUMERATOR, DENOMINATOR = 5, 80, 100


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that are in none of the languages learned from the labelled ones."""
    return keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document for each text."""
    return keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document for each class of near copies."""
    return keep_one(docs, SHINGLE, NUMERATOR, DENOMINATOR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a passage of the benchmark."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of full training sequences."""
    return pack_documents(docs, every=ASKING)



def _shrunk(stage):
    """The stage, begun with executors as small as they can be: what the one before it left as garbage is no longer theirs."""

    @functools.wraps(stage)
    def begun(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        shrink(spark)
        return stage(spark, docs, sf_dir)

    return begun


STAGES = [(name, _shrunk(stage)) for name, stage in (("language_id", language), ("exact_dedup", exact), ("near_dedup", near), ("decontaminate", decontaminate), ("packing", pack))]

#: Neither learned rejection nor tokenization can be stated in SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. A stage's table is removed when the next one is written; the last remains, as the result reads it.

    Null texts, as all without letters, end at the first stage; repeated rows become one at the second; without documents
    there are no rows; columns beside doc_id, text and lang are carried along, whatever their names, up to the last stage.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
