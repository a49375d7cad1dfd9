"""A training-data pipeline: every stage works on all that the one before it kept, and writes Parquet between.

Language ID puts the predicted language into ``lang`` and rejects documents without one; line dedup takes repeated chunks
out of the texts and drops documents of which nothing is left; near-dedup keeps one document of each group;
decontamination drops documents with benchmark passages; encoding gives the token ids.

Defined cases: a null text has no language and goes; empty texts have no letter and go; very long texts are worked on
whole; of equal documents the smallest id stays; rows with a null id stay where their text does; an empty table gives no rows;
extra columns are kept, also where their names look like the operators' own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tomewright.llm import bpe, decontaminate, langid, linededup, neardup
from tomewright.llm.common import discard, materialize, read


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.stage(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.stage(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.stage(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: Language models, hashes and merges can't be expressed in SQL; tests/llm compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, materialize(stage(spark, docs, sf_dir), name)
        if k:
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
