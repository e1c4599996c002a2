"""The corpus pipeline: quality, language, near-duplicates, mixture, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the last
return the columns of ``docs``, the last one the pieces of the packed sequences.  Rows that the
quality classifier or the language identification reject go; of each group of near-duplicates
the document with the smallest id stays; the mixture repeats, keeps or drops documents to meet
its sources' targets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snaplake.llm import language_id, mixing, packing, quality, simhash
from snaplake.llm.common import cut, shipped, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def language_identification(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, radius=3)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", shipped(quality_classifier)),
    ("language_identification", shipped(language_identification)),
    ("simhash_near_dedup", shipped(near_dedup)),
    ("source_mixture", shipped(source_mixture)),
    ("packing", shipped(pack_sequences)),
]

#: The classifiers, the fingerprints and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
