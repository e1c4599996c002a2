"""Labelled rows to learn a classifier from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import cut, fold, mod_sample


def learning_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int,
                  bound: int, seed: int) -> DataFrame:
    """(doc_id, text, y) of about ``bound`` labelled documents that aren't held out, chosen by
    a hash of their id; null labels don't count, of several labels of an id the largest does."""
    y = labels.select(F.col("doc_id").alias("label_id"), F.col(label).cast("int").alias("y")) \
        .dropna().groupBy("label_id").agg(F.max("y").alias("y")) \
        .filter(fold(F.col("label_id"), folds) != held_out)
    y = mod_sample(y, F.col("label_id"), bound, seed)
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return cut(d.join(y, d["doc_id"] == y["label_id"]).select("doc_id", "text", "y"), "labelled")
