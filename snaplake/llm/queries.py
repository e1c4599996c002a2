"""The registered queries of this folder: each runs one operator, with production parameters,
over its whole table and derives the columns that its contract names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.llm import (chat_format, language_id, lexical_search, lsh_forest, merkle, mixing,
                          order_minhash, packing, quality, simhash, topk_search, toxicity, url_filter)
from snaplake.llm.common import cut, shipped, table

#: The URL rules of op4: (host, path, action).
URL_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"),
             ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
             ("com", "/de/", "block"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints(table(spark, sf_dir, "documents"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, action string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    says = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)],
                                 "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    nodes = cut(chat_format.linear_nodes(rows.unionByName(more)), "chat-linear")
    out = chat_format.read_back(cut(chat_format.conversations(nodes), "chat-formatted"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op7_exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk_search.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predictions(table(spark, sf_dir, "documents"))


def op9_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"))


def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return merkle.verified(docs, chosen, n_chars=F.col("n_chars") + 1)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    queries = {
        "op1_toxicity": op1_toxicity,
        "op2_simhash_near_dedup": op2_simhash_near_dedup,
        "op3_document_fingerprints": op3_document_fingerprints,
        "op4_url_filters": op4_url_filters,
        "op5_packing": op5_packing,
        "op6_chat_formatting": op6_chat_formatting,
        "op7_exact_topk_search": op7_exact_topk_search,
        "op8_language_id": op8_language_id,
        "op9_mixing_sources": op9_mixing_sources,
        "op10_quality_classifier": op10_quality_classifier,
        "op11_minhash_near_dedup": op11_minhash_near_dedup,
        "op12_ranked_lexical_search": op12_ranked_lexical_search,
        "op13_merkle_manifest": op13_merkle_manifest,
        "pipeline": pipeline,
    }
    return {name: shipped(query) for name, query in queries.items()}


def oracle_queries() -> dict[str, str]:
    from snaplake.llm import oracle
    return oracle.SQL
