"""One query per operator of this subpackage, over its whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterproof.llm import (
    chat_format, conversation_trie, decontamination, language_id, line_dedup, ngram_join, pieces, quality_classifier, quality_rules, sharding, spelling_variants, token_counts, toxicity,
)

ROOT = str(Path(__file__).resolve().parents[2])
# Fixed value: the conversation that the contract adds, its text in both turns.
ADDED = r"\### Assistant: </turn> ok"


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package where it is not installed."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, known]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = [(-7, 0, "user", ADDED), (-7, 1, "assistant", ADDED)]
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(added, "conv_id long, turn long, role string, text string"))
    return chat_format.read_back(chat_format.format_conversations(rows))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.train(docs))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(table(spark, sf_dir, "documents")).drop("hash")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_digest(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("hash")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("hash")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_token_counts, op2_chat_format, op3_sharding, op4_language_id, op5_line_dedup, op6_ngram_join, op7_sentencepiece,
        op8_decontamination, op9_quality_rules, op10_quality_classifier, op11_spelling_variants, op12_conversation_trie, op13_toxicity, pipeline,
    )
    return {query.__name__: query for query in every}
