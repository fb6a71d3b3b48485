"""A corpus pipeline of five operators, each stage on all that its predecessor kept.

Stages read the columns of `documents` by name; other columns of any name are not read and not
kept. Rows are told apart by id and text, so rows that share an id, NULL too, are judged by their
own texts. Texts are taken whole, whatever their length. An empty table passes as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterproof.llm import decontamination, line_dedup, ngram_join, pieces, quality_classifier
from meterproof.llm.common import stored
from meterproof.llm.queries import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: SQL cannot express the classifier or the encoder.
ORACLE_SQL = None


def _rows_of(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """The rows of `docs` that are not among the rejected rows `judged`, by id and text hash:
    rows that share an id, NULL too, are judged by their own texts."""
    # By shuffle at every size: the rejected rows grow with the corpus.
    rejected = judged.select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash")).distinct().hint("merge")
    rows = docs.withColumn("_of", F.xxhash64("text"))
    same = rows["doc_id"].eqNullSafe(rejected["_id"]) & (rows["_of"] == rejected["_hash"])
    return rows.join(rejected, same, "left_anti").select(*COLUMNS)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    NULL and empty texts are scored as texts without characters; repeated rows and equal texts get
    the same verdict. Rows that share id and text go or stay together.
    """
    scored = quality_classifier.score_quality(docs, table(spark, sf_dir, "labels"))
    return _rows_of(docs, scored.where("predicted = 0"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of three-line passages go; a document that has lost all its lines goes too.

    NULL and empty texts have no passage and stay; rows that share id and text get
    equal results, of equal texts that of the lowest id (NULL first) keeps its lines. n_chars is counted again, NULL for a NULL text.
    """
    left = line_dedup.dedup_lines(docs, keep=("lang", "source"))
    kept = left.where("n_removed = 0 OR n_removed < n_lines")
    return kept.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays.

    It is that of the smallest id, of equal ids that of the smallest text hash; of repeated rows one
    stays. Texts without words, NULL and empty ones too, link with nothing and all stay.
    """
    return ngram_join.one_of_each_group(docs).select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage, by the contamination rule, go.

    NULL and empty texts have no words and stay; repeated rows get equal verdicts. Without benchmark
    items nothing goes.
    """
    found = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return _rows_of(docs, found.where("contaminated"))


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as ids of pieces, decoded again: round_trip tells whether that gives the text.

    NULL and empty texts have no pieces; repeated rows and ids are encoded each.
    """
    encoded = pieces.encode_checked(docs)
    return encoded.select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids", "round_trip")


STAGES = [
    ("quality classifier", quality_classifier_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", ngram_join_stage),
    ("benchmark decontamination", decontamination_stage),
    ("SentencePiece encoding and decoding", sentencepiece_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written before the next stage reads it.

    Returns doc_id, n_pieces, piece_ids and round_trip of every row that all stages kept.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
