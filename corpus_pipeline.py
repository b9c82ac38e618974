"""From raw documents to packed training sequences, each stage one operator of ``tallymart.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymart.llm import line_dedup, mixing, packing, quality_model, simhash
from tallymart.llm.catalog import tokenizer_path
from tallymart.llm.common import table
from tallymart.session import new_shared_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, does not reject. Empty documents are judged like any other; an empty table stays empty."""
    return quality_model.accepted(docs, table(spark, sf_dir, "labels"))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of 20 or more characters that three or more of them hold, except in the last; null texts stay null."""
    return line_dedup.deduplicated(docs)


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document (by doc_id) of each group of near copies, with five-word shingles and a similarity of 0.8; documents without a doc_id stay."""
    return simhash.one_of_each(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that sources, languages and topics come nearer to equal weights; null sources and languages count as empty ones."""
    return mixing.sample(docs, temperature=0.97)


def window_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens, each with the mixture of all; a null text has its end token only."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_deduplication),
    ("simhash_near_dedup", near_duplicate_removal),
    ("source_mixing", source_mixing),
    ("packing", window_packing),
]

# The first stage is a fitted model and the last one a tokenizer: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_shared_path(spark, f"stage_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
