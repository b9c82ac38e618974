"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymart.llm import (bit_planes, conversation_trie, language_model, lattice, license_scan, line_dedup, mixing, packing, quality_model,
                           quality_rules, simhash, spelling, url_blocks)
from tallymart.llm.common import table
from tallymart.llm.oracles import SQL  # noqa: F401

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).withColumn("probability", F.round("probability", 6))


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scored(table(spark, sf_dir, "documents"))


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scanned(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "line", "license", "saved", F.array_join("lacks", " ").alias("lacks"), F.array_join("amid", " ").alias("amid"), "text")


def op7_url_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_blocks.judged_pages(table(spark, sf_dir, "pages"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.grouped(table(spark, sf_dir, "documents"))


def op12_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_planes.stored(bit_planes.write(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER)))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q for q in (op1_simhash, op2_mixing, op3_language_model, op4_quality_model, op5_lattice, op6_license_scan, op7_url_blocks,
                            op8_quality_rules, op9_packing, op10_line_dedup, op11_spelling, op12_bit_planes,
                            op13_conversation_trie)
}
