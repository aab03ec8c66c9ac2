"""One query per operator, over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    conversation_trie,
    line_dedup,
    main_text,
    merkle,
    quality,
    secrets,
    sentence_pieces,
    shards,
    simhash,
    tiling,
    token_files,
    toxicity,
    warc_archive,
)
from .common import read_table


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract_main_text(read_table(spark, sf_dir, "pages"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return toxicity.score_toxicity(documents, toxicity.fit(documents, labels))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_files.token_digest(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_shuffled_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_digest(read_table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return quality.judge_quality(documents, labels)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaks alone: a document that is in no row is clean."""
    documents, benchmark = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return tiling.find_leaks(documents, benchmark).select(
        "doc_id", "item_id", "item_words", "covered", "coverage", F.size("tiles").alias("n_tiles")
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(read_table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return sentence_pieces.encode_pieces(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(read_table(spark, sf_dir, "documents")).select(
        "row.doc_id", F.col("kept_text").alias("text"), "n_lines", "n_deleted"
    )


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.rebuilt_trie(read_table(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_digest(read_table(spark, sf_dir, "documents"))


def op13_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_archive.archive_digest(read_table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_main_text": op1_main_text,
    "op2_toxicity": op2_toxicity,
    "op3_token_files": op3_token_files,
    "op4_simhash": op4_simhash,
    "op5_shuffled_shards": op5_shuffled_shards,
    "op6_quality": op6_quality,
    "op7_decontaminate": op7_decontaminate,
    "op8_secrets": op8_secrets,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_line_dedup": op10_line_dedup,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_warc_archive": op13_warc_archive,
}

ORACLES: dict[str, str] = {"op8_secrets": secrets.oracle()}
