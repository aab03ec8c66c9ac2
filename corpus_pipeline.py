"""Documents on their way to a training corpus: scored, deduplicated, decontaminated, encoded.

Each stage works on what the one before it kept, and is written before the next one reads it. All
take null ids and texts, repeated rows and empty tables, and keep every column of the documents
(any names but those of the operators' results); what each does with them is stated with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesmill.llm import line_dedup, sentence_pieces, simhash, tiling, toxicity
from salesmill.llm.common import read_table, stage


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network does not call toxic. It learns from the labelled among them.

    A null text counts as empty and gets a score as any other; long texts are scored in all
    their windows. Repeated rows get the same score. Without labels of both classes nothing is called toxic.
    """
    return toxicity.without_toxic(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines in later copies of repeated runs; those left empty by it go.

    A null or empty text has no such lines and stays as it is. Rows equal in id and text are one
    document, all of which get its result; long texts count whole.
    """
    return line_dedup.without_repeated_runs(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id (null last).

    Fingerprints of four-word shingles link at four differing bits or fewer. Texts that are null or
    hold no words have the same fingerprint and are one group. Very long texts count whole. Of
    repeated rows one stays.
    """
    return simhash.one_of_each_group(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark.

    Null and empty texts hold none and stay; an item without words is held by none. Texts count
    whole, repeated rows each get the same answer.
    """
    return tiling.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left as piece ids, with the check that they decode to the text.

    A null or empty text has no ids. A row for each row; the result is of the operator's columns.
    """
    import public_tokenizers

    return sentence_pieces.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("sentence_pieces", encoding_stage),
]

# No stage but the fourth can be told in SQL; tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents; an empty table gives no rows."""
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
