"""The corpus pipeline: quality, exact copies, near copies, repeated passages, packing.

Each stage reads all rows its predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from emporium.llm import common, exact_dedup, packing, quality, queries, simhash, suffix


# A passage of over 50 words is to go; the shortest of them have under 300 bytes (the query op10 has a width of its own).
PASSAGE_BYTES = 256


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, common.read_table(spark, sf_dir, "labels"))


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix.cut_repeated_bytes(docs, PASSAGE_BYTES)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, queries.tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", without_exact_copies),
    ("SimHash near-dedup", without_near_copies),
    ("suffix-array dedup", without_repeated_passages),
    ("packing", packed_sequences),
]

# The learnt classifier and the tokenizer can't be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
