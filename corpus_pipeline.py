"""A training corpus from raw documents, in five stages. Each takes and returns documents (the last one: token ids)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadweave.llm import mixing, near_copies, quality_rules, sentencepiece_tok, suffix_dedup
from roadweave.llm.common import new_path, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality_rules.judge_quality(docs, prefix="_q_")
    return judged.where("_q_kept").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, whose sets of five-word shingles have a similarity of 0.8 or more: that of the smallest id."""
    return near_copies.keep_one_of_near_copies(docs, shingle=5, deal=near_copies.Deal(similarity=0.8))


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 200 bytes that start more than once; n_chars is that of the text that is left."""
    left = suffix_dedup.without_repeats(docs)
    return left.withColumn("n_chars", F.char_length(F.coalesce("text", F.lit(""))).cast("bigint")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix of the sources takes it."""
    return mixing.take_mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    return sentencepiece_tok.encoded(docs).select("doc_id", "lang", "source", "n_tokens", "token_ids", "decodes", "parity")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("simhash near-dedup", near_dedup),
    ("suffix-array dedup", passage_dedup),
    ("mixing sources", mix),
    ("sentencepiece encoding", tokenize),
]

#: SQL has neither zstandard ratios nor XXH64 fingerprints; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = new_path(spark, f"pipeline-{i}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
