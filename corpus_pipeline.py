"""The training-data pipeline: stages that each apply one operator to the documents the last one kept.

Every stage takes (session, documents, folder of given tables) and returns documents with the same columns,
the last one with the encoded text besides. Null texts fail the quality rules; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areascore.llm import bpe, decontaminate, quality_rules, secret_scan, set_join
from areascore.session import small_batches
from areascore.sources.storage import fresh_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
TOKENIZER = "word_bpe_49k.json"
#: Near copies of this stage; the query op4 has a contract of its own.
SHINGLE, PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.apply_rules(docs).where("kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of linked documents; documents without id stay.

    Of rows with one id and one text a single one stays, of one id with several texts every text.

    Documents are linked if their sets of SHINGLE words in a row have a similarity of PERCENT or more.
    """
    first = set_join.join(docs, shingle=SHINGLE, percent=PERCENT).where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.where("doc_id IS NULL")).select(docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark text was found."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.mark(docs, benchmark).where(F.size("leaks") == 0).select(docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; ``n_chars`` follows the text."""
    masked = secret_scan.scan(docs, redact=True)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.when(F.size("secret_spans") > 0, F.length("text")).otherwise(F.col("n_chars")))
    return masked.select(docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their tokens: ``n_tokens``, ``ids`` (little-endian 32-bit) and ``decoded``."""
    return bpe.encode_texts(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("secret_scans", secrets),
    ("bpe_encoding", encoding),
]

# Similarity groups, latent retrieval and token ids are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        with small_batches(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
