"""A corpus pipeline: quality rules, near duplicates, repeated passages, source mix and tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's ``docs``. All but
the last return the columns of documents. Empty tables, null and repeated rows pass through as each operator defines.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlens.llm import bpe, mixing, ngrams, quality, substrings
from ledgerlens.llm.frames import kept, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles the one with the smallest doc_id stays."""
    return ngrams.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words that stand earlier in the corpus are cut out of the texts."""
    return substrings.remove_substrings(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are dropped or repeated so that sources come near their targets."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text decoded from them."""
    encoded = bpe.encode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, keep=("doc_id", "lang", "source"))
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing sources to target weights", source_mix),
    ("byte-level BPE encoding and decoding", tokens),
]

ORACLE_SQL = None  # byte-level BPE cannot be said in SQL; tests/llm/test_pipeline.py has a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
