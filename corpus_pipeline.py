"""A corpus pipeline of five stages over ``documents``, each calling one operator.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it as Parquet
in the session's shared folder and reads it again as the next stage's docs. All stages
but the last return the columns of ``documents``; the last returns doc_id, source, the
ids as an array, and the digest of the decoded bytes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.llm import byte_bpe, near_dup, pseudonyms, quality_rules, registry, source_mix
from tillbook.sources.scratch import write_scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, 0.8 or more."""
    return near_dup.kept_documents(docs, width=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes pseudonyms; ``n_chars`` follows the new text."""
    new = pseudonyms.pseudonymise(docs, registry.pseudonym_key(spark))
    return new.withColumn("n_chars", F.length("text").cast("bigint"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return source_mix.mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digest of what they decode to."""
    path = public_tokenizers.path(registry.RANKS)
    encoded = byte_bpe.decode(byte_bpe.encode(docs, path, public_tokenizers.PATTERN), path)
    return encoded.select("doc_id", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("personal data", personal_data),
    ("source mixing", source_mixing),
    ("encoding", encoding),
]

#: Near-duplicates, pseudonyms and byte-pair merges are beyond SQL; tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = write_scratch(stage(spark, docs, sf_dir))
    return docs
