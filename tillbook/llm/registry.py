"""The registered queries of the operators and of the pipeline, with their SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillbook.llm import (
    byte_bpe,
    license_scan,
    lm_score,
    manifest,
    near_dup,
    nearest,
    piece_encoding,
    pseudonyms,
    quality_rules,
    repeats,
    secret_scan,
    source_mix,
    sql,
    turn_repair,
)

#: For the registered queries only: a real key belongs in the session's settings.
DEMO_KEY = "not a secret: for the registered queries"
KEY_SETTING = "spark.tillbook.pseudonym.key"
RANKS = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pseudonym_key(spark: SparkSession) -> str:
    return spark.conf.get(KEY_SETTING, DEMO_KEY)


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.digest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(documents(spark, sf_dir))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(documents(spark, sf_dir))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.digest(documents(spark, sf_dir))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(documents(spark, sf_dir))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest(documents(spark, sf_dir), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.digest(documents(spark, sf_dir))


def op8_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, pseudonym_key(spark), count_as="n_values")


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.digest(documents(spark, sf_dir))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rate(documents(spark, sf_dir))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_encoding.digest(documents(spark, sf_dir), public_tokenizers.path(PIECES))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.digest(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.digest(documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    # At the repository top, beside the entry file.
    return importlib.import_module("corpus_pipeline").run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_nearest, op2_repeats, op3_secrets, op4_source_mix, op5_licenses, op6_byte_bpe, op7_lm_score, op8_pseudonyms, op9_near_dup, op10_quality, op11_sentencepiece, op12_turn_repair, op13_manifest, pipeline)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op12_turn_repair": sql.turn_repair_sql(), "op13_manifest": sql.manifest_sql()}
