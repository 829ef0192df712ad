"""Queries of the subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fingerprints, language, licenses, mixing, neardup, packing, quality, rans, token_counts, tokens, urls

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), tokens.tokenizer_path(BYTE_BPE))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(_table(spark, sf_dir, "documents"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(_table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = rans.round_trip(_table(spark, sf_dir, "documents"), tokens.tokenizer_path(WORD_BPE))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(_table(spark, sf_dir, "documents"), tokens.tokenizer_path(BYTE_BPE)))


def op8_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    judged = urls.judge(urls.captures_of(pages), urls.example_entries(pages))
    return judged.withColumns({c: F.col(c).cast("string") for c in ("fetched_on", "active_from")})


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def catalogue() -> dict:
    """Name -> (query, oracle SQL or None)."""
    return {
        "op1_token_counts": (op1_token_counts, None),
        "op2_fingerprints": (op2_fingerprints, fingerprints.oracle()),
        "op3_near_duplicates": (op3_near_duplicates, None),
        "op4_token_files": (op4_token_files, None),
        "op5_licenses": (op5_licenses, licenses.oracle()),
        "op6_quality_rules": (op6_quality_rules, None),
        "op7_packing": (op7_packing, None),
        "op8_url_lists": (op8_url_lists, urls.oracle()),
        "op9_language": (op9_language, None),
        "op10_mixing": (op10_mixing, mixing.oracle()),
        "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
    }
