"""From raw documents to packed training sequences: five stages, each one operator of ``archivelens.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame.  All but the last return the columns of
``documents``, with the documents that stay; the last returns the pieces of the packed sequences.
Each first frees what the stage before it left in the driver.

Odd input: null and empty texts go at the first stage; a null id or source is a value like any other (of sources,
the last); ties are settled by doc_id; of repeated rows one stays behind near-dedup, and mixing may repeat documents;
whole texts of any length are read; extra columns stay up to packing, whatever their names; an empty table gives no piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivelens.llm import language, mixing, neardup, packing, quality, tokens
from archivelens.llm.storage import keep, tidy

#: No SQL: the quality model is fitted by iteration, and the packer needs a tokenizer.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go."""
    tidy(spark)
    return language.language_filter(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or are probably bad, go."""
    tidy(spark)
    return quality.quality_filter(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    tidy(spark)
    return neardup.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated, so that sources have their target weights."""
    tidy(spark)
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences: doc_id, start, length, ids, doc_tokens, sequence_id, offset."""
    tidy(spark)
    pieces = packing.pack(docs, tokens.tokenizer_path("byte_bpe_50k.json"))
    return pieces.withColumn("length", (F.octet_length("ids") / 4).cast("long"))


STAGES = [
    ("language ID", language_id),
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; what each returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else keep(docs, f"stage{k}"), sf_dir)
    return docs
