"""Archives as DataFrames: listings, texts, and sinks (inventory S1-S10, S19, S24)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXTENSIONS = [".pdf", ".docx", ".xlsx", ".doc", ".xls", ".md"]
SCANNABLE = [".md", ".markdown", ".txt", ".html", ".htm", ".csv", ".pdf", ".docx", ".xlsx"]
#: Schemes that are reserved for connectors still to come.
RESERVED = ("gdrive", "dropbox")


def _checked(path: str) -> str:
    scheme = path.split("://")[0] if "://" in path else ""
    if scheme in RESERVED:
        raise NotImplementedError(f"no connector for {scheme}:// yet")
    return path


def _name(path):
    return F.element_at(F.split(path, "/"), -1)


def listing(spark: SparkSession, path: str, extensions: list[str] | None = EXTENSIONS, hidden: bool = False) -> DataFrame:
    """filename, filepath, size_bytes, modified and extension of all files below a folder; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(_checked(path)).drop("content")
    d = files.select(_name(F.col("path")).alias("filename"), F.col("path").alias("filepath"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"))
    d = d.withColumn("extension", F.lower(F.regexp_extract("filename", r"[^.](\.[^.]*)$", 1)))
    d = d if hidden else d.filter(~F.col("filename").startswith("."))
    return d.filter(F.col("extension").isin(extensions)) if extensions else d.filter("extension <> ''")


def texts(spark: SparkSession, path: str, pattern: str = "*.md") -> DataFrame:
    """filename, filepath and content of text files below a folder, one row each."""
    d = spark.read.text(_checked(path), wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern)
    return d.select(_name(F.col("_metadata.file_path")).alias("filename"), F.col("_metadata.file_path").alias("filepath"), F.col("value").alias("content"))


def contents(spark: SparkSession, path: str) -> DataFrame:
    """filename, filepath and bytes of all files below a folder."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(_checked(path))
    return d.select(_name(F.col("path")).alias("filename"), F.col("path").alias("filepath"), "content")


def write_table(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    """Documents as a table; rerunning replaces it whole."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def split_by(docs: DataFrame, keep) -> tuple[DataFrame, DataFrame]:
    """Rows that a condition keeps, and the others, null among them: two tables instead of moved files."""
    kept = F.coalesce(keep, F.lit(False))
    return docs.filter(kept), docs.filter(~kept)
