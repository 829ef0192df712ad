"""Checks of an agent's answers against a scenario's criteria (inventory F18, F19)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


@dataclass(frozen=True)
class Criteria:
    must_contain: list[str] = field(default_factory=list)
    should_contain: list[str] = field(default_factory=list)
    min_source_count: int = 0
    min_files_found: int = 0
    min_years_found: int = 0
    min_facts: int = 0
    word_count_range: tuple[int, int] | None = None


def counts(t: Column) -> dict[str, Column]:
    refs = F.regexp_extract_all(t, F.lit(r"(?U)[\w_-]+\.md"), F.lit(0))
    years = F.regexp_extract_all(t, F.lit(r"\b(20[0-2]\d|209\d)\b"), F.lit(1))
    return {
        "source_count": F.size(refs),
        "files_found": F.size(F.array_distinct(refs)),
        "years_found": F.size(F.array_distinct(years)),
        "facts_found": X.count_if(X.lines(X.strip(t)), lambda x: x.rlike(r"\b\d{4}\b") | x.rlike(r"\$\d[\d,]*")),
        "word_count": F.size(F.filter(F.split(t, "[" + X.SPACES + "]+"), lambda w: w != "")),
    }


def evaluated(outputs: DataFrame, text: str, c: Criteria) -> DataFrame:
    """``outputs`` with the counts, passed, and errors."""
    low = F.lower(F.col(text))
    d = outputs.withColumns(counts(F.col(text)))
    fails = [F.when(~F.contains(low, F.lit(p.lower())), f"Missing required content: '{p}'") for p in c.must_contain]
    limits = [("source_count", c.min_source_count, "sources"), ("files_found", c.min_files_found, "files"), ("years_found", c.min_years_found, "years"), ("facts_found", c.min_facts, "facts")]
    fails += [F.when(F.col(k) < n, F.concat(F.lit(f"Insufficient {what}: "), F.col(k).cast("string"), F.lit(f" < {n}"))) for k, n, what in limits if n]
    if c.word_count_range:
        lo, hi = c.word_count_range
        fails.append(F.when(~F.col("word_count").between(lo, hi), F.concat(F.lit("Word count "), F.col("word_count").cast("string"), F.lit(f" outside range [{lo}, {hi}]"))))
    errors = F.filter(F.array(*fails), lambda x: x.isNotNull()) if fails else F.array().cast("array<string>")
    should = sum((F.contains(low, F.lit(p.lower())).cast("int") for p in c.should_contain), F.lit(0))
    return d.withColumns({"errors": errors, "should_found": should}).withColumn("passed", F.size("errors") == 0)


def lines_with(docs: DataFrame, key: str, text: str, keyword: str) -> DataFrame:
    rows = docs.select(key, F.posexplode(X.lines(F.col(text))).alias("at", "row")).filter(F.contains(F.lower("row"), F.lit(keyword.lower())))
    return rows.select(key, (F.col("at") + 1).alias("line"), X.strip(F.col("row")).alias("row"))
