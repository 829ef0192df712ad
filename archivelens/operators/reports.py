"""What reports show of results: the first rows, samples, states, and texts of them (inventory O3-O6, A28, K9, K12, H24)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Findings of a check that are shown, and failures that are listed.
SHOWN, FAILURES = 10, 20
STATUSES = ["ok", "warn", "error", "info"]


def first_of(rows: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows in a total order; null and negative numbers mean all."""
    return rows if n is None or n < 0 else rows.orderBy(*order).limit(n)


def sample(rows: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """``n`` rows drawn by a hash of their key and a seed: the same rows in every run, whatever their partitions."""
    return rows.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary")), key).limit(n)


def shown(findings: DataFrame, by: str, *order: str, n: int = SHOWN) -> DataFrame:
    """The first ``n`` findings of each check, with how many ``more`` it has.

    A check may have most findings, so the first are found check by check from partial lists of ``n``, never by ordering all.
    """
    numbered = findings.withColumn("_part", F.spark_partition_id())
    part = Window.partitionBy(by, "_part").orderBy(*order)
    few = numbered.withColumn("_rank", F.row_number().over(part)).filter(F.col("_rank") <= n).drop("_part", "_rank")
    top = few.withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("place") <= n)
    totals = findings.groupBy(F.col(by).alias("_by")).agg(F.count("*").alias("_n"))
    joined = top.join(totals, F.col(by).eqNullSafe(F.col("_by")))
    return joined.withColumn("more", F.greatest(F.col("_n") - n, F.lit(0))).drop("_by", "_n")


def first_failures(results: DataFrame, n: int = FAILURES) -> DataFrame:
    """filename and error of the first failures by name."""
    return first_of(results.filter("status = 'failed'").select("filename", "error"), n, "filename")


def stage_states(listings: dict[str, DataFrame | None]) -> DataFrame:
    """check, status and message for each stage's folder (a listing; None: not there) and each step from one to the next.

    Stages are in order; a step is worth a warning if the later folder is empty and the earlier is not.
    """
    spark = next(d for d in listings.values() if d is not None).sparkSession
    counts = {name: None if d is None else d.count() for name, d in listings.items()}  # one number for each stage
    rows = [(f"dir: {name}", "warn" if n is None else "ok", f"{name} does not exist" if n is None else f"{name} exists ({n} files)") for name, n in counts.items()]
    names = list(counts)
    for early, late in zip(names, names[1:]):
        a, b = counts[early], counts[late]
        if a and b == 0:
            rows.append(("pipeline", "warn", f"{early} has {a} files but {late} is empty"))
        elif a and b is not None and b < a:
            rows.append(("pipeline", "ok", f"{late} {b} files (of {a} in {early})"))
    return spark.createDataFrame(rows, "check string, status string, message string")


def by_status(checks: DataFrame) -> DataFrame:
    """How many checks have each status, also those that none has."""
    every = checks.sparkSession.createDataFrame([(s,) for s in STATUSES], "status string")
    counts = checks.groupBy("status").agg(F.count("*").alias("checks"))
    return every.join(counts, "status", "full_outer").select("status", F.coalesce("checks", F.lit(0)).alias("checks"))


def as_table(rows: DataFrame, *order: str, title: str | None = None) -> str:
    """A small result as a Markdown table; results of reports have a row for each status, check, tier or funder."""
    names = rows.columns
    out = ([f"## {title}", ""] if title else []) + ["| " + " | ".join(names) + " |", "|---" * len(names) + "|"]
    for r in rows.orderBy(*(order or names)).collect():
        cells = ("" if v is None else ", ".join(map(str, v)) if isinstance(v, list) else f"{v:.4g}" if isinstance(v, float) else str(v) for v in r)
        out.append("| " + " | ".join(cells) + " |")
    return "\n".join(out) + "\n"
