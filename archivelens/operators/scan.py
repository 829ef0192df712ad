"""What an archive holds, from its paths (inventory A5, A6, P24)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import frontmatter as FM
from . import classify

#: What tells a type in a path; upper and lower case matter.
TYPE_PATTERNS = {
    "application": [r"(?<![a-zA-Z])(?:Application|submission|Submitted)(?![a-zA-Z])"],
    "report": [r"(?<![a-zA-Z])(?:Report|report|Annual Update|Mid-Cycle|Final Report)(?![a-zA-Z])"],
    "notification": [r"(?<![a-zA-Z])(?:Notification|Approval|approval|result|Result)(?![a-zA-Z])"],
    "budget": [r"(?<![a-zA-Z])(?:Budget|Financial|CADAC|P\+L|cash flow)(?![a-zA-Z])"],
    "activity_list": [r"(?<![a-zA-Z])(?:Activity List|Activities|Activity Report)(?![a-zA-Z])"],
    "staff_board": [r"(?<![a-zA-Z])(?:Staff|Board|Bios|BoardOfDirectors)(?![a-zA-Z])"],
    "support_material": [r"(?<![a-zA-Z])(?:Support|Promotional|promo|press|Press)(?![a-zA-Z])"],
}
DRAFT_MARKS = ["draft", "prep", "todo", "working"]
#: Fixed values for plans: tokens in and out of each step's prompt, prices for a million, files a minute, and a converter's price.
TOKENS = {"rewrite": (3000, 2500), "prioritize": (200, 100), "wiki": (2000, 1500)}
PRICE_IN, PRICE_OUT = 0.14, 0.28
CONVERTED_A_MINUTE, MODEL_A_MINUTE = 6, 60
CONVERTER_PRICES = {"datalab": 0.06}


def is_draft(path: Column) -> Column:
    return F.lower(path).rlike("|".join(DRAFT_MARKS))


def scanned(files: DataFrame, funders: list[str], patterns: dict[str, list[str]] | None = None) -> DataFrame:
    """Files (filename, filepath) with extension, funder, year, types and draft. The year must not touch letters, digits or underscores."""
    path = F.col("filepath")
    return files.select(
        "filename", "filepath", F.lower(F.regexp_extract("filename", r"[^.](\.[^.]*)$", 1)).alias("extension"), classify.funder(path, funders).alias("funder"),
        FM.year_of(path).alias("year"), classify.doc_types(path, patterns or TYPE_PATTERNS, fold=False).alias("types"), is_draft(path).alias("draft"),
    )


def by_extension(rows: DataFrame) -> DataFrame:
    return rows.groupBy("extension").agg(F.count("*").alias("files"))


def by_funder(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """Files of each funder, its full name and the years it occurs in, ascending."""
    by = rows.filter("funder is not null").groupBy("funder").agg(F.count("*").alias("files"), F.array_sort(F.collect_set("year")).alias("years"))
    full = F.create_map(*(F.lit(x) for kv in names.items() for x in kv)) if names else F.create_map()
    return by.withColumn("full_name", F.coalesce(F.try_element_at(full, F.col("funder")), F.col("funder")) if names else F.col("funder"))


def by_year(rows: DataFrame) -> DataFrame:
    return rows.filter("year is not null").groupBy("year").agg(F.count("*").alias("files"))


def by_type(rows: DataFrame) -> DataFrame:
    """Files of each type; a file counts for each of its types. Files without one are unrecognized."""
    return rows.select(F.explode(F.when(F.size("types") > 0, F.col("types")).otherwise(F.array(F.lit("unrecognized")))).alias("type")).groupBy("type").agg(F.count("*").alias("files"))


def drafts(rows: DataFrame) -> DataFrame:
    return rows.filter("draft").select("filename")


def costs(rows: DataFrame, converter: str = "datalab", workers: int = 5, price_in: float = PRICE_IN, price_out: float = PRICE_OUT) -> DataFrame:
    """One row of what processing the archive would cost, and take in whole minutes."""
    n = rows.agg(F.count("*").alias("total"), F.count_if(F.col("extension") != ".md").alias("other"))
    each = {k: i * (price_in / 1e6) + o * (price_out / 1e6) for k, (i, o) in TOKENS.items()}
    total, other = F.col("total"), F.col("other")
    parts = {"conversion": other * F.lit(CONVERTER_PRICES.get(converter, 0.0))} | {k: total * F.lit(v) for k, v in each.items()}
    money = {f"{k}_usd": F.bround(v, 2) for k, v in parts.items()} | {"total_usd": F.bround(sum(parts.values(), F.lit(0.0)), 2)}
    time = F.floor(other / (CONVERTED_A_MINUTE * min(workers, 3)) + total / MODEL_A_MINUTE).alias("minutes")
    return n.select("total", *(v.alias(k) for k, v in money.items()), time)
