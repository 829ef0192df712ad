"""Flat file names for a nested archive (inventory P26-P30, W5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import frontmatter as FM
from ..functions import text as X

#: Words that tell a type; the first type with a word in the path counts.
KEYWORDS = {
    "application": ["application", "submission", "submitted", "grant application", "project grant", "operating grant"],
    "report": ["report", "annual report", "final report", "mid-cycle report", "mid cycle report", "annual update", "progress report"],
    "budget": ["budget", "financial", "cadac", "p+l", "cash flow", "financial statement", "p&l"],
    "notification": ["notification", "approval", "result", "notice", "award letter"],
    "activity_list": ["activity list", "activity report", "activities", "program of activities"],
    "staff_board": ["staff", "board", "bios", "board of directors", "board list", "staff list"],
    "support_material": ["support material", "promotional", "promo", "press", "supplementary", "letter of support"],
}
REVIEW_BELOW = 0.65


def keyword_type(path: Column) -> Column:
    folded = F.translate(F.lower(path), "/_", "  ")
    return X.first_case([(X.any_of(F.contains(folded, F.lit(w)) for w in words), kind) for kind, words in KEYWORDS.items()])


def segment_year(path: Column) -> Column:
    """The first year of any segment of a path; no match crosses a slash, which is no word character."""
    return FM.year_of(F.regexp_extract(path, r"\b(20\d{2})\b", 1))


def _capitalised(words: Column) -> Column:
    return F.transform(words, lambda w: F.concat(F.upper(w.substr(1, 1)), F.lower(w.substr(F.lit(2), F.length(w)))))


def description(filename: Column, funder: Column, year: Column, kind: Column) -> Column:
    """What a file name says besides funder, year and type, each word with a capital."""
    stem = F.regexp_replace(filename, r"\.[^.]*$", "")
    quoted = lambda c: F.concat(F.lit(r"(?i)\Q"), c, F.lit(r"\E"))
    t = F.translate(stem, "_-", "  ")
    t = F.when(funder.isNotNull(), F.regexp_replace(t, F.concat(quoted(funder), F.lit(r"\b")), F.lit(""))).otherwise(t)
    t = F.replace(t, F.coalesce(year.cast("string"), F.lit("0000")), F.lit(""))
    word = F.translate(kind, "_", " ")
    t = F.when(kind.isNotNull(), F.regexp_replace(t, F.concat(F.lit(r"(?i)\b\Q"), word, F.lit(r"\E\b")), F.lit(""))).otherwise(t)
    t = F.regexp_replace(t, r"(?U)[^\w\s]", "")
    return F.array_join(_capitalised(F.filter(F.split(t, r"(?U)\s+"), lambda w: w != "")), " ")


def confidence(funder: Column, year: Column, kind: Column) -> Column:
    part = lambda c, w: F.when(c.isNotNull(), w).otherwise(0.0)
    return F.bround(part(funder, 0.35) + part(year, 0.35) + part(kind, 0.30), 2)


def plan(files: DataFrame, funders: list[str]) -> DataFrame:
    """For each file (filepath, from the archive's root): where it goes and how sure that is.

    Equal names get _1, _2 and so on, in order of their old paths.
    """
    from .classify import funder as found

    path = F.col("filepath")
    name = F.element_at(F.split(path, "/"), -1)
    d = files.filter(~name.startswith(".") & name.rlike(r"[^.]\.[^.]+$")).select(path.alias("old_path"), found(path, funders).alias("funder"), segment_year(path).alias("year"), keyword_type(path).alias("doc_type"), name.alias("name"))
    d = d.withColumn("description", description(F.col("name"), F.col("funder"), F.col("year"), F.col("doc_type")))
    middle = F.concat_ws("_", F.coalesce(F.col("year").cast("string"), F.lit("0000")), F.when(F.col("description") != "", F.translate("description", " ", "_")))
    ext = F.lower(F.regexp_extract("name", r"(\.[^.]*)$", 1))
    stem = F.concat_ws("__", F.coalesce("funder", F.lit("UNKNOWN")), middle, F.coalesce("doc_type", F.lit("unknown")))
    d = d.withColumns({"stem": stem, "ext": ext}).withColumn("suggested_filename", F.concat("stem", "ext"))
    again = F.row_number().over(Window.partitionBy("suggested_filename").orderBy("old_path")) - 1
    d = d.withColumns({"again": again, "confidence": confidence(F.col("funder"), F.col("year"), F.col("doc_type"))})
    target = F.when(F.col("again") == 0, F.col("suggested_filename")).otherwise(F.concat("stem", F.lit("_"), F.col("again").cast("string"), "ext"))
    return d.select("old_path", "suggested_filename", target.alias("target"), "funder", "year", "doc_type", "description", "confidence", (F.col("confidence") < REVIEW_BELOW).alias("needs_review"))
