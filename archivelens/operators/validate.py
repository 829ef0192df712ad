"""Checks of documents against a configuration (inventory F12-F17, A8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import frontmatter as FM
from ..functions import text as X
from . import classify

#: Limits of metrics and sizes, and what is left to be filled in.
MAX_CORRUPTION, MAX_CHROME, MIN_LINE = 0.3, 20, 30
MIN_BYTES, MAX_BYTES = 500, 1_000_000
PLACEHOLDERS = {r"\[TODO\]": "TODO", r"\[FIXME\]": "FIXME", r"\[UNKNOWN\]": "UNKNOWN", r"\[TBD\]": "TBD", r"\{placeholder\}": "{placeholder}"}
REQUIRED = ["funder", "type", "written"]
THIN = 50


def _issue(kind: str, message: Column | str) -> Column:
    return F.struct(F.lit(kind).alias("issue_type"), (message if isinstance(message, Column) else F.lit(message)).alias("message"))


def frontmatter_issues(fm: Column, funders: list[str], types: list[str]) -> list[Column]:
    """Conditions as structs, null where nothing is wrong. ``fm``: fields as :func:`..functions.frontmatter.read` gives them."""
    out = [F.when(~fm["present"], _issue("missing_frontmatter", "No valid YAML frontmatter found"))]
    for f in REQUIRED:
        out.append(F.when(fm["present"] & fm[f].isNull(), _issue("missing_field", f"Required field '{f}' not found in frontmatter")))
    if funders:
        out.append(F.when((fm["funder"] != "") & ~fm["funder"].isin(funders), _issue("invalid_funder", F.concat(F.lit("Funder '"), fm["funder"], F.lit(f"' not in configured funders: {', '.join(sorted(funders))}")))))
    if types:
        wrong = F.filter(F.transform(F.split(fm["type"], ","), X.strip), lambda t: ~t.isin(types))
        out.append(F.when((fm["type"] != "") & (F.size(wrong) > 0), _issue("invalid_doc_type", F.concat(F.lit("Document type(s) "), F.array_join(wrong, ", "), F.lit(f" not in configured types: {', '.join(sorted(types))}")))))
    p = fm["priority"].try_cast("int")
    out.append(F.when(fm["priority"].isNotNull() & F.coalesce(~p.between(1, 3), F.lit(True)), _issue("invalid_priority", F.when(p.isNotNull(), F.concat(F.lit("Priority must be 1-3, got "), fm["priority"])).otherwise(F.concat(F.lit("Priority must be an integer, got "), fm["priority"])))))
    out.append(F.when(fm["errors"].try_cast("int") < 0, _issue("negative_errors", F.concat(F.lit("Errors count must be non-negative, got "), fm["errors"]))))
    return out


def content_issues(text: Column, m: dict[str, Column]) -> list[Column]:
    empty = X.strip(text) == ""
    number = lambda c, n: F.format_number(c, n)
    return [
        F.when(empty, _issue("empty_body", "File body is empty")),
        F.when(~empty & (m["corruption_score"] > MAX_CORRUPTION), _issue("corruption", F.concat(F.lit("Corruption score "), number(m["corruption_score"], 3), F.lit(f" exceeds threshold {MAX_CORRUPTION}")))),
        F.when(~empty & (m["form_chrome_count"] > MAX_CHROME), _issue("form_chrome", F.concat(F.lit("Form chrome count "), m["form_chrome_count"].cast("string"), F.lit(f" exceeds threshold {MAX_CHROME}")))),
        F.when(~empty & (m["draft_marker_count"] > 0), _issue("draft_marker", F.concat(m["draft_marker_count"].cast("string"), F.lit(" draft markers found in content")))),
        F.when(~empty & (m["avg_content_line_length"] < MIN_LINE) & (m["content_lines"] > 0), _issue("short_lines", F.concat(F.lit("Average content line length "), number(m["avg_content_line_length"], 1), F.lit(f" below minimum {MIN_LINE}")))),
    ]


def size_issues(text: Column) -> list[Column]:
    n = F.octet_length(text)
    return [
        F.when(n < MIN_BYTES, _issue("size_anomaly", F.concat(F.lit("File size "), n.cast("string"), F.lit(f" bytes below minimum {MIN_BYTES}")))),
        F.when(n > MAX_BYTES, _issue("size_anomaly", F.concat(F.lit("File size "), n.cast("string"), F.lit(f" bytes exceeds maximum {MAX_BYTES}")))),
    ]


def placeholders(text: Column) -> Column:
    """What is left to be filled in, as an array; question marks with the number of their lines."""
    asked = X.count_if(X.lines(text), lambda x: F.contains(x, F.lit("???")))
    found = [F.when(text.rlike(p), shown) for p, shown in PLACEHOLDERS.items()]
    return F.filter(F.array(*found[:4], F.when(asked > 0, F.concat(F.lit("??? ("), asked.cast("string"), F.lit(" lines)"))), *found[4:]), lambda x: x.isNotNull())


def placeholder_issues(text: Column) -> list[Column]:
    marks = placeholders(text)
    return [F.when(F.size(marks) > 0, _issue("placeholder", F.concat(F.lit("Placeholders detected: "), F.array_join(marks, ", "))))]


def headings(text: Column) -> Column:
    """Names of the second-level headings."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(?dm)^##\s+(.+)"), F.lit(1)), X.strip)


def missing_sections(text: Column, expected: list[str]) -> Column:
    have = F.transform(headings(text), F.lower)
    return F.filter(X.literals(expected), lambda s: ~F.array_contains(have, F.lower(X.strip(s))))


def thin_sections(text: Column) -> Column:
    """Second-level sections with fewer than THIN characters that aren't blanks: structs of section and chars.

    A section ends at the next line that begins with a number sign.
    """
    parts = F.regexp_extract_all(F.concat(F.lit("\n"), text), F.lit(r"(?s)(\n##\s+[^\n]+(?:\n(?!#)[^\n]*)*)"), F.lit(1))
    name = lambda p: X.strip(F.regexp_extract(p, r"^\n##\s+([^\n]+)", 1))
    chars = lambda p: F.length(F.replace(X.strip(F.regexp_replace(p, r"^\n##\s+[^\n]+", "")), F.lit(" "), F.lit("")))
    found = F.transform(parts, lambda p: F.struct(name(p).alias("section"), chars(p).alias("chars")))
    return F.filter(found, lambda s: s["chars"] < THIN)


def issues(files: DataFrame, funders: list[str], types: list[str], sections: dict[str, list[str]] | None = None, config: dict = classify.CONFIG) -> DataFrame:
    """filename, issue_type and message of everything that is wrong with files (filename, content)."""
    fm = FM.read(FM.block(F.col("content")))
    d = classify.with_metrics(files.select("filename", "content").withColumn("fm", fm), config)
    t = F.col("content")
    found = [*frontmatter_issues(d["fm"], funders, types), *content_issues(t, {m: F.col(m) for m in classify.METRICS}), *size_issues(t), *placeholder_issues(t)]
    more = [F.filter(F.array(*found), lambda x: x.isNotNull())]
    for funder, expected in (sections or {}).items():
        lacks = missing_sections(t, expected)
        here = F.col("fm.funder") == funder
        more.append(F.when(here & (F.size(lacks) > 0), F.array(_issue("missing_sections", F.concat(F.lit(f"Missing sections for {funder}: "), F.array_join(lacks, ", "))))).otherwise(F.slice(F.array(_issue("", "")), 1, 0)))
        thin = F.transform(thin_sections(t), lambda s: F.struct(F.lit("thin_section").alias("issue_type"), F.concat(F.lit("Section '"), s["section"], F.lit(f"' has fewer than {THIN} chars of content")).alias("message")))
        more.append(F.when(here, thin).otherwise(F.slice(thin, 1, 0)))
    return d.select("filename", F.explode(F.concat(*more)).alias("i")).select("filename", "i.issue_type", "i.message")


def rollup(found: DataFrame, files: DataFrame) -> DataFrame:
    """For each kind of issue: issues and files; and two rows of the files with and without any."""
    kinds = found.groupBy("issue_type").agg(F.count("*").alias("issues"), F.count_distinct("filename").alias("files"))
    n = files.agg(F.count_distinct("filename").alias("n")).join(found.agg(F.count_distinct("filename").alias("bad")), how="cross")  # one row each
    total = n.select(F.explode(F.array(F.struct(F.lit("(failed)").alias("issue_type"), F.col("bad").alias("files")), F.struct(F.lit("(passed)").alias("issue_type"), (F.col("n") - F.col("bad")).alias("files")))).alias("r"))
    return kinds.unionByName(total.select("r.issue_type", F.lit(0).cast("bigint").alias("issues"), "r.files"))
