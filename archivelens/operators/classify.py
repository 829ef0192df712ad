"""Content metrics, skip and tier rules, and their roll-ups (inventory A1-A4, P21-P23, H3-H6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import frontmatter as FM
from ..functions import text as X
from . import rules as R

#: Frequent words of either language.
FRENCH = "le la les de du des et est que qui dans pour sur une avec sont par plus faire peut ces leur pas nous vous ils elle ses aux".split()
ENGLISH = "the and for with that this have from are was not but all can had been one has were its also than them some may who which will".split()

METRICS = [
    "total_lines", "content_lines", "empty_lines", "corruption_score", "image_marker_count", "form_chrome_count", "draft_marker_count",
    "has_headings", "has_tables", "avg_content_line_length", "duplicate_heading_count", "word_count_annotation_count",
]

#: What the queries classify with.
CONFIG = {
    "form_chrome": [r"(?i)writing tip", r"(?i)total files"],
    "draft_markers": [r"\bTBD\b", r"\[TODO\]"],
    "doc_types": {k: [rf"(?i)\b{k.replace('_', ' ')}\b"] for k in ("application", "report", "budget", "notification", "activity_list", "staff_board")},
    "skip_rules": [
        {"condition": "draft_marker_count > 0 and not has_tables", "reason": "{draft_marker_count} draft markers"},
        {"condition": "content_lines < 8", "reason": "Too short: {content_lines} lines"},
    ],
    "tier_rules": [
        {"condition": "has_any_type('application', 'report') and (content_lines >= 20 or has_tables)", "tier": "full"},
        {"condition": "form_chrome_count > 0 or duplicate_heading_count > 0", "tier": "light"},
        {"conditions": [{"type": "path_contains", "values": ["Budget", "Board"]}, {"type": "field_lt", "field": "corruption_score", "value": 0.1}], "match": "all", "tier": "light"},
    ],
}


def language(t: Column) -> Column:
    """en, fr or mixed, by how many frequent words of each language a text has."""
    seen = F.array_distinct(F.split(F.lower(t), "[" + X.SPACES + "]+"))
    fr, en = (F.size(F.array_intersect(seen, X.literals(words))) for words in (FRENCH, ENGLISH))
    ratio = fr / F.greatest(en, F.lit(1))
    return F.when(ratio > 2.0, "fr").when(ratio > 0.5, "mixed").otherwise("en")


def funder(path: Column, funders: list[str]) -> Column:
    """The longest abbreviation that a path holds, whatever its case; equal lengths in the order given."""
    low = F.lower(path)
    return X.first_case([(F.contains(low, F.lit(k.lower())), k) for k in sorted(funders, key=len, reverse=True)])


def doc_types(path: Column, patterns: dict[str, list[str]], fold: bool = True, otherwise: list[str] | None = None) -> Column:
    """The types of which a pattern is found in a path, in the order given; ``fold``: with blanks for underscores."""
    p = F.translate(path, "_", " ") if fold else path
    found = F.filter(F.array(*(F.when(X.any_of(p.rlike(x) for x in xs), k) for k, xs in patterns.items())), lambda t: t.isNotNull()) if patterns else F.array().cast("array<string>")
    return F.when(F.size(found) > 0, found).otherwise(X.literals(otherwise)) if otherwise else found


def metrics(t: Column, form_chrome: list[str] = (), draft_markers: list[str] = (), single_letters: bool = True, bare_digits: bool = True) -> dict[str, Column]:
    """The twelve metrics of a text's lines. An empty text is one empty line."""
    parts = X.lines(t)
    total = F.size(parts)
    one = lambda x: X.strip(x).rlike(r"^(?U)\w$")
    digits = lambda x: X.strip(x).rlike(r"^(?U)[\d\s]+$") & (F.length(X.strip(x)) <= 4)
    odd = F.lit(0)
    if single_letters:
        odd = odd + X.count_if(parts, one)
    if bare_digits:
        odd = odd + X.count_if(parts, digits)
    content = F.filter(parts, lambda x: (X.strip(x) != "") & ~one(x) & ~X.strip(x).isin("<!-- image -->", "[IMAGE]"))
    having = lambda p: X.count_if(parts, lambda x: x.rlike(p))
    found = lambda patterns: sum(map(having, patterns), F.lit(0))
    headings = F.filter(F.transform(parts, X.strip), lambda x: x.startswith("#"))
    n = F.size(content)
    return {
        "total_lines": total,
        "content_lines": n,
        "empty_lines": total - n,
        "corruption_score": odd / total,
        "image_marker_count": X.count_if(parts, lambda x: F.contains(x, F.lit("<!-- image -->"))),
        "form_chrome_count": found(form_chrome),
        "draft_marker_count": found(draft_markers),
        "has_headings": F.size(headings) > 0,
        "has_tables": F.exists(parts, lambda x: F.contains(x, F.lit("|"))),
        "avg_content_line_length": F.aggregate(content, F.lit(0), lambda s, x: s + F.length(x)) / F.greatest(n, F.lit(1)),
        "duplicate_heading_count": F.size(headings) - F.size(F.array_distinct(headings)),
        "word_count_annotation_count": X.count_if(parts, lambda x: x.rlike(r"\d+\s*words?")),
    }


def with_metrics(docs: DataFrame, config: dict = CONFIG, text: str = "content") -> DataFrame:
    """``docs`` with the metrics of the text behind its frontmatter, or of all of it if nothing is behind."""
    own = docs.withColumn("analysis_text", F.when(FM.body(F.col(text)) != "", FM.body(F.col(text))).otherwise(F.col(text)))
    off = config.get("corruption", {})
    found = metrics(F.col("analysis_text"), config.get("form_chrome", []), config.get("draft_markers", []), off.get("single_char_alpha", True), off.get("bare_digits", True))
    return own.withColumns(found).drop("analysis_text")


def classified(docs: DataFrame, config: dict = CONFIG, funders: list[str] = (), text: str = "content") -> DataFrame:
    """``docs`` (filename, filepath, text) with metrics, funder, doc_types, size_kb, status, tier and reason.

    Skip rules come first and give the status skipped_draft, whatever their reason.
    """
    d = with_metrics(docs, config, text)
    d = d.withColumns({
        "funder": funder(F.col("filepath"), list(funders)),
        "doc_types": doc_types(F.col("filepath"), config.get("doc_types", {}), otherwise=["unknown"]),
        "size_kb": F.bround(F.octet_length(text) / 1024, 1),
    })
    skip = R.first_match(config.get("skip_rules", []), "reason", None)
    skips = X.any_of(R.rule(r) for r in R.normalised(config.get("skip_rules", [])))
    names = {"full_rewrite": "full", "light_cleanup": "light"}
    rules = [r | {"tier": names.get(r.get("tier", "minimal"), r.get("tier", "minimal"))} for r in config.get("tier_rules", [])]
    rules = [r if r["tier"] in ("full", "light", "minimal", "skip") else r | {"tier": "minimal"} for r in rules]
    tier = R.first_match(rules, "tier", "minimal")
    d = d.withColumns({"skipped": skips, "skip_reason": F.coalesce(skip, F.lit("Unknown reason")), "tier": F.when(skips, "skip").otherwise(tier)})
    return d.withColumns({"status": F.when(F.col("skipped"), "skipped_draft").otherwise("ok"), "reason": F.when(F.col("skipped"), F.col("skip_reason")).otherwise(tier_reason())}).drop("skipped", "skip_reason")


def tier_reason() -> Column:
    """Why a tier was given, from the columns of counts."""
    parts = [F.when(F.col(c) > 0, F.concat(F.col(c).cast("string"), F.lit(f" {what}"))) for c, what in [("form_chrome_count", "form chrome lines"), ("draft_marker_count", "draft markers"), ("duplicate_heading_count", "duplicate headings"), ("word_count_annotation_count", "word count annotations")]]
    told = F.concat_ws("; ", *parts)
    plain = F.when(F.col("tier") == "minimal", "Clean prose, minimal issues").when(F.col("tier") == "full", "Application/report — heading normalization needed").otherwise("Default classification")
    return F.when(told != "", told).otherwise(plain)


def summary(rows: DataFrame, unknown: bool = True) -> DataFrame:
    """Counts by tier, by status and by funder, in one pass over the rows: dimension, value, files.

    Rows without a funder count as unknown, or not at all among funders, as for lists of files (inventory A4).
    """
    rows = rows.select("tier", "status", F.coalesce("funder", F.lit("unknown" if unknown else None)).alias("funder"))
    cells = rows.select(F.explode(F.array(*(F.struct(F.lit(c).alias("dimension"), F.col(c).alias("value")) for c in ("tier", "status", "funder")))).alias("c"))
    return cells.filter(F.lit(unknown) | F.col("c.value").isNotNull()).groupBy("c.dimension", "c.value").agg(F.count("*").alias("files"))
