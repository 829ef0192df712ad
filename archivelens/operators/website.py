"""Scraped pages as archive documents (inventory P31-P33, H11, H13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import frontmatter as FM
from ..functions import text as X

#: Fixed value: the comment that a scraper leaves on the first line that isn't blank.
HEADER = r"^<!--\s*source:\s*(\S+)\s*\|\s*scraped:\s*([^\s|]+)\s*\|\s*hash:\s*(\S+)\s*-->"


def header(content: Column) -> Column:
    """A struct of url, scraped_at and hash; null without a header."""
    first = F.get(F.filter(F.transform(X.lines(content), X.strip), lambda x: x != ""), 0)
    part = lambda k: F.regexp_extract(first, HEADER, k)
    return F.when(first.rlike(HEADER), F.struct(part(1).alias("url"), part(2).alias("scraped_at"), part(3).alias("hash")))


def sanitised(slug: Column) -> Column:
    s = F.trim(F.regexp_replace(slug, "[^a-zA-Z0-9]+", "_"), F.lit("_"))
    return F.when(s == "", "webpage").otherwise(s)


def slug(url: Column) -> Column:
    """The last part of a URL's path, or its host, without extension."""
    path = F.rtrim(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), F.lit("/"))
    host = F.translate(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), ".", "_")
    last = F.when(path == "", F.when(host == "", "webpage").otherwise(host)).otherwise(F.element_at(F.split(path, "/"), -1))
    return sanitised(F.regexp_replace(last, r"\.[^.]*$", ""))


def filename(org: str, scraped_at: Column, name: Column) -> Column:
    return F.concat(F.lit(f"{org}__"), scraped_at.substr(1, 10), F.lit("__"), name, F.lit("__webpage.md"))


def staged(pages: DataFrame, org: str, content: str = "content") -> DataFrame:
    """``pages`` with status (staged, or error and why), source_url, scraped_at, url_slug, filename, written and text.

    The header is looked for behind a page's frontmatter. The text is stripped of blocks by toggling,
    so a page with a lone rule or fence loses what follows it; ``cut`` tells.
    """
    d = pages.withColumn("_body", FM.body(F.col(content))).withColumn("_h", header(F.col("_body")))
    year = F.regexp_extract(F.col("_h.scraped_at"), r"^(\d{4})", 1).try_cast("int")
    error = F.when(F.col("_h").isNull(), "No scraper comment found").when(year.isNull(), F.concat(F.lit("Cannot extract year from: "), F.col("_h.scraped_at")))
    name = slug(F.col("_h.url"))
    d = d.withColumns({"error": error, "source_url": F.col("_h.url"), "scraped_at": F.col("_h.scraped_at"), "content_hash": F.col("_h.hash"), "written": year, "url_slug": F.when(error.isNull(), name)})
    d = d.withColumns({"status": F.when(F.col("error").isNull(), "staged").otherwise("error"), "filename": F.when(F.col("error").isNull(), filename(org, F.col("scraped_at"), F.col("url_slug")))})
    front = FM.written({"funder": FM.quoted(F.lit(org)), "type": FM.quoted(F.lit("webpage")), "written": F.col("written"), "source_url": FM.quoted(F.col("source_url")), "scraped_at": FM.quoted(F.col("scraped_at")), "content_hash": FM.quoted(F.col("content_hash"))})
    marks = X.count_if(X.lines(F.col("_body")), lambda x: X.strip(x).isin("---", "...") | X.strip(x).startswith("```"))
    d = d.withColumns({"text": F.when(F.col("error").isNull(), FM.apply(F.col("_body"), front)), "cut": marks % 2 == 1})
    return d.drop("_body", "_h", content)


def listed(pages: DataFrame, path: str, content: str = "content", name: str | None = None) -> DataFrame:
    """What staging would do with files: source_file, source_url, scraped_at, url_slug, would_stage and error.

    Unlike :func:`staged`, the header is looked for in the raw text, in front of any frontmatter.
    """
    d = pages.withColumn("_h", header(F.col(content)))
    found = F.col("_h").isNotNull()
    called = sanitised(F.lit(name)) if name else slug(F.col("_h.url"))
    return d.select(F.col(path).alias("source_file"), F.col("_h.url").alias("source_url"), F.col("_h.scraped_at").alias("scraped_at"), F.when(found, called).alias("url_slug"), found.alias("would_stage"), F.when(~found, "No scraper comment found").alias("error"))
