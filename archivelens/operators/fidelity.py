"""How faithfully converters reproduce documents (inventory A17-A25, H15-H16, J7, J8, J14, P42, P43)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as X

#: Shares of the four scores, the score that passes, words on a page, and suffixes by format, longest first.
WEIGHTS = {"text": 0.40, "tables": 0.25, "structure": 0.25, "links_images": 0.10}
PASSES_AT, PAGE_WORDS = 0.7, 500
SUFFIXES = [(".scanned.pdf", "pdf_scanned"), (".docx", "docx"), (".xlsx", "xlsx"), (".pdf", "pdf"), (".html", "html"), (".md", "md")]


def normal(t: Column) -> Column:
    return F.lower(X.strip(F.regexp_replace(F.coalesce(t, F.lit("")), r"(?U)\s+", " ")))


def body(t: Column) -> Column:
    """A text without the block between two ``---`` lines at its very start."""
    parts = F.transform(X.lines(t), X.strip)
    close = F.array_position(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), F.lit("---"))
    rest = F.slice(X.lines(t), close.cast("int") + 2, F.greatest(F.size(parts), F.lit(1)))
    return F.when((F.get(parts, 0) == "---") & (close > 0), F.ltrim(X.unlines(rest), F.lit("\n"))).otherwise(t)


def words(t: Column) -> Column:
    return F.filter(F.split(normal(t), " "), lambda w: w != "")


def text_score(golden: Column, candidate: Column) -> Column:
    g, c = words(golden), words(candidate)
    return F.when((F.size(g) == 0) & (F.size(c) == 0), 1.0).when(F.size(c) == 0, 0.0).otherwise(S.token_ratio(g, c))


def table_rows(t: Column) -> Column:
    """The cells of each row of pipe tables: without edges, separator rows left out."""
    cells = lambda x: F.transform(F.split(x, r"\|"), X.strip)
    first = lambda r: F.when(F.get(r, 0) == "", F.slice(r, 2, F.size(r))).otherwise(r)
    last = lambda r: F.when((F.size(r) > 0) & (F.get(r, F.size(r) - 1) == ""), F.slice(r, 1, F.size(r) - 1)).otherwise(r)
    rows = F.transform(F.filter(X.lines(t), lambda x: F.contains(x, F.lit("|"))), lambda x: last(first(cells(x))))
    return F.filter(rows, lambda r: (F.size(r) > 0) & ~F.forall(r, lambda c: c.rlike("^:?-+:?$")))


def shared(a: Column, b: Column) -> Column:
    """The size of two arrays' intersection as multisets."""
    count = lambda xs, v: F.size(F.filter(xs, lambda y: y == v))
    return F.aggregate(F.array_intersect(a, b), F.lit(0), lambda s, v: s + F.least(count(a, v), count(b, v)))


def cells(rows: Column) -> Column:
    return F.transform(F.filter(F.flatten(rows), lambda c: c != ""), normal)


def with_parts(pairs: DataFrame) -> DataFrame:
    """Pairs with what scores compare, as columns of their own: scores look at each several times.

    Of golden and candidate: _g and _c (bodies), and their _rows, _cells, _refs, _heads and _items.
    """
    d = pairs.withColumns({"_g": body(F.col("golden")), "_c": body(F.col("candidate"))})
    d = d.withColumns({f"{x}_rows": table_rows(F.col(x)) for x in ("_g", "_c")} | {f"{x}_refs": references(F.col(x)) for x in ("_g", "_c")} | {f"{x}_heads": heading_rows(F.col(x)) for x in ("_g", "_c")} | {f"{x}_items": list_items(F.col(x)) for x in ("_g", "_c")})
    return d.withColumns({f"{x}_cells": cells(F.col(f"{x}_rows")) for x in ("_g", "_c")})


def without_parts(d: DataFrame) -> DataFrame:
    return d.drop("_g", "_c", *(f"{x}_{p}" for x in ("_g", "_c") for p in ("rows", "refs", "heads", "items", "cells")))


def table_score() -> Column:
    """Seven parts cells found (F1), three parts rows; without golden tables, less for each row made up."""
    gr, cr, g, c = map(F.col, ("_g_rows", "_c_rows", "_g_cells", "_c_cells"))
    f1 = F.coalesce(F.try_divide(2.0 * shared(g, c), F.size(g) + F.size(c)), F.lit(0.0))
    rows = F.try_divide(F.least(F.size(gr), F.size(cr)).cast("double"), F.greatest(F.size(gr), F.size(cr)))
    return F.when(F.size(gr) == 0, 1.0 / (1.0 + F.size(cr))).otherwise(0.7 * f1 + 0.3 * rows)


def heading_rows(t: Column) -> Column:
    """Level and words of each heading as one string, in order."""
    heads = F.filter(X.lines(t), lambda x: x.rlike(r"^#{1,6}[ \t]+.*$"))
    level = lambda x: F.length(F.regexp_extract(x, r"^(#{1,6})", 1)).cast("string")
    return F.transform(heads, lambda x: F.concat(level(x), F.lit(" "), normal(F.regexp_extract(x, r"^#{1,6}[ \t]+(.*)$", 1))))


def list_items(t: Column) -> Column:
    return X.count_if(X.lines(t), lambda x: x.rlike(r"^(?U)\s*([-*+]|\d+\.)\s+"))


def structure_score() -> Column:
    """Seven parts headings in order, three parts list items, of what the golden text has."""
    g, c, gl, cl = map(F.col, ("_g_heads", "_c_heads", "_g_items", "_c_items"))
    lists = F.try_divide(F.least(gl, cl).cast("double"), F.greatest(gl, cl))
    heads = S.token_ratio(g, c)
    return F.when((F.size(g) == 0) & (gl == 0), 1.0 / (1.0 + F.size(c) + cl)).when(F.size(g) == 0, lists).when(gl == 0, heads).otherwise(0.7 * heads + 0.3 * lists)


def references(t: Column) -> Column:
    images = F.regexp_extract_all(t, F.lit(r"!\[[^\]]*\]\([^)]*\)"), F.lit(0))
    links = F.regexp_extract_all(t, F.lit(r"(?<!!)\[[^\]]*\]\([^)]*\)"), F.lit(0))
    return F.transform(F.concat(images, links), normal)


def link_score() -> Column:
    g = F.col("_g_refs")
    return F.when(F.size(g) == 0, 1.0).otherwise(shared(g, F.col("_c_refs")).cast("double") / F.size(g))


def weighted(scores: dict[str, Column], weights: dict[str, float] = WEIGHTS) -> Column:
    total = sum(weights.values())
    return sum((scores[k] * (w / total) for k, w in weights.items()), F.lit(0.0))


def scored(pairs: DataFrame, which: tuple[str, ...] = tuple(WEIGHTS)) -> DataFrame:
    """Pairs (golden, candidate, status) with scores, and weighted if they are all there; null unless status is scored."""
    d, ok = with_parts(pairs), F.col("status") == "scored"
    score = {"text": lambda: text_score(F.col("_g"), F.col("_c")), "tables": table_score, "structure": structure_score, "links_images": link_score}
    d = without_parts(d.withColumns({k: F.when(ok, score[k]()) for k in which}))
    return d.withColumn("weighted", weighted({k: F.col(k) for k in WEIGHTS})) if set(which) == set(WEIGHTS) else d


def pages(golden: Column) -> Column:
    n = F.size(F.filter(F.split(golden, "[" + X.SPACES + "]+"), lambda w: w != ""))
    return F.greatest(F.lit(1), F.ceil(n / PAGE_WORDS)).cast("int")


def rollup(rows: DataFrame, score: str = "weighted", passes_at: float = PASSES_AT) -> DataFrame:
    """For each converter: documents by status, mean over scored ones, coverage, overall and whether it passes."""
    by = rows.groupBy("converter").agg(*(F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("scored", "failed", "unsupported")), F.coalesce(F.avg(F.when(F.col("status") == "scored", F.col(score))), F.lit(0.0)).alias("mean"))
    tried = F.col("n_scored") + F.col("n_failed") + F.col("n_unsupported")
    by = by.withColumn("coverage", F.coalesce(F.try_divide(F.col("n_scored").cast("double"), tried), F.lit(0.0)))
    by = by.withColumn("overall", F.col("mean") * F.col("coverage"))
    return by.withColumn("passed", (F.col("n_scored") > 0) & (F.col("overall") >= passes_at))


def by_kind(rows: DataFrame, converters: list[str], score: str = "weighted") -> DataFrame:
    """Mean scores by kind of document, a column for each converter; null where none was scored."""
    return rows.filter("status = 'scored'").groupBy("kind").pivot("converter", converters).agg(F.avg(score))


def best(rolled: DataFrame) -> DataFrame:
    """The converter with the highest overall score; of equal ones the first by name."""
    return rolled.groupBy().agg(F.min_by("converter", F.struct(-F.col("overall"), "converter")).alias("converter"))


def slug_parts(slug: Column) -> Column:
    """A struct of funder, kind and number of ``funder-kind-number``; null if that isn't its form."""
    p = r"^([^-]+)-(.+)-(\d+)$"
    part = lambda k: F.regexp_extract(slug, p, k)
    return F.when(slug.rlike(p), F.struct(part(1).alias("funder"), part(2).alias("kind"), part(3).try_cast("int").alias("number")))


def cases(golden: DataFrame, rendered: DataFrame) -> DataFrame:
    """Rendered files (name) with their golden text (slug, content): slug, fmt, name, golden; others are left out."""
    ends = X.first_case([(F.col("name").endswith(s), s) for s, _ in SUFFIXES])
    fmt = X.first_case([(F.col("name").endswith(s), f) for s, f in SUFFIXES])
    d = rendered.withColumns({"end": ends, "fmt": fmt}).filter("end is not null").withColumn("slug", F.expr("left(name, length(name) - length(end))"))
    return d.filter(slug_parts(F.col("slug")).isNotNull()).join(golden.select("slug", F.col("content").alias("golden")), "slug").select("slug", "fmt", "name", "golden")


def scorecard(rolled: DataFrame, kinds: DataFrame) -> str:
    """A Markdown report of a roll-up and its break-down; both are as small as the converters are few."""
    out = ["| Converter | Overall | Mean | Coverage | Scored | Failed | Unsupported | Passed |", "|---|---|---|---|---|---|---|---|"]
    for r in rolled.orderBy(F.desc("overall"), "converter").collect():
        out.append(f"| {r['converter']} | {r['overall']:.3f} | {r['mean']:.3f} | {r['coverage']:.0%} | {r['n_scored']} | {r['n_failed']} | {r['n_unsupported']} | {'yes' if r['passed'] else 'no'} |")
    names = [c for c in kinds.columns if c != "kind"]
    out += ["", "| Kind | " + " | ".join(names) + " |", "|---" * (len(names) + 1) + "|"]
    for r in kinds.orderBy("kind").collect():
        out.append(f"| {r['kind']} | " + " | ".join("n/a" if r[c] is None else f"{r[c]:.3f}" for c in names) + " |")
    return "\n".join(out) + "\n"


def runs(found: DataFrame, converters: list[dict]) -> DataFrame:
    """Each case (slug, fmt, name, golden) with each converter that is switched on, and pages and cost.

    ``converters``: a benchmark's settings (name, extensions, enabled, cost_per_page), a handful, which become literals of the plan.
    ``supported`` says whether the converter takes the file's suffix.
    """
    suffix = F.lower(F.regexp_extract("name", r"(\.[^.]*)$", 1))
    tried = [F.struct(F.lit(c["name"]).alias("converter"), suffix.isin(list(c.get("extensions", []))).alias("supported"), F.lit(float(c.get("cost_per_page", 0.0))).alias("price")) for c in converters if c.get("enabled", True)]
    d = found.withColumn("_pages", pages(F.col("golden"))).select("*", F.explode(F.array(*tried)).alias("_c"))
    return d.select("slug", "fmt", "name", "golden", "_c.converter", "_c.supported", F.col("_pages").alias("pages"), (F.col("_pages") * F.col("_c.price")).alias("cost_usd"))
