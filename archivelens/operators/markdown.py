"""Markdown as blocks and tables, templates, names and times (inventory P44-P47, P49, S26)."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.arrow import rows_pass

BLOCKS = "array<struct<kind:string,level:int,text:string,section:string,rows:array<array<string>>>>"
#: What a sheet's title may not hold, and how long it may be.
SHEET_SIGNS, SHEET_CHARS = r"[\[\]:*?/\\]", 31
PLACEHOLDER = r"\{(\w+)\}"

_ROW = r"[^\n]*\|[^\n]*"
#: One expression finds each block where it begins: a heading, a table (a row, a rule, more rows), or a paragraph's line.
_BLOCK = re.compile(rf"(?P<head>#{{1,6}})[ \t]+(?P<title>[^\n]+)|(?P<first>{_ROW})\n[ \t]*\|?[ \t]*:?-+:?[ \t]*(?:\|[ \t]*:?-+:?[ \t]*)*\|?[ \t]*(?=\n|$)(?P<more>(?:\n{_ROW})*)|(?P<line>[^\n]+)|\n")
_RULE = re.compile(r"[\s|:-]*-[\s|:-]*")


def _cells(row: str) -> list[str]:
    return [c.strip() for c in row.strip().removeprefix("|").removesuffix("|").split("|")]


def blocks_of(markdown: str) -> list[dict]:
    """Headings, tables and paragraphs of a text, in order; a table is in the section of the last heading.

    Lines of a paragraph are joined by blanks; bold signs in headings go; rules within a table are no rows.
    """
    out: list[dict] = []
    section, held = None, []

    def close() -> None:
        if held:
            out.append({"kind": "paragraph", "level": None, "text": " ".join(held), "section": section, "rows": None})
            held.clear()

    at, text = 0, "\n".join(markdown.splitlines())
    while at < len(text):
        m = _BLOCK.match(text, at)
        at = m.end()
        line = (m["line"] or "").strip()
        if line:
            held.append(line)
        elif m["head"]:
            close()
            section = m["title"].replace("**", "").strip()
            out.append({"kind": "heading", "level": len(m["head"]), "text": section, "section": section, "rows": None})
        elif m["first"] is not None:
            close()
            rows = [m["first"], *(r for r in m["more"].split("\n") if r.strip() and not _RULE.fullmatch(r))]
            out.append({"kind": "table", "level": None, "text": None, "section": section, "rows": [_cells(r) for r in rows]})
        elif m["line"] is not None or text.startswith("\n", at):
            close()
    close()
    return out


_KIND = pa.list_(pa.struct([("kind", pa.string()), ("level", pa.int32()), ("text", pa.string()), ("section", pa.string()), ("rows", pa.list_(pa.list_(pa.string())))]))


def blocks(markdown: Column) -> Column:
    """:func:`blocks_of` of a column; null stays null."""
    return rows_pass(lambda t: None if t is None else blocks_of(t), BLOCKS, _KIND)(markdown)


def table_cells(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, section, table, row and cells of every row of every table: what a spreadsheet would hold."""
    tables = F.filter(blocks(F.col(text)), lambda b: b["kind"] == "table")
    d = docs.select(key, F.posexplode(tables).alias("table", "b"))
    return d.select(key, "b.section", "table", F.posexplode("b.rows").alias("row", "cells"))


def sheet_titles(sections: Column) -> Column:
    """Titles of sheets for an array of sections: valid, of at most SHEET_CHARS characters, each once."""

    def titled(names: list[str | None] | None) -> list[str] | None:
        if names is None:
            return None
        used: dict[str, None] = {}
        for i, name in enumerate(names):
            base = (re.sub(SHEET_SIGNS, " ", (name or "").strip()).strip() or f"Sheet{i + 1}")[:SHEET_CHARS]
            tries = (base if k == 1 else base[: SHEET_CHARS - len(f"_{k}")] + f"_{k}" for k in range(1, len(names) + 2))
            used[next(t for t in tries if t not in used)] = None
        return list(used)

    return rows_pass(titled, "array<string>", pa.list_(pa.string()))(sections)


def filled(template: Column, values: dict[str, Column]) -> Column:
    """A template with {names} replaced where there is a value; what values hold is not looked into again."""
    parts = F.regexp_extract_all(template, F.lit(PLACEHOLDER + r"|[^{]+|\{"), F.lit(0))
    known = F.create_map(*(x for k, v in values.items() for x in (F.lit("{" + k + "}"), v.cast("string")))) if values else None
    put = lambda p: p if known is None else F.coalesce(F.try_element_at(known, p), p)
    return F.array_join(F.transform(parts, put), "")


def unfilled(text: Column) -> Column:
    """The names in braces that are left, each once, in order."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(PLACEHOLDER), F.lit(1))))


def abbreviation(name: Column) -> Column:
    """The first letters of a name's words, or the first three characters of its only word."""
    words = F.filter(F.split(name, "[" + X.SPACES + "]+"), lambda w: w != "")
    letters = F.transform(F.filter(words, lambda w: F.left(w, F.lit(1)).rlike(r"\p{L}")), lambda w: F.upper(F.left(w, F.lit(1))))
    return F.when(F.size(words) == 1, F.upper(F.left(F.get(words, 0), F.lit(3)))).otherwise(F.array_join(letters, ""))


def human_time(seconds: Column) -> Column:
    """Milliseconds, seconds, minutes and seconds, or hours and minutes."""
    whole = F.floor(seconds)
    clock = lambda big, small, a, b: F.concat(F.floor(whole / big).cast("string"), F.lit(f"{a} "), F.floor(whole % big / small).cast("string"), F.lit(b))
    return F.when(seconds < 0.5, F.format_string("%.0fms", seconds * 1000)).when(seconds < 60, F.format_string("%.1fs", seconds)).when(seconds < 3600, clock(60, 1, "m", "s")).otherwise(clock(3600, 60, "h", "m"))
