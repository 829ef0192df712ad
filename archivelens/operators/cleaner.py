"""Deterministic Markdown clean-up: an ordered list of string -> string passes (inventory C1-C17).

Each pass is a Column function of Spark's own functions, so a whole clean-up stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

#: Headings that belong to a form and not to its text.
FORM_HEADINGS = [
    r"^#{1,6}\s+Writing\s+tip",
    r"^#{1,6}\s+Upload\s+.*?(?:PDF|file)",
    r"^#{1,6}\s+\(mandatory",
    r"^#{1,6}\s+FOR OFFICE USE ONLY",
    r"^#{1,6}\s+Protected\s+\w+\s+when\s+completed",
    r"^#{1,6}\s+Please\s+(?:note|select|choose|enter|complete)",
    r"^#{1,6}\s+To\s+(?:enter|edit|complete|submit)\s+.*",
    r"^#{1,6}\s+Application\s+(?:Preview|ID|Number)",
    r"^#{1,6}\s+Voluntary\s+Self.Identification",
]
#: Fixed value: the label of a form field, alone on its line.
FIELD_LABEL = r"^(?:(?:Applicant\s+)?Organization\s*(?:or\s+Collective\s+Name)?|Address|Postal\s+Code|Telephone\s+Primary|Website|CADAC\s+ID|Incorporation\s+Status|Charitable\s+Tax\s+Status|Application\s+Contact|Email|File\s+Number|Portal\s+Account\s+ID|Date)\s*:\s*$"
#: Fixed value: what a form field's value looks like.
FIELD_VALUE = r"^(?:\d[\d\s-]*\d|[\w.-]+@[\w.-]+|https?://[\w./-]+|M\d[A-Z]\s*\d[A-Z]\d|Incorporated\s+since\s+\d{4}|Yes\s+\d[\d-]+[A-Z]{2}\d+)\s*$"
#: Words that stay small in a heading.
SMALL_WORDS = ["Of", "And", "The", "For", "To", "In", "At", "On", "With", "A", "An"]


def embedded_images(t: Column) -> Column:
    return F.regexp_replace(t, r"!\[Image\]\(data:image/\w+;base64,[A-Za-z0-9+/=]+\)", "[IMAGE]")


def image_marks(t: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(t, r"(?i)<!--\s*image\s*-->", ""), r"(?dm)^\[IMAGE\]\s*$", "")


def white_space(t: Column) -> Column:
    t = F.translate(t, "\u00a0\t\u200b\u200c\u200d\ufeff", "  ")
    t = F.regexp_replace(t, " {2,}", " ")
    t = F.regexp_replace(F.regexp_replace(t, "\r\n", "\n"), "\r", "\n")
    return F.regexp_replace(t, "\n{3,}", "\n\n")


def without_headings(patterns: list[str]) -> Callable[[Column], Column]:
    """Drops heading lines that begin as one of ``patterns``, whatever their case."""

    def run(t: Column) -> Column:
        if not patterns:
            return t

        def goes(line: Column) -> Column:
            s = X.strip(line)
            return s.startswith("#") & X.any_of(s.rlike("(?i)^(?:" + p + ")") for p in patterns)

        return X.unlines(F.filter(X.lines(t), lambda x: ~goes(x)))

    return run


def form_fields(t: Column) -> Column:
    """Labels go, with a value right below; of further values that follow one another the first stays."""
    label = lambda x: X.strip(x).rlike("(?iU)" + FIELD_LABEL)
    value = lambda x: X.strip(x).rlike("(?iU)" + FIELD_VALUE)
    # each step's lines are bound as a lambda's variable, so that a line can look at the one before
    bound = lambda xs, test: F.get(F.transform(F.array(xs), lambda ls: F.filter(ls, lambda x, i: test(ls, x, i))), 0)
    bare = bound(X.lines(t), lambda ls, x, i: ~label(x) & ~(value(x) & label(X.before(ls, i))))
    return F.when(t.isNotNull(), X.unlines(bound(bare, lambda ls, x, i: ~(value(x) & value(X.before(ls, i))))))


def _entities(t: Column, pattern: str, base: int) -> Column:
    """``t`` with numeric entities of one base as characters; what is no character stays as it is."""
    parts = F.regexp_extract_all(t, F.lit(pattern + r"|[^&]+|&"), F.lit(0))

    def char(p: Column) -> Column:
        digits = F.regexp_extract(p, pattern, 1)
        n = F.when(F.length(digits) <= 8, F.conv(digits, base, 10).cast("bigint"))
        known = (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
        c = F.when(n == 0xFEFF, "\ufeff").otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))
        return F.when(p.rlike("^" + pattern + "$") & F.coalesce(known, F.lit(False)), c).otherwise(p)

    return F.array_join(F.transform(parts, char), "")


def numeric_entities(t: Column) -> Column:
    """Numeric entities only, hexadecimal ones first."""
    some = _entities(_entities(t, "&#x([0-9a-fA-F]+);", 16), "&#([0-9]+);", 10)
    return F.when(F.contains(t, F.lit("&#")), some).otherwise(t)


def _titled(title: Column) -> Column:
    """Each run of letters begins with a capital, and small words stay small."""
    runs = F.transform(F.regexp_extract_all(title, F.lit(r"\p{LC}+|\P{LC}+"), F.lit(0)), lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.lower(w.substr(F.lit(2), F.length(w)))))
    words = F.regexp_extract_all(F.array_join(runs, ""), F.lit(r"(?U)\w+|\W+"), F.lit(0))
    return F.array_join(F.transform(words, lambda w: F.when(F.lower(w).isin([x.lower() for x in SMALL_WORDS]), F.lower(w)).otherwise(w)), "")


def capital_headings(t: Column) -> Column:
    """Headings of more than 70 % capitals in title case, with small words small; the space behind the signs is one blank."""
    pattern = r"(?U)^(#{1,6})\s+(.+)$"

    def line(x: Column) -> Column:
        title = F.regexp_extract(X.strip(x), pattern, 2)
        letters, capitals = F.regexp_count(title, F.lit(r"\p{L}")), F.regexp_count(title, F.lit(r"\p{Lu}"))
        return F.when(X.strip(x).rlike(pattern), F.concat(F.regexp_extract(X.strip(x), pattern, 1), F.lit(" "), F.when(capitals > 0.7 * letters, _titled(title)).otherwise(title))).otherwise(x)

    return F.when(t.isNotNull(), X.unlines(F.transform(X.lines(t), line)))


def split_words(t: Column) -> Column:
    """Joins neighbours of one to three letters, up to five times over."""
    for _ in range(5):
        t = F.regexp_replace(t, r"(?U)\b([a-zA-Z]{1,3}) ([a-zA-Z]{1,3})\b", "$1$2")
    return t


def _lone(t: Column, pattern: str, both: bool) -> Column:
    parts = X.lines(t)

    def goes(line: Column, i: Column) -> Column:
        up, down = X.blank(X.before(parts, i)), X.blank(X.after(parts, i))
        return X.strip(line).rlike(pattern) & ((up & down) if both else (up | down))

    return X.unlines(F.filter(parts, lambda x, i: ~goes(x, i)))


def lone_letters(t: Column) -> Column:
    return _lone(t, "^[a-zA-Z]$", both=True)


def lone_digits(t: Column) -> Column:
    return _lone(t, r"^(?U)\d{1,4}$", both=False)


def bold_headings(t: Column) -> Column:
    """A bold line between blank ones becomes a heading, if its title is shorter than 100 characters."""
    parts = X.lines(t)

    def line(x: Column, i: Column) -> Column:
        title = X.strip(F.regexp_extract(X.strip(x), r"^\*\*([^*]+)\*\*$", 1))
        apart = X.blank(X.before(parts, i)) & X.blank(X.after(parts, i))
        return F.when(X.strip(x).rlike(r"^\*\*[^*]+\*\*$") & apart & (F.length(title) < 100), F.concat(F.lit("### "), title)).otherwise(x)

    return X.unlines(F.transform(parts, line))


def writing_tips(t: Column) -> Column:
    return F.regexp_replace(t, r"(?idm)^(Writing\s+tip\s*:?\s*)(.*)$", "*$1$2*")


def questions(t: Column) -> Column:
    """``question? answer`` becomes a heading and a paragraph, if the answer is the longer part."""

    def line(x: Column) -> Column:
        s = X.strip(x)
        at = F.instr(s, "?")
        answer = X.strip(s.substr(at + 1, F.length(s)))
        head = F.rtrim(X.strip(s.substr(F.lit(1), at)), F.lit("?"))
        splits = ~s.startswith("#") & (at > 1) & (at - 1 < F.length(s) * 0.6) & (F.length(answer) > 20)
        return F.when(splits, F.array(F.concat(F.lit("### "), head), F.lit(""), answer)).otherwise(F.array(x))

    return X.unlines(F.flatten(F.transform(X.lines(t), line)))


def heading_notes(t: Column) -> Column:
    """A note in brackets at the end of a heading goes below it."""
    pattern = r"^(#{1,6}\s+)(.+?)\s*\((.+?)\)\s*$"

    def line(x: Column) -> Column:
        s = X.strip(x)
        part = lambda k: F.regexp_extract(s, pattern, k)
        split = F.array(F.concat(part(1), X.strip(part(2))), F.lit(""), F.concat(F.lit("*"), X.strip(part(3)), F.lit("*")))
        return F.when(s.rlike(pattern), split).otherwise(F.array(x))

    return X.unlines(F.flatten(F.transform(X.lines(t), line)))


def form_widgets(t: Column) -> Column:
    for pattern in (r"(?dm)^\[[ xX]\]\s*", r"(?dm)^[☐☑]\s*", r"(?idm)^Total\s+Files?\s*:\s*\d+\s*$"):
        t = F.regexp_replace(t, pattern, "")
    return t


def ends(t: Column) -> Column:
    return F.concat(X.strip(t), F.lit("\n"))


def passes(form_headings: list[str] | None = None, useless_headings: list[str] | None = None, fixes: bool | dict = True) -> list[tuple[str, Callable[[Column], Column]]]:
    """The passes in order. ``fixes``: split_words, single_char_lines and html_entities, together or each on its own."""
    on = (lambda k: fixes) if isinstance(fixes, bool) else (lambda k: fixes.get(k, True))
    return [
        ("embedded_images", embedded_images),
        ("image_marks", image_marks),
        ("white_space", white_space),
        ("form_headings", without_headings(FORM_HEADINGS if form_headings is None else form_headings)),
        ("useless_headings", without_headings(useless_headings or [])),
        ("form_fields", form_fields),
        *([("numeric_entities", numeric_entities)] if on("html_entities") else []),
        *([("split_words", split_words)] if on("split_words") else []),
        *([("lone_letters", lone_letters)] if on("single_char_lines") else []),
        ("lone_digits", lone_digits),
        ("bold_headings", bold_headings),
        ("capital_headings", capital_headings),
        ("writing_tips", writing_tips),
        ("questions", questions),
        ("heading_notes", heading_notes),
        ("form_widgets", form_widgets),
        ("ends", ends),
    ]


def clean(docs: DataFrame, column: str = "content", **options) -> DataFrame:
    """``docs`` with ``column`` cleaned. Each pass reads the one before, so expressions aren't repeated."""
    for _, run in passes(**options):
        docs = docs.withColumn(column, run(F.col(column)))
    return docs


def size_change(docs: DataFrame, column: str = "content", **options) -> DataFrame:
    """Characters before and after, and their difference, over all documents (inventory H27)."""
    both = docs.select(F.col(column).alias("was"), F.col(column).alias("content"))
    return clean(both, "content", **options).agg(F.count("*").alias("files"), F.sum(F.length("was")).alias("chars_before"), F.sum(F.length("content")).alias("chars_after"))
