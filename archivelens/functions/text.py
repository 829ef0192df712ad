"""Text as columns: whole strings, and arrays of lines.

Lines are ``split(text, '\\n')``; operators that look at neighbours index the array, so no line leaves
its row and nothing is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that count as white space in text.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space of any alphabet at both ends; ``trim`` alone takes blanks only."""
    return F.trim(c, F.lit(SPACES))


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def unlines(parts: Column) -> Column:
    return F.array_join(parts, "\n")


def blank(line: Column) -> Column:
    return strip(line) == ""


def before(parts: Column, i: Column) -> Column:
    """The line in front of line ``i`` (from 0), empty at the start."""
    return F.when(i > 0, F.get(parts, i - 1)).otherwise("")


def after(parts: Column, i: Column) -> Column:
    """The line behind line ``i``, empty at the end."""
    return F.coalesce(F.get(parts, i + 1), F.lit(""))


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def count_if(parts: Column, test) -> Column:
    return F.size(F.filter(parts, test))


def first_line_with(parts: Column, needle: Column) -> Column:
    """The number, from 1, of the first line that holds ``needle``; null if none does."""
    hit = F.filter(F.transform(parts, lambda x, i: F.when(F.contains(x, needle), i + 1)), lambda i: i.isNotNull())
    return F.get(hit, 0)


def first_case(cases: list[tuple[Column, Column | str | None]], otherwise=None) -> Column:
    """The value of the first condition that holds."""
    if not cases:
        return F.lit(otherwise) if not isinstance(otherwise, Column) else otherwise
    out = None
    for test, value in cases:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(otherwise)


def literals(values) -> Column:
    return F.array(*(F.lit(v) for v in values)) if values else F.array().cast("array<string>")
