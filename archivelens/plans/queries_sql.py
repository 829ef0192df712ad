"""Pieces of DuckDB SQL that oracles share."""

from __future__ import annotations

from ..sources.fixtures import md_cte

NL = "chr(10)"
_WS = "' ' || chr(9) || chr(10) || chr(13)"


def strip(x: str) -> str:
    return f"trim({x}, {_WS})"


def quote(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def array(values) -> str:
    return "[" + ", ".join(map(quote, values)) + "]"


def lines(x: str = "content") -> str:
    return f"string_split({x}, {NL})"


def keep(xs: str, test: str) -> str:
    return f"list_filter({xs}, lambda x, i: {test})"


def count(xs: str, test: str) -> str:
    return f"len({keep(xs, test)})"


def join(xs: str) -> str:
    return f"coalesce(array_to_string({xs}, {NL}), '')"


#: Documents with e (where the block closes), block and body.
FRONT = f"""f AS (SELECT *, CASE WHEN starts_with(content, '---') AND instr(substr(content, 4), '---') > 0 THEN instr(substr(content, 4), '---') + 3 ELSE 0 END AS e FROM md),
fm AS (SELECT *, CASE WHEN e > 0 THEN {strip("substr(content, 4, e - 4)")} END AS block, CASE WHEN e > 0 THEN {strip("substr(content, e + 3)")} ELSE content END AS body FROM f)"""


def with_front(body: str, more: str = "") -> str:
    return md_cte(f", {FRONT}{', ' + more if more else ''}\n{body}".lstrip()).replace(")\n, f AS", "),\nf AS")


def field(name: str, block: str = "block") -> str:
    value = strip(f"regexp_extract({block}, '(?m)^{name}:[ \\t]*(.*)$', 1)")
    return f"nullif({value}, '')"


def year(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '-?[0-9]+') THEN TRY_CAST({x} AS INT) ELSE TRY_CAST(nullif(regexp_extract({x}, '\\b(20\\d{{2}})\\b', 1), '') AS INT) END"


def metrics(t: str, chrome: list[str], drafts: list[str]) -> dict[str, str]:
    """The twelve metrics of a text ``t``."""
    ls, s = lines(t), strip("x")
    single = f"regexp_full_match({s}, '[\\p{{L}}\\p{{N}}_]')"
    digits = f"(regexp_full_match({s}, '[\\p{{Nd}}\\s]+') AND length({s}) <= 4)"
    content = keep(ls, f"{s} <> '' AND NOT {single} AND {s} NOT IN ('<!-- image -->', '[IMAGE]')")
    heads = f"list_filter(list_transform({ls}, lambda x: {s}), lambda x: starts_with(x, '#'))"
    found = lambda ps: " + ".join(count(ls, f"regexp_matches(x, {quote(p)})") for p in ps) or "0"
    n = f"len({content})"
    return {
        "total_lines": f"len({ls})",
        "content_lines": n,
        "empty_lines": f"len({ls}) - {n}",
        "corruption_score": f"({count(ls, single)} + {count(ls, digits)})::DOUBLE / len({ls})",
        "image_marker_count": count(ls, "contains(x, '<!-- image -->')"),
        "form_chrome_count": found(chrome),
        "draft_marker_count": found(drafts),
        "has_headings": f"len({heads}) > 0",
        "has_tables": f"{count(ls, chr(99) + 'ontains(x, ' + quote('|') + ')')} > 0",
        "avg_content_line_length": f"coalesce(list_sum(list_transform({content}, lambda x: length(x))), 0)::DOUBLE / greatest({n}, 1)",
        "duplicate_heading_count": f"len({heads}) - len(list_distinct({heads}))",
        "word_count_annotation_count": count(ls, "regexp_matches(x, '\\d+\\s*words?')"),
    }


def select(columns: dict[str, str]) -> str:
    return ", ".join(f"{v} AS {k}" for k, v in columns.items())
