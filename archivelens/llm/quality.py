"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Each rule looks at a few measures of a text and votes good (+1), bad (-1) or abstains (0).  How often
each rule is right isn't known; it is estimated from how the rules agree over all documents
(Dawid and Skene's model with two classes).  The posterior probability of "good" then decides,
instead of asking that every rule passes: a rule that often votes bad where no other does is learnt
to be noisy and outvoted, and several weak votes together can reject.  That needs rules that look at
one fault from different sides, as agreement is all there is to learn from.  The corpus is reduced to
counts of vote patterns, of which there are at most 3 to the power of the number of rules, whatever its
size; only they reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import texts as T
from .storage import keep

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letter_words", "n_letters", "n_marks")
_TYPE = "struct<" + ",".join(f"{m}:bigint" for m in MEASURES) + ">"

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Marks that end or part sentences.
MARKS = ".,;:!?"

#: Bytes that count as letters: those of ASCII, and the first of each longer character but the Latin signs (0xC2) and general punctuation (0xE2).
_LETTER = np.zeros(256, bool)
_LETTER[[c for c in range(256) if (c < 128 and chr(c).isalpha()) or (c >= 0xC3 and c != 0xE2)]] = True

MIN_WORDS = 50


def _per_text(flags: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return T.sums(flags, starts)


def _repeated(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text: words, words in three-word windows that it has twice or more, words with a letter."""
    flat, starts = T.words(texts)
    n = np.diff(starts)
    letter = np.asarray(pc.match_substring_regex(flat.dictionary, r"\p{L}"), bool)
    which = flat.indices.to_numpy().astype(np.int64)
    lettered = T.sums(letter[which], starts) if len(which) else np.zeros(len(texts), np.int64)
    if len(which) < 3:
        return n, np.zeros(len(texts), np.int64), lettered
    owner = np.repeat(np.arange(len(texts)), n)
    first = np.flatnonzero(owner[:-2] == owner[2:])
    pair = which[first] * len(flat.dictionary) + which[first + 1]
    kinds = len(flat.dictionary)
    if kinds < 1 << 21:  # three numbers of under 21 bits are one of under 63
        window = pair * kinds + which[first + 2]
    else:
        window = np.unique(pair, return_inverse=True)[1] * kinds + which[first + 2]
    known, inverse = np.unique(window, return_inverse=True)
    _, inverse, count = np.unique(owner[first] * max(len(known), 1) + inverse, return_inverse=True, return_counts=True)
    hit = first[count[inverse] > 1]
    covered = np.zeros(len(which), bool)
    for k in range(3):
        covered[hit + k] = True
    return n, T.sums(covered, starts), lettered


def _dup_lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each text: lines that have a word and equal an earlier line, and lines that have a word."""
    parts = pc.split_pattern(texts, "\n")
    flat = parts.flatten().dictionary_encode()
    starts = parts.offsets.to_numpy().astype(np.int64) - parts.offsets[0].as_py()
    which = flat.indices.to_numpy().astype(np.int64)
    full = np.asarray(pc.binary_length(pc.ascii_trim_whitespace(flat.dictionary)), np.int64)[which] > 0
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    distinct = np.unique(owner[full] * len(flat.dictionary) + which[full]) // max(len(flat.dictionary), 1)
    lines = T.sums(full, starts)
    return lines - np.bincount(distinct, minlength=len(texts))[: len(texts)], lines


def measure(texts: pa.Array) -> pa.StructArray:
    """:data:`MEASURES` of each text of a slice."""
    data, starts = T.utf8(texts)
    symbol, mark = np.zeros(256, bool), np.zeros(256, bool)
    symbol[list(SYMBOLS.encode())] = True
    mark[list(MARKS.encode())] = True
    n, repeated, lettered = _repeated(texts)
    dup, lines = _dup_lines(texts)
    chars = T.sums(~T.SPACE[data] & ((data & 0xC0) != 0x80), starts)
    columns = (n, chars, T.sums(symbol[data], starts), dup, repeated, lines, lettered, T.sums(_LETTER[data], starts), T.sums(mark[data], starts))
    return pa.StructArray.from_arrays([pa.array(np.asarray(x, np.int64)) for x in columns], list(MEASURES))


def _measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    empty = pa.StructArray.from_arrays([pa.array([], pa.int64())] * len(MEASURES), list(MEASURES))
    for batch in batches:
        found = [measure(part) for part in T.slices(batch)]
        yield pa.concat_arrays(found) if found else empty


def measures(text: Column) -> Column:
    """A struct of :data:`MEASURES`; a null text counts as empty."""
    return F.arrow_udf(_measured, _TYPE)(text)


@dataclass(frozen=True)
class Rule:
    """A measure divided by another (or itself) that votes good inside ``good``, bad outside ``fair``, else abstains."""

    name: str
    over: str
    under: str | None
    good: tuple[float, float]
    fair: tuple[float, float]

    def vote(self, m: Column) -> Column:
        value = m[self.over].cast("double")
        if self.under:
            value = F.when(m[self.under] > 0, value / m[self.under])
        return F.when(value.between(*self.good), 1).when(~value.between(*self.fair), -1).otherwise(0)


_TOP = float("inf")
#: Some look at one fault from different sides (signs in place of letters, repetition), some are often wrong by themselves.
RULES = (
    Rule("length", "n_words", None, (100, _TOP), (60, _TOP)),
    Rule("word_length", "word_chars", "n_words", (3, 10), (2.5, 14)),
    Rule("symbols", "n_symbols", "n_words", (0, 0.02), (0, 0.1)),
    Rule("letter_share", "n_letters", "word_chars", (0.92, 1), (0.9, 1)),
    Rule("lettered_words", "n_letter_words", "n_words", (0.9, 1), (0.7, 1)),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", (0, 0.1), (0, 0.3)),
    Rule("repeated_words", "n_repeat_words", "n_words", (0, 0.1), (0, 0.25)),
    Rule("punctuation", "n_marks", "n_words", (0.05, 0.25), (0.02, 0.5)),
)


def pattern(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The votes of all rules as one number, base 3."""
    code = F.lit(0)
    for r in rules:
        code = code * 3 + (r.vote(m) + 1)
    return code


@dataclass(frozen=True)
class Model:
    """``posterior``: of "good", by pattern. ``accuracy``: how often each rule is right where it votes."""

    posterior: list[float]
    accuracy: dict[str, float]
    prior: float


#: A weak belief that only settles which class is which and keeps rates off 0 and 1: the share of good documents,
#: the share of bad votes among a rule's votes on good and on bad documents, and its weight, as a part of all documents.
BELIEF_PRIOR, BELIEF_GOOD, BELIEF_BAD, BELIEF_WEIGHT = 0.9, 0.02, 0.5, 0.002
#: Where expectation-maximisation starts: the posterior of "good" with no, one, or more bad votes.
START = (0.99, 0.5, 0.02)


def fit(counts: dict[int, int], rules: tuple[Rule, ...] = RULES, steps: int = 200) -> Model:
    """Expectation-maximisation over counts of vote patterns.

    Each rule has a rate of voting bad in either class, both estimated freely but for a weak belief, so a
    rule that is seldom wrong when it votes bad outweighs many that only look at other faults, and
    one that is often wrong weighs little; abstaining says nothing.  It starts from "two bad votes are
    right" and takes ``steps`` steps at most, until no posterior moves, in ascending order of patterns, so
    equal counts give equal results, and counts in proportion equal ones too.  Without documents the
    posteriors are those of the start.
    """
    k = len(rules)
    codes = np.arange(3**k)
    votes = np.stack([codes // 3 ** (k - 1 - j) % 3 - 1 for j in range(k)], 1)
    seen = np.array([counts.get(int(c), 0) for c in codes], float)
    seen /= max(seen.sum(), 1)
    no, yes = votes == -1, votes == 1
    post = np.array(START)[np.minimum(no.sum(1), 2)]
    prior, right = BELIEF_PRIOR, np.full(k, 0.5)
    for _ in range(steps if seen.any() else 0):
        good, bad = seen * post, seen * (1 - post)
        prior = float((good.sum() + BELIEF_WEIGHT * BELIEF_PRIOR) / (1 + BELIEF_WEIGHT))
        alarm_good = (good @ no + BELIEF_WEIGHT * BELIEF_GOOD) / (good @ (no | yes) + BELIEF_WEIGHT)
        alarm_bad = (bad @ no + BELIEF_WEIGHT * BELIEF_BAD) / (bad @ (no | yes) + BELIEF_WEIGHT)
        odds = np.log(prior / (1 - prior)) + no @ np.log(alarm_good / alarm_bad) + yes @ np.log((1 - alarm_good) / (1 - alarm_bad))
        before, post = post, 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
        right = (good @ yes + bad @ no + BELIEF_WEIGHT) / (seen @ (no | yes) + BELIEF_WEIGHT)
        if np.abs(post - before).max() < 1e-10:
            break
    return Model([float(x) for x in np.round(post, 9)], {r.name: float(a) for r, a in zip(rules, right, strict=True)}, prior)


def fit_counts(patterns: DataFrame, rules: tuple[Rule, ...] = RULES) -> Model:
    """Fit to the column ``pattern``; at most 3 ** len(rules) rows reach the driver."""
    return fit({r["pattern"]: r["count"] for r in patterns.groupBy("pattern").count().collect()}, rules)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def posterior(m: Column, model: Model, rules: tuple[Rule, ...] = RULES) -> Column:
    return F.element_at(F.lit(model.posterior), pattern(m, rules) + 1)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept and posterior.

    Whole texts of any length are measured, once; the small table of measures is kept in the shared
    folder, since the fit needs all of it before the first decision.  A null text counts as empty and
    fails; equal texts get equal rows, repeated rows and null ids as many as they are; other columns of
    ``docs`` are ignored; an empty table gives an empty result.
    """
    found = keep(docs.select(docs[id_col].alias("doc_id"), measures(docs[text_col]).alias("m")), "quality")
    m = found["m"]
    model = fit_counts(found.select(pattern(m).alias("pattern")))
    return found.select("doc_id", *(m[x].alias(x) for x in MEASURES[:5]), base_failed(m).alias("base_failed"), posterior(m, model).alias("posterior")).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))


def quality_filter(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that :func:`quality` keeps, with their columns, whatever their names.

    Texts are measured once and never shuffled: they are kept next to their vote patterns until the fit is
    known.  Null and empty texts go; repeated rows share their decision and stay as often as they
    are; an empty table gives an empty result.
    """
    own = free_name(docs)
    m = F.col("m")
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias(own), measures(docs[text_col]).alias("m"))
    found = keep(rows.select(own, base_failed(m).alias("failed"), pattern(m).alias("pattern")), "quality")
    model = fit_counts(found.select("pattern"))
    good = found.filter(~F.col("failed") & (F.element_at(F.lit(model.posterior), F.col("pattern") + 1) >= 0.5))
    return good.select(*(F.col(own)[c].alias(c) for c in docs.columns))


def free_name(docs: DataFrame, stem: str = "_al") -> str:
    """A column name that ``docs`` doesn't have."""
    taken = {c.lower() for c in docs.columns}
    while stem in taken:
        stem += "_"
    return stem
