"""Matching-block similarity of texts, as Arrow functions of two columns.

The ratio isn't symmetric, so the order of its arguments is part of a query.
"""

from __future__ import annotations

import heapq
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrow import rows_pass

#: Letters that are counted singly, the rarest as one.
MANY_LETTERS = 64


def block_ratio(x: str, y: str, least: float = 0.0) -> float | None:
    """The ratio of two texts without popular characters left out, as the standard library gives it, but faster; None as soon as it can't be ``least``.

    The longest block of a rectangle is found row by row: an array holds, for each place in ``y``, how long the run
    that ends there is. Of equally long ones the first in ``x`` counts, then the first in ``y``.  Rectangles that may hold
    most come first: blocks found and the letters that all others have in common bound the ratio from above.
    """
    a, b = (np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in (x, y))
    if not len(a) or not len(b):
        found = 0.0 if len(a) + len(b) else 1.0
        return found if found >= least else None
    both, codes = np.unique(np.concatenate([a, b]), return_inverse=True)
    if len(both) > MANY_LETTERS:  # the rarest count as one
        codes = np.minimum(np.argsort(np.argsort(-np.bincount(codes), kind="stable"), kind="stable")[codes], MANY_LETTERS - 1)
    letters = [np.zeros((len(t) + 1, min(len(both), MANY_LETTERS)), np.int32) for t in (a, b)]
    for seen, own in zip(letters, (codes[: len(a)], codes[len(a) :]), strict=True):
        seen[np.arange(1, len(own) + 1), own] = 1
        np.cumsum(seen, axis=0, out=seen)

    def common(a0: int, a1: int, b0: int, b1: int) -> int:
        return int(np.minimum(letters[0][a1] - letters[0][a0], letters[1][b1] - letters[1][b0]).sum())

    whole = common(0, len(a), 0, len(b))
    total, most, todo = 0, whole, [(-whole, 0, len(a), 0, len(b))]
    while todo:
        if 2.0 * most / (len(a) + len(b)) < least:
            return None
        held, a0, a1, b0, b1 = heapq.heappop(todo)
        most += held
        if not held:
            continue
        other = b[b0:b1]
        run = np.zeros(len(other) + 1, np.int32)
        best, at, bt = 0, 0, 0
        for i in range(a0, a1):
            longer = np.where(other == a[i], run[:-1] + 1, 0)
            run[1:] = longer
            j = int(longer.argmax())
            if longer[j] > best:
                best, at, bt = int(longer[j]), i, b0 + j
        if best:
            total += best
            most += best
            for part in ((a0, at + 1 - best, b0, bt + 1 - best), (at + 1, a1, bt + 1, b1)):
                if part[0] < part[1] and part[2] < part[3]:
                    may = common(*part)
                    most += may
                    heapq.heappush(todo, (-may, *part))
    found = 2.0 * total / (len(a) + len(b))
    return found if found >= least else None


def ratio(a: Column, b: Column, autojunk: bool = True) -> Column:
    """Twice the length of all matching blocks over both lengths, 0 to 1."""
    of = (lambda x, y: SequenceMatcher(None, x, y).ratio()) if autojunk else block_ratio
    return rows_pass(lambda x, y: None if x is None or y is None else of(x, y), "double", pa.float64())(a, b)


def quick_ratio(a: Column, b: Column) -> Column:
    """An upper bound of the ratio: characters in common, whatever their order."""
    return rows_pass(lambda x, y: None if x is None or y is None else SequenceMatcher(None, x, y).quick_ratio(), "double", pa.float64())(a, b)


def letter_places(x: str) -> dict[str, int]:
    """A bit for each place at which a letter is."""
    places: dict[str, int] = {}
    for i, c in enumerate(x):
        places[c] = places.get(c, 0) | 1 << i
    return places


def subsequence_ratio(x: str, y: str, places: dict[str, int] | None = None) -> float:
    """Twice the length of the longest common subsequence over both lengths; matching blocks are a common subsequence, so no ratio is higher.

    ``places``: those of ``x``, where it meets many.
    """
    places = letter_places(x) if places is None else places
    full = (1 << len(x)) - 1
    free = full
    for c in y:
        met = free & places.get(c, 0)
        free = ((free + met) | (free - met)) & full
    return 2.0 * (len(x) - free.bit_count()) / (len(x) + len(y)) if x or y else 1.0


def ratio_from(a: Column, b: Column, least: float) -> Column:
    """The ratio of two texts without popular characters left out; null where an upper bound shows it is under ``least``."""

    def of(x: str | None, y: str | None) -> float | None:
        if x is None or y is None or subsequence_ratio(x, y) < least:
            return None
        return block_ratio(x, y, least)

    return rows_pass(of, "double", pa.float64())(a, b)


def token_ratio(a: Column, b: Column) -> Column:
    """The ratio of two arrays of words."""
    return rows_pass(lambda x, y: None if x is None or y is None else SequenceMatcher(None, x, y).ratio(), "double", pa.float64())(a, b)


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / F.size(F.array_union(a, b)))
