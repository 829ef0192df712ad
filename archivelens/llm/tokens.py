"""Tokenizers applied to columns of text.

A text may be cut in front of any ASCII white space that follows a character which is surely not
white space, and between an ASCII letter or digit and ASCII punctuation.  For the tokenizers that :func:`cuttable` accepts, the ids of the pieces on end are the
ids of the text: no pattern of theirs matches across such a place, nothing looks behind, and no
normalisation joins characters there.  Prose repeats its pieces, so each different piece is given to
the library once and its ids are remembered.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import texts as T

#: At most so many pieces are remembered by a worker (about 60 MB for a million).
REMEMBERED = 1_000_000

#: Pieces are given to the library so many at a time, on end.
TOGETHER = 1_000

_ALNUM = np.array([b < 128 and chr(b).isalnum() for b in range(256)])
_PUNCT = np.array([32 < b < 127 and not chr(b).isalnum() for b in range(256)])

#: Fixed value: the pattern of the word tokenizer's splitter. It matches no white space.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load(path: str):
    """The tokenizer of a file, once for each worker; threads would take other tasks' cores."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def kind(path: str) -> str:
    """'bytes' (byte-level, no normaliser), 'words' (white space dropped) or '' (cuts aren't proven)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre, norm = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    plain = model["type"] == "BPE" and not model.get("dropout") and not model.get("continuing_subword_prefix")
    for t in spec.get("added_tokens", []):
        plain &= not (t["lstrip"] or t["rstrip"] or t["single_word"]) and not any(c.isspace() for c in t["content"])
    if not plain:
        return ""
    if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        return "bytes"
    steps = pre.get("pretokenizers", [])
    norms = [x["type"] for x in (norm or {}).get("normalizers", [])]
    if [x["type"] for x in steps] == ["Split", "ByteLevel"] and set(norms) <= {"NFC", "Replace", "Lowercase"}:
        split, level = steps
        if split["pattern"] == {"Regex": WORD_PATTERN} and split["behavior"] == "Removed" and split["invert"] and not level["use_regex"] and not level["add_prefix_space"]:
            if all(x.get("pattern") == {"Regex": r"\s+"} and x["content"] == " " for x in norm["normalizers"] if x["type"] == "Replace"):
                return "words"
    return ""


def cuts(data: np.ndarray, starts: np.ndarray, never: bytes = b"") -> np.ndarray:
    """Where texts may be cut, as positions in ``data``; the texts' own starts are among them. ``never``: no cut in front of these."""
    at = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        before = data[:-1]
        solid = (before > 0x20) & (before != 0x7F)
        # of other alphabets: white space begins with the byte C2, E1, E2 or E3, so what does isn't surely solid
        high = np.flatnonzero((before >= 0x80) & T.SPACE[data[1:]])
        wide = np.isin(data, (0xE1, 0xE2, 0xE3))
        solid[high[(data[np.maximum(high - 1, 0)] == 0xC2) | wide[np.maximum(high - 2, 0)]]] = False
        punct = _PUNCT.copy()
        punct[list(never)] = False
        at[1:-1] = (T.SPACE[data[1:]] & solid) | (punct[data[1:]] & _ALNUM[before])
    at[starts] = True
    return np.flatnonzero(at)


class Memo:
    """Ids of columns of text, with the pieces met before remembered."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.tokenizer, self.kind, self.remembered = load(path), kind(path), remembered
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        self.angled = all("<" in t for t in self.special)
        self.mark = next(((t.content, i) for i, t in added.items() if t.special and not t.normalized), None)
        self.never = "".join(self.special).encode()
        self.known = pa.array([], pa.string())
        self.store, self.bounds = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _library(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces on end, and where each's begin.

        Many short calls are slow, so pieces are joined by a special token, which the library cuts
        out before anything else; pieces that hold one themselves are encoded alone.
        """
        alone = [] if self.mark else list(range(len(pieces)))
        own: dict[int, list[int]] = {}
        if self.mark:
            alone = [i for i, p in enumerate(pieces) if "<" in p and any(t in p for t in self.special)] if self.angled else [i for i, p in enumerate(pieces) if any(t in p for t in self.special)]
            pieces = pieces.copy() if alone else pieces
        for i, e in zip(alone, self.tokenizer.encode_batch_fast([pieces[i] for i in alone], add_special_tokens=False), strict=True):
            own[i] = e.ids
            pieces[i] = ""
        if not self.mark:
            parts = [np.array(own[i], np.uint32) for i in range(len(pieces))]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
            return np.concatenate([*parts, np.zeros(0, np.uint32)]), bounds
        mark, number = self.mark
        joined = [mark.join(pieces[i : i + TOGETHER]) + mark for i in range(0, len(pieces), TOGETHER)]
        flat = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.concatenate([*flat, np.zeros(0, np.uint32)])
        stops = np.flatnonzero(ids == number)
        bounds = np.concatenate([[0], stops - np.arange(len(stops))]).astype(np.int64)
        ids = ids[ids != number]
        for i in sorted(own, reverse=True):
            at = bounds[i]
            ids = np.concatenate([ids[:at], np.array(own[i], np.uint32), ids[at:]])
            bounds[i + 1 :] += len(own[i])
        return ids, bounds

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids on end, and where those of each text begin. ``texts``: a slice, without nulls."""
        if not self.kind:
            return self._library(texts.to_pylist())
        data, starts = T.utf8(texts)
        bounds = cuts(data, starts, self.never)
        if len(bounds) < 2:
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        flat = T.strings(data, bounds).dictionary_encode()
        pieces, which = flat.dictionary, flat.indices.to_numpy()
        place = np.asarray(pc.fill_null(pc.index_in(pieces, value_set=self.known), -1), np.int64)
        new = place < 0
        fresh = pieces.filter(pa.array(new))
        ids, ends = self._library(fresh.to_pylist())
        place[new] = len(self.known) + np.arange(len(fresh))
        store = np.concatenate([self.store, ids])
        limits = np.concatenate([self.bounds, self.bounds[-1] + ends[1:]])
        room = min(self.remembered - len(self.known), len(fresh))
        if room > 0:
            self.known = pa.concat_arrays([self.known, fresh.slice(0, room)])
            self.bounds = limits[: len(self.known) + 1].copy()
            self.store = store[: self.bounds[-1]].copy()
        first = limits[place][which]
        many = (limits[place + 1] - limits[place])[which]
        ends = np.concatenate([[0], np.cumsum(many)])
        out = store[np.repeat(first - ends[:-1], many) + np.arange(ends[-1])]
        return out, ends[np.searchsorted(bounds, starts)]


@lru_cache(maxsize=4)
def memo(path: str) -> Memo:
    """One for each worker process and tokenizer."""
    return Memo(path)
