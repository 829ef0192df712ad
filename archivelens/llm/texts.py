"""Whole columns of text as arrays: the helpers of the operators that run in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in slices of about so many bytes, which bounds a worker's memory; a longer text is a slice by itself.
SLICE_BYTES = 4 << 20
#: Where pieces that repeat are looked up but once a slice, larger ones are worth their memory.
LARGE_SLICE = 8 << 20

#: The bytes of white space that separate words: 0x20 and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_MIX = np.uint64(0x9E3779B97F4A7C15)


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Nulls become empty texts; each slice has at least one text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    ends = np.cumsum(np.asarray(pc.binary_length(texts), np.int64))
    at = 0
    while at < len(texts):
        stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right"))
        stop = min(max(stop, at + 1), len(texts))
        yield texts.slice(at, stop - at).cast(pa.string())
        at = stop
        if ends[-1] > size // 4:  # not worth its time for small batches
            trim()


def trim() -> None:
    """Give freed memory back: a worker lives on for other tasks, and its neighbours need what it doesn't."""
    import ctypes

    pa.default_memory_pool().release_unused()
    if give := getattr(ctypes.CDLL(None), "malloc_trim", None):
        give(0)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts on end, and where each begins (one more than there are texts)."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return held, ends - ends[0]


def strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The pieces between ``bounds`` as a string array over the same bytes."""
    return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data)))


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between ``bounds``."""
    run = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return run[bounds[1:]] - run[bounds[:-1]]


def words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of all texts on end, and where those of each text begin."""
    parts = pc.ascii_split_whitespace(texts)
    flat = parts.flatten()
    full = np.asarray(pc.binary_length(flat)) > 0  # white space at an end of a text leaves an empty part
    starts = np.concatenate([[0], np.cumsum(full)])[parts.offsets.to_numpy().astype(np.int64) - parts.offsets[0].as_py()]
    return (flat if full.all() else flat.filter(pa.array(full))).dictionary_encode(), starts


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hashes(values: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string, the same on every machine."""
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, values.cast(pa.binary()).to_pylist()), np.uint64, len(values))


def shingles(texts: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the word n-grams of all texts on end, and where those of each text begin.

    A text of fewer words than ``size`` has one n-gram, of all its words; a text without words has none.
    """
    flat, starts = words(texts)
    own = hashes(flat.dictionary)[flat.indices.to_numpy()] if len(flat) else np.zeros(0, np.uint64)
    n = np.diff(starts)
    many = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    bounds = np.concatenate([[0], np.cumsum(many)])
    first = np.repeat(starts[:-1] - bounds[:-1], many) + np.arange(bounds[-1])
    width = np.repeat(np.minimum(n, size), many)
    out = width.astype(np.uint64)
    for k in range(size):
        inside = width > k
        if inside.all():
            out = mix(out * _MIX + own[first + k])
        else:
            out[inside] = mix(out[inside] * _MIX + own[first[inside] + k])
    return out, bounds
