"""Training sequences of neighbouring documents, along a space-filling curve."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texts as T
from . import tokens as K
from .storage import keep

SEQUENCE = 2048
END_ID = 1
#: The curve runs through a cube of DIMS dimensions, with 2 ** BITS cells along each.
DIMS, BITS = 3, 16
UNIT = 1 << 20
#: Ranges of the curve hold about so many ids.
RANGE_IDS = 1 << 23


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Places of points (rows of whole numbers under 2 ** bits) along the Hilbert curve.

    Bits are handled from the highest down, as in Skilling's "Programming the Hilbert curve": each
    undoes a reflection or an exchange of axes, and the Gray code of what is left is the place.
    """
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for d in range(dims):
            turned = (x[d] >> level) & 1 == 1
            swap = np.where(turned, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            if d:
                x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    fix = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        fix ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= fix
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            place = place << 1 | (x[d] >> level) & 1
    return place


def directions(size: int, dims: int = DIMS) -> np.ndarray:
    """For each id a hashed vector of mean 0 and variance 1, in whole numbers of one in UNIT, so that sums are exact."""
    h = T.mix(np.arange(1, size * dims + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.round(((h >> np.uint64(11)).astype(np.float64) / 2**53 - 0.5).reshape(size, dims) * 12**0.5 * UNIT).astype(np.int64)


def curve_keys(ids: np.ndarray, starts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Hilbert keys of documents: the mean of their ids' vectors, each coordinate squashed to a cell. Empty ones lie at the middle."""
    n = np.maximum(np.diff(starts), 1)[:, None]
    mean = np.stack([T.sums(table[ids, d], starts) for d in range(table.shape[1])], 1) / (n * float(UNIT))
    cells = np.floor((np.arctan(mean * 6) / np.pi + 0.5) * (1 << BITS)).astype(np.int64)
    return hilbert(np.clip(cells, 0, (1 << BITS) - 1), BITS)


_ENCODED = "doc_id bigint, key bigint, n bigint, ids binary"


def _encoded(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = K.memo(path)
        size = max(memo.tokenizer.get_vocab_size(), end_id + 1)
        table = directions(size)
        kind = "<u2" if size <= 1 << 16 else "<u4"
        for b in batches:
            at = 0
            for text in T.slices(b.column("text"), T.LARGE_SLICE):
                ids, starts = memo.encode(text)
                keys = np.concatenate([_part_keys(ids, starts, i, min(i + 256, len(text)), table) for i in range(0, len(text), 256)])
                n = np.diff(starts) + 1
                every = np.full(len(ids) + len(text), end_id, kind)
                own = np.ones(len(every), bool)
                own[np.cumsum(n) - 1] = False
                every[own] = ids
                bounds = np.concatenate([[0], np.cumsum(n)]) * every.itemsize
                column = pa.BinaryArray.from_buffers(pa.binary(), len(text), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(every.view(np.uint8))])
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(at, len(text)), pa.array(keys, pa.int64()), pa.array(n, pa.int64()), column], ["doc_id", "key", "n", "ids"])
                at += len(text)

    return run


def _part_keys(ids: np.ndarray, starts: np.ndarray, a: int, b: int, table: np.ndarray) -> np.ndarray:
    """The keys of some hundred texts, which bounds the memory of their ids' vectors."""
    own = ids[starts[a] : starts[b]]
    return curve_keys(own, starts[a : b + 1] - starts[a], table)


_PIECES = "doc_id bigint, start bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def _pieces(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sequence = TaskContext.get().partitionId() << 32
        names = [x.split()[0] for x in _PIECES.split(", ")]
        types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        rows: list[tuple] = []
        open_: list[tuple] = []
        fill = 0

        def close(held: list[tuple]) -> None:
            nonlocal sequence
            offset = 0
            for doc, start, ids, n in held:
                rows.append((doc, start, ids.tobytes(), n, sequence, offset))
                offset += len(ids)
            sequence += 1

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
            rows.clear()
            return batch

        for b in batches:
            for doc, n, data in zip(b.column("doc_id").to_pylist(), b.column("n").to_pylist(), b.column("ids").to_pylist(), strict=True):
                ids = np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4").astype("<u4")
                at = 0
                while at < n:
                    take = min(size - fill, n - at)
                    open_.append((doc, at, ids[at : at + take], n))
                    at, fill = at + take, fill + take
                    if fill == size:
                        close(open_)
                        open_, fill = [], 0
                if len(rows) >= 4000:
                    yield out()
        # what is left makes sequences whose lengths are powers of two, which need no padding
        while fill:
            length = 1 << (fill.bit_length() - 1)
            fill -= length
            held: list[tuple] = []
            while length:
                doc, start, ids, n = open_.pop(0)
                if len(ids) > length:
                    open_.insert(0, (doc, start + length, ids[length:], n))
                    ids = ids[:length]
                held.append((doc, start, ids, n))
                length -= len(ids)
            close(held)
        if rows:
            yield out()

    return run


def pack(docs: DataFrame, path: str, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Cut all documents' ids, in order of the curve, into sequences; one row for each piece.

    Columns: doc_id, start, ids (little-endian 32-bit), doc_tokens, sequence_id, offset.  Documents
    are encoded once; the kept table is sorted by ranges of the Hilbert key, ties by doc_id, so that
    a large group of equal documents spans many tasks; there are as many ranges as keep them at about RANGE_IDS ids,
    so tasks don't grow with the input.  Equal texts have equal keys.  Within a task all ids lie on end and are cut
    at each ``size``; the rest of a task makes sequences whose lengths are powers of two, so nothing
    is padded if ``size`` is one.  A null text is the end id alone; repeated rows are packed as
    often as they come, a very long text is cut over many sequences; other columns of ``docs`` are ignored; an empty table gives no piece.
    """
    encoded = keep(docs.select("doc_id", "text").mapInArrow(_encoded(path, end_id), _ENCODED), "encoded")
    order = ("key", "doc_id", "n")
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(encoded.agg(F.sum("n")).first()[0] or 0) // RANGE_IDS))
    return encoded.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(_pieces(size), _PIECES)


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with their length and crc32 in place of their ids."""
    return pieces.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
