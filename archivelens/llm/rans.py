"""Files of token ids, compressed with a static range asymmetric numeral system.

The codec.  All files share one frequency table, made from all ids.  A file holds whole documents;
its ids are cut into blocks of :data:`BLOCK` ids that are decoded independently.  Within a block,
id ``j`` belongs to lane ``j % LANES``; each lane is a 64-bit state that puts out 32-bit words, so
all lanes of all blocks advance in step, as arrays.  The states at the start of each block are the
checkpoints: with the block index, a reader starts at any of them.  Each block has the crc32 of its
ids, the file that of its contents, and both name the crc32 of the table they need.

Layout, little-endian: magic, :data:`HEAD`, the documents' ids, null flags and lengths, the block
index (offset, ids, crc32), for each block its lanes' states, word counts and words; a crc32.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import texts as T
from . import tokens as K
from .storage import keep, scratch

MAGIC = b"ALRANS01"
#: crc32 of the table, ids before the file, ids, documents, blocks.
HEAD = struct.Struct("<IQQQI")
BLOCK, LANES = 65_536, 64
#: Frequencies add up to 2 ** SCALE; states stay between 2 ** LOW and 2 ** (LOW + 32).
SCALE, LOW = 20, 31
#: A file takes documents until it has so many ids.
FILE_IDS = 1 << 22
END_ID = 1

_LOW = np.uint64(1 << LOW)
_32 = np.uint64(32)
_SCALE = np.uint64(SCALE)
_INDEX = np.dtype([("offset", "<u8"), ("ids", "<u4"), ("crc", "<u4")])


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Whole frequencies of sum 2 ** SCALE in proportion to ``counts``; what occurs has 1 at least."""
    counts = np.asarray(counts, np.float64)
    total, goal = counts.sum(), 1 << SCALE
    if not total:
        return np.zeros(len(counts), np.uint32)
    f = np.where(counts > 0, np.maximum(1, np.floor(counts / total * goal)), 0).astype(np.int64)
    order = np.argsort(-f, kind="stable")
    rest = goal - int(f.sum())
    if rest > 0:
        f[order[0]] += rest
    for i in order:
        if rest >= 0:
            break
        give = min(int(f[i]) - 1, -rest)
        f[i] -= give
        rest += give
    return f.astype(np.uint32)


class Coder:
    """Encodes and decodes with one table."""

    def __init__(self, freq: np.ndarray):
        self.freq = np.asarray(freq, np.uint32)
        self.crc = zlib.crc32(self.freq.astype("<u4").tobytes())
        self.f = self.freq.astype(np.uint64)
        self.cum = np.concatenate([[0], np.cumsum(self.f)])[:-1].astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), self.freq)

    def _shape(self, n: int) -> tuple[int, np.ndarray, np.ndarray]:
        """Blocks; ids of each; ids of each lane of each block."""
        blocks = -(-n // BLOCK)
        ids = np.full(blocks, BLOCK, np.int64)
        if blocks:
            ids[-1] = n - (blocks - 1) * BLOCK
        return blocks, ids, np.maximum(0, (ids[:, None] - np.arange(LANES) + LANES - 1) // LANES).ravel()

    def encode(self, ids: np.ndarray, docs: np.ndarray, nulls: np.ndarray, lens: np.ndarray, before: int) -> bytes:
        """The bytes of a file. ``before``: ids of all documents before it."""
        n = len(ids)
        if n and (ids.max() >= len(self.freq) or not self.freq[ids].all()):
            raise ValueError("an id isn't in the table")
        blocks, sizes, steps = self._shape(n)
        top = int(steps.max(initial=0))
        lanes = np.zeros((blocks, top * LANES), np.uint32)
        for b in range(blocks):
            lanes[b, : sizes[b]] = ids[b * BLOCK : b * BLOCK + sizes[b]]
        lanes = np.ascontiguousarray(lanes.reshape(blocks, top, LANES).transpose(1, 0, 2)).reshape(top, blocks * LANES)
        x = np.full(blocks * LANES, _LOW)
        words = np.zeros((blocks * LANES, top * SCALE // 32 + 2), np.uint32)
        used = np.zeros(blocks * LANES, np.int64)
        even = int(steps.min(initial=0))
        for t in range(top - 1, -1, -1):
            on = slice(None) if t < even else np.flatnonzero(steps > t)
            s = lanes[t][on]
            f, y = self.f[s], x[on]
            out = np.flatnonzero(y >= f << np.uint64(LOW - SCALE + 32))
            if len(out):
                lane = out if t < even else on[out]
                words[lane, used[lane]] = (y[out] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                used[lane] += 1
                y = y.copy()
                y[out] >>= _32
            q = y // f
            x[on] = (q << _SCALE) + (y - q * f) + self.cum[s]
        index = np.zeros(blocks, _INDEX)
        bodies, at = [], len(MAGIC) + HEAD.size + len(docs) * 17 + blocks * _INDEX.itemsize
        for b in range(blocks):
            own = slice(b * LANES, (b + 1) * LANES)
            many, held = used[own], words[own]
            row = np.repeat(np.arange(LANES), many)
            place = np.repeat(np.cumsum(many), many) - 1 - np.arange(many.sum())  # a lane's last word is read first
            body = x[own].astype("<u8").tobytes() + many.astype("<u4").tobytes() + held[row, place].astype("<u4").tobytes()
            index[b] = (at, sizes[b], zlib.crc32(ids[b * BLOCK : b * BLOCK + sizes[b]].astype("<u4").tobytes()))
            bodies.append(body)
            at += len(body)
        parts = [MAGIC, HEAD.pack(self.crc, before, n, len(docs), blocks), docs.astype("<i8").tobytes(), nulls.astype("u1").tobytes(), lens.astype("<u8").tobytes(), index.tobytes(), *bodies]
        data = b"".join(parts)
        return data + struct.pack("<I", zlib.crc32(data))

    def decode(self, data: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """ids before, documents' ids, null flags, lengths, and all ids of a file; raises where a checksum is wrong."""
        data = bytes(data)
        if data[:8] != MAGIC or zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("a file is damaged")
        crc, before, n, n_docs, blocks = HEAD.unpack_from(data, 8)
        if crc != self.crc:
            raise ValueError("a file needs another table")
        at = 8 + HEAD.size
        docs = np.frombuffer(data, "<i8", n_docs, at)
        nulls = np.frombuffer(data, "u1", n_docs, at + 8 * n_docs)
        lens = np.frombuffer(data, "<u8", n_docs, at + 9 * n_docs).astype(np.int64)
        index = np.frombuffer(data, _INDEX, blocks, at + 17 * n_docs)
        return before, docs, nulls.astype(bool), lens, self.blocks(data, index)

    def blocks(self, data: bytes, index: np.ndarray) -> np.ndarray:
        """The ids of the blocks that ``index`` names, all lanes of all of them in step."""
        count = len(index)
        if not count:
            return np.zeros(0, np.uint32)
        sizes = index["ids"].astype(np.int64)
        steps = np.maximum(0, (sizes[:, None] - np.arange(LANES) + LANES - 1) // LANES).ravel()
        top, even = int(steps.max()), int(steps.min())
        x = np.concatenate([np.frombuffer(data, "<u8", LANES, int(o)) for o in index["offset"]]).astype(np.uint64)
        many = np.concatenate([np.frombuffer(data, "<u4", LANES, int(o) + 8 * LANES) for o in index["offset"]]).astype(np.int64)
        words = np.concatenate([np.frombuffer(data, "<u4", int(many[b * LANES : (b + 1) * LANES].sum()), int(o) + 12 * LANES) for b, o in enumerate(index["offset"])] + [np.zeros(1, np.uint32)])
        read = np.concatenate([[0], np.cumsum(many)])[:-1]
        out = np.zeros((top, count * LANES), np.uint32)
        mask = np.uint64((1 << SCALE) - 1)
        for t in range(top):
            on = slice(None) if t < even else np.flatnonzero(steps > t)
            y = x[on]
            slot = y & mask
            s = self.symbol[slot]
            out[t][on] = s
            y = self.f[s] * (y >> _SCALE) + slot - self.cum[s]
            low = np.flatnonzero(y < _LOW)
            if len(low):
                lane = low if t < even else on[low]
                y[low] = (y[low] << _32) | words[read[lane]]
                read[lane] += 1
            x[on] = y
        ids = out.reshape(top, count, LANES).transpose(1, 0, 2).reshape(count, -1)
        for b in range(count):
            if zlib.crc32(ids[b, : sizes[b]].astype("<u4").tobytes()) != index["crc"][b]:
                raise ValueError("a block is damaged")
        return np.concatenate([ids[b, : sizes[b]] for b in range(count)])


_SEGMENT = "part int, first bigint, n_ids bigint, docs binary, nulls binary, lens binary, ids binary, counts binary"


def _segments(path: str, end_id: int, file_ids: int):
    """Documents in order -> rows of many documents' ids, cut between documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        memo, part = K.memo(path), TaskContext.get().partitionId()
        size = max(memo.tokenizer.get_vocab_size(), end_id + 1)
        kind = "<u2" if size <= 1 << 16 else "<u4"
        held: list[tuple[np.ndarray, ...]] = []
        first = have = 0

        def row() -> pa.RecordBatch:
            docs, nulls, lens, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            values = (docs.astype("<i8"), nulls.astype("u1"), lens.astype("<u8"), ids.astype(kind), np.bincount(ids, minlength=size).astype("<u4"))
            names = [x.split()[0] for x in _SEGMENT.split(", ")]
            columns = [pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([len(ids)], pa.int64()), *(pa.array([v.tobytes()], pa.binary()) for v in values)]
            return pa.RecordBatch.from_arrays(columns, names)

        for b in batches:
            at = 0
            for text in T.slices(b.column("text"), T.LARGE_SLICE):
                ids, starts = memo.encode(text)
                ends = starts[1:] + np.arange(1, len(text) + 1)
                every = np.full(len(ids) + len(text), end_id, np.uint32)
                own = np.ones(len(every), bool)
                own[ends - 1] = False
                every[own] = ids
                doc = b.column("doc_id").slice(at, len(text))
                at += len(text)
                held.append((np.asarray(doc.fill_null(0), np.int64), ~np.asarray(doc.is_valid()), np.diff(starts) + 1, every))
                have += len(every)
                if have >= file_ids:
                    yield row()
                    held, first, have = [], first + have, 0
        if held:
            yield row()

    return run


def _summed(segments: DataFrame, size: int, width: int = 1024) -> np.ndarray:
    """The sum of all rows' counts: each task adds its rows up, then each range of ids is added up by one task."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(-(-size // width) * width, np.int64)
        for b in batches:
            for v in b.column(0):
                total[:size] += np.frombuffer(v.as_py(), "<u4")
        ranges = np.flatnonzero(total.reshape(-1, width).any(1))
        yield pa.RecordBatch.from_arrays([pa.array(ranges, pa.int32()), pa.array([total[r * width : (r + 1) * width].astype("<i8").tobytes() for r in ranges], pa.binary())], ["r", "v"])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for b in batches:
            for r, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found[r] = found.get(r, 0) + np.frombuffer(v, "<i8")
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([v.tobytes() for v in found.values()], pa.binary())], ["r", "v"])

    schema = "r int, v binary"
    rows = segments.select("counts").mapInArrow(own, schema).repartition("r").mapInArrow(gathered, schema).collect()
    total = np.zeros(-(-size // width) * width, np.int64)
    for r in rows:
        total[r["r"] * width : (r["r"] + 1) * width] = np.frombuffer(r["v"], "<i8")
    return total[:size]


def _put(uri: str, data: bytes) -> None:
    """Write a file under another name, then rename it: a task that runs again replaces it whole."""
    import uuid

    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(name := f"{path}.{uuid.uuid4().hex}.tmp") as f:
        f.write(data)
    system.move(name, path)


def write_ids(docs: DataFrame, folder: str, path: str, end_id: int = END_ID, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the ids of all documents, in ascending doc_id, to files in ``folder``; return the files' names and sizes.

    ``folder``: a URI that pyarrow can write, shared by all executors.  Texts are range-partitioned
    by doc_id (rows of equal id by a hash of their text) and encoded once; each partition's number of ids gives the others' offsets.
    A null text is empty, so has the end id alone; a null doc_id comes first; repeated rows are
    written as often as they come; an empty table writes the table of frequencies only.
    """
    spark = docs.sparkSession
    tie = F.xxhash64("text")
    ordered = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions(F.col("doc_id"), tie)
    segments = keep(ordered.mapInArrow(_segments(path, end_id, file_ids), _SEGMENT), "segments")
    sums = {r["part"]: r["n"] for r in segments.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    base, bases = 0, {}
    for part in sorted(sums):
        bases[part] = base
        base += sums[part]
    size = max(K.load(path).get_vocab_size(), end_id + 1)
    freq = frequencies(_summed(segments, size))
    _put(f"{folder}/table.freq", freq.astype("<u4").tobytes())
    shared = spark.sparkContext.broadcast((freq, bases))  # a number for each id of the vocabulary, and for each partition

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, before = shared.value
        coder = Coder(table)
        for b in batches:
            for r in b.to_pylist():
                kind = "<u2" if len(r["ids"]) == 2 * r["n_ids"] else "<u4"
                start = before[r["part"]] + r["first"]
                data = coder.encode(np.frombuffer(r["ids"], kind), np.frombuffer(r["docs"], "<i8"), np.frombuffer(r["nulls"], "u1"), np.frombuffer(r["lens"], "<u8"), start)
                _put(name := f"{folder}/{r['part']:07d}-{r['first']:015d}.rans", data)
                yield pa.RecordBatch.from_pydict({"file": [name], "start": [start], "n_ids": [r["n_ids"]], "n_bytes": [len(data)]})

    return keep(segments.drop("counts").mapInArrow(written, "file string, start bigint, n_ids bigint, n_bytes bigint"), "files")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of all files in ``folder``: doc_id, start (ids of all documents before it), n_tokens, ids (little-endian 32-bit)."""
    table = spark.read.format("binaryFile").load(f"{folder}/table.freq").select("content").first()["content"]
    shared = spark.sparkContext.broadcast(np.frombuffer(bytes(table), "<u4"))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for b in batches:
            for v in b.column(0):
                before, docs, nulls, lens, ids = coder.decode(v.as_py())
                ends = np.concatenate([[0], np.cumsum(lens)])
                at = 0
                while at < len(docs):  # some MB of ids at a time
                    stop = min(max(at + 1, int(np.searchsorted(ends, ends[at] + (1 << 20), side="right")) - 1), len(docs))
                    data = ids[ends[at] : ends[stop]].astype("<u4").view(np.uint8)
                    bounds = ((ends[at : stop + 1] - ends[at]) * 4).astype(np.int64)
                    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), stop - at, [None, pa.py_buffer(bounds), pa.py_buffer(data)]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(docs[at:stop], pa.int64(), mask=nulls[at:stop]), pa.array(before + ends[at:stop], pa.int64()), pa.array(lens[at:stop], pa.int64()), column], ["doc_id", "start", "n_tokens", "ids"])
                    at = stop

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.rans").load(folder).select("content")
    return files.mapInArrow(decoded, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def round_trip(docs: DataFrame, path: str, end_id: int = END_ID, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the ids of ``docs`` to a new folder among the shared ones, and read the files back."""
    folder = scratch(docs.sparkSession, "token-ids")
    write_ids(docs, folder, path, end_id, file_ids)
    return read_ids(docs.sparkSession, folder)
