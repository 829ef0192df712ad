"""Near-duplicate classes: BagMinHash signatures, bands, and verified multiset overlap.

A document is the multiset of its five-word shingles.  Two are near duplicates if the weighted
Jaccard similarity of their multisets is SIMILAR or more; classes are the connected components.

Signatures.  The weight axis of each shingle is cut into (0, 1], (1, 2], (2, 4], (4, 8] and so on.
Each piece has a Poisson process whose points carry a time, a register and, found by halving the
piece again and again, a whole weight; a point counts if the shingle's weight reaches that weight.  A register
keeps the least time.  Two documents have equal registers with a probability of just their weighted
Jaccard similarity.  Points come in order of time, and a process ends at the first that is later
than every register of its document, so long texts need little more than one point a shingle.

Candidates.  Equal texts become one node first.  Nodes meet in buckets of equal bands.  A bucket's
most popular node is its pivot, all others are verified against it, exactly; what then is in
one component needs no more pairs.  Small buckets that still hold several components have all pairs between them
verified.  Large ones are joined to groups, cut into blocks of members, and every member outside a
group's largest component is held against each block, by an index of its shingles; only links come out.
So no link of a bucket is lost, and no group's pairs are listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texts as T
from .quality import free_name
from .storage import discard, keep

SHINGLE, SIMILAR = 5, 0.8
#: With 32 bands of 5 registers, a pair of similarity .8 shares none with a probability of 3e-6.
BANDS, ROWS = 32, 5
#: Buckets of so many nodes at most are settled by all their pairs, larger ones in blocks of about so many nodes.
SMALL, BLOCK = 32, 512
#: A key with over one in HOT of all rows of a join is dealt to so many PARTS at most.
HOT, PARTS = 1000, 256

_R = np.uint64(0x9E3779B97F4A7C15)


def _unit(h: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from hashes."""
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def multisets(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, hash and weight of each different shingle of each text."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return owner[at], hashes[at], np.diff(np.append(at, len(hashes)))


def signatures(owner: np.ndarray, hashes: np.ndarray, weights: np.ndarray, docs: int, size: int = BANDS * ROWS) -> np.ndarray:
    """BagMinHash registers of ``docs`` documents; infinite where a document has no shingle."""
    out = np.full(docs * size, np.inf)
    # the pieces of the weight axis that a weight reaches into: piece 0 is (0, 1], piece k is (2 ** (k - 1), 2 ** k]
    pieces = np.where(weights > 1, np.ceil(np.log2(np.maximum(weights, 1))).astype(np.int64), 0) + 1
    doc, w = np.repeat(owner, pieces), np.repeat(weights, pieces)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    seed = T.mix(np.repeat(hashes, pieces) + _R * piece.astype(np.uint64))
    low = np.where(piece > 0, 1 << np.maximum(piece - 1, 0), 0)
    length = np.maximum(low, 1)
    time, step = np.zeros(len(doc)), 0
    while len(doc):
        # the next point of every process still running
        step += 1
        seed = T.mix(seed + _R)
        time = time - np.log(_unit(seed)) / (length * size)
        register = (T.mix(seed ^ np.uint64(0xD1B54A32D192ED03)) % np.uint64(size)).astype(np.int64)
        # halve the piece down to one whole weight: each bit picks a half
        bits = (T.mix(seed ^ np.uint64(0x2545F4914F6CDD1D)) & (length - 1).astype(np.uint64)).astype(np.int64)
        counts = low + bits + 1 <= w
        np.minimum.at(out, doc[counts] * size + register[counts], time[counts])
        if step < 4 or step % 8 == 0:
            last = out.reshape(docs, size).max(1)
        on = time < last[doc]
        doc, w, seed, low, length, time = doc[on], w[on], seed[on], low[on], length[on], time[on]
    return out.reshape(docs, size)


def bands(registers: np.ndarray, count: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each band of each document."""
    bits = registers.view(np.uint64).reshape(len(registers), count, rows)
    key = np.tile(T.mix(np.arange(1, count + 1, dtype=np.uint64) * _R), (len(registers), 1))
    for r in range(rows):
        key = T.mix(key * _R + bits[:, :, r])
    return key.view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at = 0
        for text in T.slices(b.column("text")):
            owner, hashes, weights = multisets(*T.shingles(text, SHINGLE))
            key = bands(signatures(owner, hashes, weights, len(text)))
            some = np.bincount(owner, minlength=len(text)) > 0
            ends = np.concatenate([[0], np.cumsum(np.where(some, BANDS, 0))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(key[some].ravel()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(at, len(text)), b.column("node").slice(at, len(text)), lists], ["doc_id", "node", "bands"])
            at += len(text)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets: sorted different hashes and their weights."""
    (ha, wa), (hb, wb) = a, b
    if not len(ha) or not len(hb):
        return 0.0
    at = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
    both = hb[at] == ha
    shared = np.minimum(wa[both], wb[at[both]]).sum()
    return float(shared / (wa.sum() + wb.sum() - shared))


def _bags(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    found = []
    for part in T.slices(texts):
        owner, hashes, weights = multisets(*T.shingles(part, SHINGLE))
        at = np.searchsorted(owner, np.arange(len(part) + 1))
        found += [(hashes[i:j], weights[i:j]) for i, j in zip(at, at[1:])]
    return found


#: Pairs, or nodes, whose shingles a worker holds at a time.
_HELD = 1_000


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, len(whole), _HELD):
            b = whole.slice(at, _HELD)
            # a pivot's text comes with each of its pairs; it is cut into shingles once
            pivots = b.column("b").to_pylist()
            first = {}
            for i, p in enumerate(pivots):
                first.setdefault(p, i)
            ours = _bags(b.column("text_a"))
            theirs = dict(zip(first, _bags(b.column("text_b").take(pa.array(list(first.values())))), strict=True))
            near = np.array([similarity(x, theirs[p]) >= SIMILAR for x, p in zip(ours, pivots, strict=True)], bool)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(near)], ["a", "b", "near"])


class _Block:
    """An index of the shingles of a block's members."""

    def __init__(self, members: list[tuple[int, int, np.ndarray, np.ndarray]]):
        self.n = np.array([m[0] for m in members], np.int64)
        self.comp = np.array([m[1] for m in members], np.int64)
        self.total = np.array([m[3].sum() for m in members], np.int64)
        owner = np.repeat(np.arange(len(members)), [len(m[2]) for m in members])
        hashes = np.concatenate([m[2] for m in members]) if members else np.zeros(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owner = hashes[order], owner[order]
        self.weight = (np.concatenate([m[3] for m in members]) if members else np.zeros(0, np.int64))[order]

    def links(self, comp: int, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Members that a node is linked with, one of each component but its own."""
        low, high = np.searchsorted(self.hashes, hashes, "left"), np.searchsorted(self.hashes, hashes, "right")
        many = high - low
        at = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
        shared = np.bincount(self.owner[at], np.minimum(self.weight[at], np.repeat(weights, many)), len(self.n))
        near = (shared > 0) & (self.comp != comp)
        near &= shared / np.maximum(self.total + weights.sum() - shared, 1) >= SIMILAR
        found = np.flatnonzero(near)
        return self.n[found[np.unique(self.comp[found], return_index=True)[1]]]


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of grp, block and guest: a block's members, then the nodes held against it. Out come links."""
    where, members, block = None, [], None
    for whole in batches:
        a, z = [], []
        for at in range(0, len(whole), _HELD):
            b = whole.slice(at, _HELD)
            columns = (b.column(c).to_pylist() for c in ("grp", "block", "guest", "n", "comp"))
            for grp, number, guest, n, comp, (hashes, weights) in zip(*columns, _bags(b.column("text")), strict=True):
                if (grp, number) != where:
                    where, members, block = (grp, number), [], None
                if not guest:
                    members.append((n, comp, hashes, weights))
                    continue
                if block is None:
                    block = _Block(members)
                found = block.links(comp, hashes, weights)
                a += [n] * len(found)
                z += found.tolist()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(z, pa.int64())], ["a", "b"])


def hot_keys(rows: DataFrame, key: str) -> DataFrame:
    """The keys of a kept table that have over one in HOT of its rows, and in how many parts to deal each: h_key, parts.

    There are fewer than HOT of them whatever the input, so the table may be broadcast.
    """
    total = rows.count()
    counts = rows.groupBy(F.col(key).alias("h_key")).agg(F.count("*").alias("c")).filter(F.col("c") * HOT > total)
    return counts.select("h_key", F.least(F.ceil(F.col("c") * HOT / F.lit(max(total, 1))), F.lit(PARTS)).cast("int").alias("parts"))


def spread_join(rows: DataFrame, by: DataFrame, key: str, hot: DataFrame, by_key: str) -> DataFrame:
    """Inner join of ``rows`` with ``by``, which has a key once: a hot key's rows are dealt to parts, and its row of ``by`` is copied to each."""
    few = F.broadcast(hot)
    part = F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64(*rows.columns), F.col("parts"))).otherwise(0).cast("int")
    dealt = rows.join(few, rows[key] == few["h_key"], "left").withColumn("part", part).drop("h_key", "parts")
    copied = by.join(few, by[by_key] == few["h_key"], "left").withColumn("b_part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("h_key", "parts")
    return dealt.join(copied, (dealt[key] == copied[by_key]) & (dealt["part"] == copied["b_part"])).drop("part", "b_part")


def components(edges: DataFrame) -> DataFrame:
    """The least node that each node of ``edges`` (columns a, b) is connected with: node, comp.

    Labels are taken from neighbours and then from labels' labels, until none changes.  The many edges of a
    hub are dealt to several tasks.
    """
    both = keep(edges.select("a", "b").union(edges.select("b", "a")).distinct().toDF("u", "v"), "edges")
    hubs = keep(hot_keys(both, "v"), "hubs")
    labels = keep(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("comp")), "labels")
    while True:
        near = spread_join(both, labels, "v", hubs, "node").groupBy("u").agg(F.min("comp").alias("low"))
        step = labels.join(near, labels["node"] == near["u"]).select("node", F.least("comp", "low").alias("comp"), F.col("comp").alias("was"))
        jump = labels.select(F.col("node").alias("j"), F.col("comp").alias("jump"))
        moved = keep(step.join(jump, step["comp"] == jump["j"]).select("node", F.least("comp", "jump").alias("comp"), "was"), "labels")
        discard(labels)
        if moved.filter("comp <> was").isEmpty():
            discard(both)
            return moved.select("node", "comp")
        labels = moved.select("node", "comp")


def _block_links(large: DataFrame, texts: DataFrame) -> DataFrame:
    """Links a, b between components within the groups that large buckets (key, n, comp) make; texts: n, text."""
    least = large.groupBy("key").agg(F.min("n").alias("b"))
    grouped = components(large.join(least, "key").select(F.col("n").alias("a"), "b").distinct()).toDF("g_node", "grp")
    nodes = keep(large.select("n", "comp").distinct().join(grouped, F.col("n") == F.col("g_node")).select("grp", "n", "comp"), "groups")
    sizes = nodes.groupBy("grp", "comp").agg(F.count("*").alias("c"))
    main = sizes.groupBy("grp").agg(F.sum("c").alias("c"), F.max(F.struct("c", "comp"))["comp"].alias("main")).select("grp", "main", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks"))
    held = nodes.join(main, "grp").join(texts, "n")
    own = held.select("grp", F.pmod(F.xxhash64("n"), F.col("blocks")).cast("int").alias("block"), F.lit(False).alias("guest"), "n", "comp", "text")
    guests = held.filter("comp <> main").select("grp", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("guest"), "n", "comp", "text")
    dealt = own.union(guests).repartition("grp", "block").sortWithinPartitions("grp", "block", "guest", "n")
    return dealt.mapInArrow(_blocked, "a bigint, b bigint")


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.filter("a <> b").distinct()


def near_duplicates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows doc_id, node, class_id of all documents, and a kept table of the nodes' classes.

    ``node`` is the MD5 of the text; ``class_id`` is the least doc_id of the class.  Equal texts are
    always one class, also empty ones; a text of fewer than five words is one shingle of all its words; a
    null text is a class of its own, as are texts without words that nothing equals.  Repeated rows are one text.
    Other columns of ``docs`` are ignored; an empty table gives an empty result.
    """
    node = F.unhex(F.md5(docs["text"].cast("binary")))
    signed = keep(docs.select("doc_id", node.alias("node"), "text").mapInArrow(_signed, "doc_id bigint, node binary, bands array<bigint>"), "signed")
    firsts = signed.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("first"), F.first("bands").alias("bands"))
    nodes = keep(firsts.withColumn("n", F.monotonically_increasing_id()), "nodes")  # the numbers are as written

    entries = nodes.select("n", F.explode("bands").alias("key"))
    shared = entries.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    met = keep(entries.join(shared, "key"), "buckets")
    popular = met.groupBy("n").agg(F.sum("size").alias("popular"))
    met = keep(met.join(popular, "n"), "buckets")

    text = docs.select("doc_id", node.alias("node"), "text").filter("text is not null")
    wanted = met.select("n").distinct().join(nodes.select("n", "node", "first"), "n")
    # of equal texts only that of the least doc_id has a partner, so the key is never hot
    found = text.join(wanted.hint("shuffle_hash"), (text["node"] == wanted["node"]) & text["doc_id"].eqNullSafe(wanted["first"]))
    texts = keep(found.select("n", "text").dropDuplicates(["n"]), "texts")

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = keep(pairs, "pairs")
        a, b = texts.select(F.col("n").alias("a"), F.col("text").alias("text_a")), texts.select(F.col("n").alias("n_b"), F.col("text").alias("text_b"))
        # a popular pivot has many pairs, each with the other's text
        both = spread_join(pairs.join(a, "a").select("a", "b", "text_a"), b, "b", hot_keys(pairs, "b"), "n_b")
        return keep(both.select("a", "b", "text_a", "text_b").mapInArrow(_verified, "a bigint, b bigint, near boolean"), "verified")

    pivot = F.max(F.struct("popular", (-F.col("n")).alias("m"))).alias("pivot")
    large = keep(hot_keys(met, "key"), "large")
    stars = spread_join(met, met.groupBy(F.col("key").alias("p_key")).agg(pivot), "key", large, "p_key").select(F.col("n").alias("a"), (-F.col("pivot.m")).alias("b"), "key")
    near = verified(_pairs(stars.select("a", "b"))).filter("near").select("a", "b")

    comp = components(near)
    labelled = met.join(comp.withColumnRenamed("node", "c_node"), F.col("n") == F.col("c_node"), "left").select("key", "n", "size", F.coalesce("comp", "n").alias("comp"))
    apart = labelled.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("key")
    still = keep(spread_join(labelled, apart.select(F.col("key").alias("a_key")), "key", large, "a_key").drop("a_key"), "apart")
    few = still.filter(F.col("size") <= SMALL)
    other = few.select("key", F.col("n").alias("b"), F.col("comp").alias("comp_b"))
    more = _pairs(few.join(other, "key").filter("comp <> comp_b and n < b").select(F.col("n").alias("a"), "b"))
    tested = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()
    more = verified(more.join(tested, ["a", "b"], "left_anti")).filter("near").select("a", "b")
    near = near.union(more).union(_block_links(still.filter(F.col("size") > SMALL), texts))
    comp = components(keep(near, "near"))

    grouped = nodes.join(comp, nodes["n"] == comp["node"], "left").select(nodes["node"], nodes["first"], F.coalesce("comp", "n").alias("comp"))
    least = grouped.groupBy("comp").agg(F.min("first").alias("class_id"))
    classes = keep(grouped.join(least, "comp").select(F.col("node").alias("c_node"), "first", "class_id"), "classes")
    # a third of all rows may be copies of one text
    own = signed.select("doc_id", "node").filter("node is not null")
    rows = spread_join(own, classes.select("c_node", "class_id"), "node", hot_keys(own, "node"), "c_node").select("doc_id", "node", "class_id")
    alone = signed.select("doc_id", "node").filter("node is null").withColumn("class_id", F.col("doc_id"))
    return rows.union(alone), classes


def classes(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id and class_id, the least doc_id of its class."""
    return near_duplicates(docs)[0].select("doc_id", "class_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The document of the least doc_id of each class, with its columns; null texts all stay.

    Of rows that repeat a document, one stays.  Whole texts of any length are compared; columns may have any names; an
    empty table gives an empty result.
    """
    rows, by = near_duplicates(docs)
    key = free_name(docs)
    keyed = docs.withColumn(key, F.unhex(F.md5(docs["text"].cast("binary"))))
    # of a class, nodes may share the least doc_id if ids repeat: the least node stays
    stay = by.filter(F.col("first").eqNullSafe(F.col("class_id"))).groupBy("class_id").agg(F.min("c_node").alias("c_node"))
    kept = keyed.join(stay, keyed[key].eqNullSafe(stay["c_node"]) & keyed["doc_id"].eqNullSafe(stay["class_id"]), "left_semi")
    repeated = not rows.filter("node is not null").groupBy("doc_id", "node").count().filter("count > 1").isEmpty()
    if repeated:
        kept = kept.dropDuplicates(["doc_id", key])
    out = kept.unionByName(keyed.filter(keyed[key].isNull()))
    return out.select(*(out[f"`{c}`"] for c in docs.columns))
