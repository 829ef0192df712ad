"""Homomorphic multiset hashes of documents.

A text is the multiset of its paragraphs, cut at line ends and, as prose comes in long lines too, at
sentence ends.  A paragraph's SHA-256 gives numbers that are added up over the text:

* five numbers of 48 bits, modulo 2 ** 48: texts are equal (up to order) if their sums are, and
  paragraphs may be added or taken away without the rest of the text;
* 144 bits, one for each lane of 16 bits, three lanes to a number, also modulo 2 ** 48: twice a
  lane's sum less the count is a sum of random signs, so the lanes of two texts have the cosine
  of their multisets, give or take 1/12 (a carry between lanes needs over 65,535 paragraphs and moves a lane by one);
* the count of paragraphs.

Everything is DataFrame functions.  Texts are shuffled once, into ranges of doc_id, and all that
follows stays there: hashing, summing and the comparison with the next document.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Where paragraphs end.
ENDS = r"\n|\. "
DENSE, SIGNS, SHIFTS = 5, 3, 16
_48 = (1 << 48) - 1
_LANES = 0x0001_0001_0001
#: At most so many ranges of doc_id; a range has one row for each cut on the driver and in the plan.
MOST_RANGES = 65_536
_FIRST = -(1 << 63)


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(text, ENDS), lambda p: p != "")


def numbers(paragraphs: Column) -> Column:
    """For each paragraph five numbers of 48 bits of its SHA-256; null gives nulls.

    Made before paragraphs are exploded, so each is hashed once however many sums use it.
    """
    digests = F.transform(paragraphs, lambda p: F.sha2(p.cast("binary"), 256))
    return F.transform(digests, lambda d: F.struct(*(F.conv(F.substring(d, 12 * j + 1, 12), 16, 10).cast("bigint").alias(f"h{j}") for j in range(DENSE))))


def summands(h: list[Column]) -> list[Column]:
    """The 59 whole numbers of a paragraph that are summed, from its five; null counts for nothing."""
    dense = [x for v in h for x in (v.bitwiseAND(F.lit((1 << 24) - 1)), F.shiftright(v, 24))]
    signs = [F.shiftright(h[j], i).bitwiseAND(F.lit(_LANES)) for j in range(SIGNS) for i in range(SHIFTS)]
    return [*dense, *signs, F.when(h[0].isNotNull(), F.lit(1)).cast("bigint")]


N_SUMS = 2 * DENSE + SIGNS * SHIFTS + 1


def vector(sums: list[Column]) -> Column:
    """The 54 numbers of a fingerprint, each modulo 2 ** 48, from the 59 sums."""
    m = F.lit(_48)
    dense = [(sums[2 * j] + F.shiftleft(sums[2 * j + 1].bitwiseAND(F.lit((1 << 24) - 1)), 24)).bitwiseAND(m) for j in range(DENSE)]
    return F.array(*dense, *(s.bitwiseAND(m) for s in sums[2 * DENSE :]))


def add(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint vector of two texts on end, or (``sign`` -1) of what is left if ``b`` is taken from ``a``."""
    return F.zip_with(a, b, lambda x, y: (x + sign * y).bitwiseAND(F.lit(_48)))


def shown(v: Column) -> Column:
    """A vector as lower-case hexadecimal digits."""
    return F.array_join(F.transform(v, lambda x: F.lpad(F.lower(F.hex(x)), 12, "0")), "")


def signs(v: Column) -> Column:
    """The 144 sums of signs of a vector."""
    count = F.element_at(v, -1)
    lane = lambda k: F.transform(F.slice(v, DENSE + 1, SIGNS * SHIFTS), lambda x: F.pmod(2 * F.shiftright(x, 16 * k).bitwiseAND(F.lit(65535)) - count + 65536, F.lit(131072)) - 65536)
    return F.concat(lane(0), lane(1), lane(2))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("bigint"), lambda s, x: s + x)


def likeness(a: Column, b: Column, signs_a: Column, signs_b: Column) -> Column:
    """1 for equal vectors, else the cosine of their signs, 0 at least; 0 if just one is of an empty text."""
    norms = F.sqrt(_dot(signs_a, signs_a).cast("double")) * F.sqrt(_dot(signs_b, signs_b).cast("double"))
    cosine = F.when(norms > 0, _dot(signs_a, signs_b).cast("double") / norms).otherwise(F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def _place(text: Column) -> Column:
    """The first six bytes of a text as a number, in the order of texts."""
    return F.conv(F.rpad(F.hex(F.substring(text.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("bigint")


def _range_of(key: Column, place: Column, cuts: list[tuple[int, int]]) -> Column:
    """How many of ``cuts`` aren't above (``key``, ``place``), by bisection."""
    steps = max(1, len(cuts).bit_length())
    filled = cuts + [((1 << 63) - 1, (1 << 63) - 1)] * ((1 << steps) - 1 - len(cuts))
    keys, places = F.lit([k for k, _ in filled]), F.lit([t for _, t in filled])

    def step(at: Column, k: Column) -> Column:
        own = F.element_at(keys, at + k)
        return at + F.when((own < key) | ((own == key) & (F.element_at(places, at + k) <= place)), k).otherwise(0)

    return F.aggregate(F.lit([1 << k for k in range(steps - 1, -1, -1)]), F.lit(0), step)


def _cuts(docs: DataFrame, key: Column, place: Column, n: int) -> tuple[list[tuple[int, int]], bool]:
    """Where about ``n`` even ranges begin: keys, and places within keys that fill several ranges (-1: from the key's first); and whether there are such keys."""
    steps = [j / n for j in range(1, n)]
    found = docs.select(key.alias("k")).agg(F.percentile_approx("k", steps or [0.5], max(10_000, 4 * n)).alias("cuts")).first()["cuts"]
    seen = Counter(found or [])
    hot = [k for k, m in seen.items() if m > 1]
    cuts = {(k, -1) for k in seen}
    if hot:
        # a key that is several quantiles is cut by the places of its texts; there are fewer such keys than ranges
        own = docs.select(key.alias("k"), place.alias("t")).filter(F.col("k").isin(hot))
        for r in own.groupBy("k").agg(F.percentile_approx("t", steps, max(10_000, 4 * n)).alias("ts")).collect():
            many = seen[r["k"]]
            cuts |= {(r["k"], r["ts"][j * len(r["ts"]) // many]) for j in range(1, many)}
    return sorted(cuts), bool(hot)


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Rows part, rn, ghost, doc_id, text and next_text, the text of the next document by ascending doc_id (after the last: the first).

    Ranges of doc_id are bounded by approximate quantiles, and ranges within one id that has very many rows by
    those of its texts' first bytes.  The documents that begin a range are also sent, as ghosts, to the range
    before, whose last document needs them.  Null ids come first; rows of one id are in order of their texts; null
    texts are empty.  One document is its own next.
    """
    spark = docs.sparkSession
    n = min(MOST_RANGES, ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    key, held = F.coalesce(docs["doc_id"].cast("bigint"), F.lit(_FIRST)), F.coalesce(docs["text"], F.lit(""))
    cuts, hot = _cuts(docs, key, _place(held), n)
    t = _place(held) if hot else F.lit(0)  # texts needn't be read for ranges of ids alone
    keyed = docs.select(key.alias("k"), t.alias("t"))
    part = _range_of(F.col("k"), F.col("t"), cuts)
    # the cuts are approximate, so what each range begins with is looked up: one row for each range
    firsts = {r["part"]: r["first"] for r in keyed.groupBy(part.alias("part")).agg(F.min(F.struct("k", "t")).alias("first")).collect()}
    full = sorted(firsts)
    before = dict(zip(full, full[-1:] + full[:-1]))
    of = lambda values: F.element_at(F.lit([int(values(p)) if p in firsts else 0 for p in range(len(cuts) + 1)]), F.col("part") + 1)
    rows = docs.select(key.alias("k"), "doc_id", held.alias("text"), t.alias("t")).withColumn("part", part)
    place = lambda p, ghost: F.struct(p.alias("part"), F.lit(ghost).alias("ghost"))
    begins = (of(lambda p: firsts[p]["k"]) == F.col("k")) & (of(lambda p: firsts[p]["t"]) == F.col("t"))
    places = F.when(begins, F.array(place(F.col("part"), False), place(of(lambda p: before[p]).cast("int"), True))).otherwise(F.array(place(F.col("part"), False)))
    rows = rows.select("k", "doc_id", "text", F.explode(places).alias("at")).select("k", "doc_id", "text", "at.part", "at.ghost")
    order = Window.partitionBy("part").orderBy("ghost", "k", "text")
    return rows.select("part", "ghost", "doc_id", "text", F.row_number().over(order).alias("rn"), F.lead("text").over(order).alias("next_text"))


def edited(text: Column, next_text: Column) -> Column:
    """``text`` with the last half of its characters replaced by as many, or all, of the next text's first."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(text.substr(F.lit(1), n - half), next_text.substr(F.lit(1), half))


def fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """One row for each document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    A null text is empty, and an empty text's fingerprint is all zeros; whole texts of any length count; repeated
    rows give repeated rows; other columns of ``docs`` are ignored; an empty table gives an empty result.
    """
    rows = with_next(docs, ranges)
    changed = rows.withColumn("edited", F.coalesce(edited(F.col("text"), F.col("next_text")), F.lit("")))
    unit = lambda of, which: F.transform(numbers(F.concat(F.array(F.lit(None).cast("string")), paragraphs(F.col(of)))), lambda h: F.struct(F.lit(which).alias("which"), h.alias("h")))
    own = ("part", "rn", "ghost", "doc_id", "n_chars", "edited_sha256")
    # what is made of whole texts is made before paragraphs are exploded, so once for each document
    whole = changed.select(
        "part", "rn", "ghost", "doc_id", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.concat(unit("text", 0), unit("edited", 1)).alias("us"),
    )
    units = whole.select(*own, F.explode("us").alias("u"))
    hashed = units.select(*own, F.col("u.which").alias("which"), *(x.alias(f"x{i}") for i, x in enumerate(summands([F.col(f"u.h.h{j}") for j in range(DENSE)]))))
    sums = hashed.groupBy(*own, "which").agg(*(F.coalesce(F.sum(f"x{i}"), F.lit(0)).alias(f"s{i}") for i in range(N_SUMS)))
    vectors = sums.select(*own, "which", vector([F.col(f"s{i}") for i in range(N_SUMS)]).alias("v")).withColumn("g", signs(F.col("v")))
    order = Window.partitionBy("part").orderBy("rn", "which")
    near = vectors.select(*own, "which", "v", "g", *(F.lead(c, k).over(order).alias(f"{c}{k}") for c in ("v", "g") for k in (1, 2)))
    near = near.filter("which = 0 and not ghost")
    return near.select(
        "doc_id", "n_chars", "edited_sha256", shown(F.col("v")).alias("fingerprint"), shown(F.col("v1")).alias("edited_fingerprint"),
        likeness(*map(F.col, ("v", "v1", "g", "g1"))).alias("near_edited"), likeness(*map(F.col, ("v", "v2", "g", "g2"))).alias("near_next"),
    )


def oracle() -> str:
    """The query in DuckDB's SQL."""
    h = ", ".join(f"('0x' || substr(z, {12 * j + 1}, 12))::BIGINT AS h{j}" for j in range(DENSE))
    xs = [x for j in range(DENSE) for x in (f"h{j} & {(1 << 24) - 1}", f"h{j} >> 24")] + [f"(h{j} >> {i}) & {_LANES}" for j in range(SIGNS) for i in range(SHIFTS)] + ["1"]
    sums = ", ".join(f"coalesce(sum({x}) FILTER (u IS NOT NULL), 0)::BIGINT AS s{i}" for i, x in enumerate(xs))
    v = [f"(s{2 * j} + ((s{2 * j + 1} & {(1 << 24) - 1}) << 24)) & {_48}" for j in range(DENSE)] + [f"s{i} & {_48}" for i in range(2 * DENSE, N_SUMS)]
    vs = ", ".join(f"{x} AS v{i}" for i, x in enumerate(v))
    hexed = lambda p: " || ".join(f"lpad(lower(to_hex({p}.v{i})), 12, '0')" for i in range(len(v)))
    count = f"v{len(v) - 1}"
    lanes = ", ".join(f"2 * ((v{i} >> {16 * k}) & 65535) - {count}" for k in range(3) for i in range(DENSE, DENSE + SIGNS * SHIFTS))
    same = lambda a, b: f"{a}.fp = {b}.fp"
    dot = lambda a, b: f"list_dot_product({a}.g, {b}.g)"

    def near(a: str, b: str) -> str:
        norms = f"(sqrt({dot(a, a)}) * sqrt({dot(b, b)}))"
        return f"CASE WHEN {same(a, b)} THEN 1.0::DOUBLE WHEN {norms} > 0 THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, {dot(a, b)} / {norms})) ELSE 0.0::DOUBLE END"

    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id) AS rn FROM documents),
n AS (SELECT *, coalesce(lead(text) OVER (ORDER BY rn), first_value(text) OVER (ORDER BY rn)) AS nxt, length(text) AS n FROM d),
e AS (SELECT *, substr(text, 1, n - n // 2) || substr(nxt, 1, n // 2) AS edited FROM n),
t AS (SELECT rn, 0 AS w, text AS t FROM e UNION ALL SELECT rn, 1, edited FROM e),
p AS (SELECT rn, w, unnest(string_split_regex(t, '\\n|\\. ')) AS u FROM t),
z AS (SELECT rn, w, u, sha256(u) AS z FROM p WHERE u <> '' UNION ALL SELECT rn, w, NULL, NULL FROM t),
h AS (SELECT rn, w, u, {h} FROM z),
s AS (SELECT rn, w, {sums} FROM h GROUP BY rn, w),
v AS (SELECT rn, w, {vs} FROM s),
f AS (SELECT rn, w, {hexed("v")} AS fp, [{lanes}]::DOUBLE[] AS g FROM v)
SELECT e.doc_id, e.n AS n_chars, sha256(e.edited) AS edited_sha256, a.fp AS fingerprint, b.fp AS edited_fingerprint,
  {near("a", "b")} AS near_edited, {near("a", "c")} AS near_next
FROM e JOIN f a ON a.rn = e.rn AND a.w = 0 JOIN f b ON b.rn = e.rn AND b.w = 1
JOIN f c ON c.w = 0 AND c.rn = CASE WHEN e.rn = (SELECT max(rn) FROM d) THEN 1 ELSE e.rn + 1 END
"""
