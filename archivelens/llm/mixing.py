"""Mixing sources to target weights by Pareto order sampling.

Within a source, documents don't have one and the same chance: the expected copies of a document fall
with the square root of its size, so that a source's words come from many documents and no long one
rules them.  A document of n words is expected least(3, level * roots(n) / n) times, with the level at which
the expected words are the source's target; it is found by running sums over the different sizes.
The whole copies are certain.  What is left of the expectation is a document's inclusion probability p, and a
fixed size, the words that the target still lacks, is drawn by Pareto's order: documents are
ranked by u / (1 - u) over p / (1 - p), u being random, and taken by rank until the next doesn't fit.

Words are no unit to be had singly, so the draw goes on: of what wasn't taken, documents that are no larger
than what still lacks are taken by rank until the next doesn't fit, and so again, :data:`PASSES` times
in all.  The last pass also takes the document that doesn't fit if the target is nearer with it.  The passes
move chances from the document or two at which a pass ends to a few smaller ones, whatever the source's
size; what that is in proportion falls with the number of its documents.

Ranks are never taken over a whole source.  Documents fall into bins of their rank; sums of bins
find the bin in which a pass ends, and only documents of that bin are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quality import free_name
from .storage import keep, tidy

#: At least so many bins of ranks, and as many as keep bins at about DOCS_PER_BIN documents.
BINS, DOCS_PER_BIN = 4096, 50_000
#: No document is taken more often, and no target is higher, than so many times the size.
MOST = 3
PASSES = 4
#: Tables of sources of so many rows at most are broadcast (their count is checked).
MOST_BROADCAST = 50_000


def n_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def roots(size: Column) -> Column:
    """Sixteen times the square root, as a whole number, so that sums of it are exact."""
    return F.floor(16 * F.sqrt(size.cast("double")) + 0.5)


def random_part(*keys: Column) -> Column:
    """A number in (0, 1) drawn from a hash of the keys, the same in every run."""
    digest = F.md5(F.concat_ws(":", *(F.coalesce(k.cast("string"), F.lit("")) for k in keys)).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint").cast("double") + 0.5) / float(1 << 48)


def targets(sizes: DataFrame) -> DataFrame:
    """For each source: source_size and target, from the columns source and size.

    Sources in code point order, null last, weigh 1, 2, 3 and so on again, and share the size of all
    documents.  A target stops at MOST times its source's size and the excess goes to the others by
    weight.  That is one level of target over weight for all that don't stop: the lowest at which
    the sum fits, found by running sums over sources in order of the level at which each stops.
    """
    by = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    weight = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1
    by = by.withColumn("weight", weight).withColumn("stop", MOST * F.col("source_size") / F.col("weight"))
    order = Window.orderBy("stop", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    run = by.select(
        "*",
        F.coalesce(F.sum(MOST * F.col("source_size")).over(before), F.lit(0)).alias("stopped"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("rest"),
        F.sum("source_size").over(every).alias("total"),
    ).withColumn("level", (F.col("total") - F.col("stopped")) / F.col("rest"))
    # the sources up to the first that a level doesn't exceed have stopped
    fits = run.withColumn("fit", F.min(F.when(F.col("stop") >= F.col("level"), F.struct("stop", F.col("source").isNull(), "source", "level"))).over(every))
    level = F.coalesce(F.col("fit.level"), F.lit(float("inf")))
    return fits.select("source", "source_size", F.when(F.col("stop") <= level, (MOST * F.col("source_size")).cast("double")).otherwise(F.col("weight") * level).alias("target"))


def pareto_rank(u: Column, chance: Column) -> Column:
    """Random odds over inclusion odds."""
    p = F.greatest(F.least(chance, F.lit(1 - 1e-12)), F.lit(1e-12))
    return (u / (1 - u)) / (p / (1 - p))


def expected_copies(size: Column, level: Column) -> Column:
    """At least 0 and at most MOST; without a level (a source that is taken whole, MOST times), MOST."""
    return F.coalesce(F.least(F.lit(float(MOST)), level * roots(size) / F.greatest(size, F.lit(1))), F.lit(float(MOST)))


def levels(sizes: DataFrame) -> tuple[DataFrame, int]:
    """For each source m_source, source_size, target, level and goal, the words to be drawn, and the number of documents.

    Sizes are counted first, so a source has a row for each different size, not for each document.
    """
    counts = keep(sizes.groupBy("source", "size").agg(F.count("*").alias("n")), "counts")
    by = targets(counts.select("source", (F.col("size") * F.col("n")).alias("size"))).withColumnRenamed("source", "m_source")
    some = counts.filter("size > 0").withColumn("stop", MOST * F.col("size") / roots(F.col("size")))
    every = Window.partitionBy("source")
    order = every.orderBy("stop", "size")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    root = F.col("n") * roots(F.col("size"))
    run = some.select("*", F.coalesce(F.sum(MOST * F.col("size") * F.col("n")).over(before), F.lit(0)).alias("stopped"), (F.sum(root).over(every) - F.coalesce(F.sum(root).over(before), F.lit(0))).alias("rest"))
    tried = run.join(by, run["source"].eqNullSafe(by["m_source"])).withColumn("level", (F.col("target") - F.col("stopped")) / F.col("rest"))
    # the sizes up to the first that a level doesn't exceed have stopped
    first = F.min(F.when((F.col("stop") >= F.col("level")) & (F.col("target") < MOST * F.col("source_size")), F.struct("stop", "size", "level")))["level"]
    level = tried.groupBy("m_source").agg(first.alias("level")).withColumnRenamed("m_source", "l_source")
    by = keep(by.join(level, by["m_source"].eqNullSafe(level["l_source"]), "left").drop("l_source"), "levels")
    # certain copies need only sizes as well
    sure = some.join(by.select("m_source", "level"), some["source"].eqNullSafe(F.col("m_source"))).groupBy(F.col("m_source").alias("w_source")).agg(F.sum(F.floor(expected_copies(F.col("size"), F.col("level"))) * F.col("size") * F.col("n")).alias("sure"))
    by = by.join(sure, by["m_source"].eqNullSafe(sure["w_source"]), "left")
    by = keep(by.select("m_source", "source_size", "target", "level", (F.col("target") - F.coalesce("sure", F.lit(0))).alias("goal")), "levels")
    return by, counts.agg(F.sum("n")).first()[0] or 0


def _joined(rows: DataFrame, by: DataFrame, source: Column, small: bool) -> DataFrame:
    """``rows`` with the columns of their source; one source may hold most rows, so the table of sources is sent to them if it is small."""
    return rows.join(F.broadcast(by) if small else by, source.eqNullSafe(by["m_source"]))


def _bin(q: Column, bins: int) -> Column:
    """Ranks lie between 0 and infinity; bins are even in q / (1 + q)."""
    return F.least(F.floor(q / (1 + q) * bins), F.lit(bins - 1)).cast("int")


def _ranked(rows: DataFrame, bins: int, seed: str) -> DataFrame:
    """``rows``, with size, doc_id and level, and their whole copies and, where one more may be drawn, rank and bin."""
    copies = expected_copies(F.col("size"), F.col("level"))
    rows = rows.withColumn("whole", F.when(F.col("size") > 0, F.floor(copies)).otherwise(0)).withColumn("part", copies - F.col("whole"))
    q = F.when((F.col("size") > 0) & (F.col("part") > 0), pareto_rank(random_part(F.lit(seed), F.col("doc_id")), F.col("part")))
    rows = rows.withColumn("q", q).withColumn("bin", _bin(F.col("q"), bins))
    return rows.withColumn("rank", F.when(F.col("q").isNotNull(), F.struct("q", "doc_id", "size")))


def _taken(k: int) -> Column:
    """Whether one of the first ``k`` passes takes a document, next to the columns of its source."""
    out = F.lit(False)
    for j in range(k):
        inside = F.col(f"end{j}").isNull() | (F.col("bin") < F.col(f"end{j}")) | ((F.col("bin") == F.col(f"end{j}")) & F.coalesce(F.col("rank") <= F.col(f"last{j}"), F.lit(False)))
        out = out | ((F.col("size") <= F.col(f"goal{j}")) & inside if j else inside)
    return F.col("q").isNotNull() & out


def _pass(rows: DataFrame, by: DataFrame, k: int, small: bool) -> DataFrame:
    """``by`` with where pass ``k`` ends (a bin, null if all are taken), the last rank taken in that bin, and what still lacks."""
    goal = F.col(f"goal{k}")
    left = _joined(rows, by, F.col("source"), small).filter(~_taken(k) & (F.col("size") <= goal if k else F.lit(True)))
    sums = left.groupBy("m_source", "bin", goal.alias("goal")).agg(F.sum("size").alias("s"))
    run = sums.withColumn("run", F.sum("s").over(Window.partitionBy("m_source").orderBy("bin")))
    ended = F.when((F.col("run") > F.col("goal")) & (F.col("run") - F.col("s") <= F.col("goal")), F.struct(F.col("bin").alias("end"), (F.col("run") - F.col("s")).alias("had")))
    per = run.groupBy(F.col("m_source").alias("e_source")).agg(F.max(ended).alias("e"), F.sum("s").alias("total"))
    ends = keep(by.join(per, by["m_source"].eqNullSafe(per["e_source"]), "left").select(*by.columns, "e.end", "e.had", "total"), "ends")
    inside = _joined(rows, ends, F.col("source"), small).filter(~_taken(k) & (F.col("bin") == F.col("end")) & (F.col("size") <= goal if k else F.lit(True)))
    ranks = inside.groupBy("m_source", "had", goal.alias("goal"), "rank").agg(F.sum("size").alias("own"))
    ranks = ranks.withColumn("run", F.col("had") + F.sum("own").over(Window.partitionBy("m_source").orderBy("rank")))
    last = ranks.filter(takes("run", "own", "goal", k)).groupBy(F.col("m_source").alias("l_source")).agg(F.max("rank").alias(f"last{k}"), F.max("run").alias("run"))
    found = ends.join(last, ends["m_source"].eqNullSafe(last["l_source"]), "left")
    words = F.when(F.col("end").isNull(), F.coalesce("total", F.lit(0))).otherwise(F.coalesce("run", "had"))
    return keep(found.select(*by.columns, F.col("end").alias(f"end{k}"), f"last{k}", (goal - words).alias(f"goal{k + 1}")), "ends")


def takes(run: str, own: str, goal: str, k: int) -> str:
    """The SQL of whether pass ``k`` takes what brings its words from ``run - own`` to ``run``."""
    near = f" OR ({run} - {own} < {goal} AND {run} - {goal} < {goal} - ({run} - {own}))" if k == PASSES - 1 else ""
    return f"({run} <= {goal}{near})"


def plan(sizes: DataFrame, seed: str) -> tuple[DataFrame, bool, int]:
    """What is to be done with each source, whether that table is small, and the number of bins: from a kept table of source, doc_id and size."""
    by, documents = levels(sizes)
    small = by.count() <= MOST_BROADCAST
    bins = max(BINS, 1 << (documents // DOCS_PER_BIN).bit_length())
    by = by.withColumnRenamed("goal", "goal0")
    rows = _ranked(_joined(sizes, by.select("m_source", "level"), F.col("source"), small), bins, seed).filter("q is not null").select("source", "size", "q", "bin", "rank")
    rows = keep(rows, "ranks")
    for k in range(PASSES):
        by = _pass(rows, by, k, small)
        tidy(sizes.sparkSession)
    return by, small, bins


def _copied(rows: DataFrame, by: DataFrame, small: bool, bins: int, seed: str) -> DataFrame:
    return _ranked(_joined(rows, by, F.col("source"), small), bins, seed).withColumn("copies", F.col("whole") + _taken(PASSES).cast("bigint"))


def mix(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """One row for each document: doc_id, size, source_size, target, taken and copies.

    ``taken`` is size times copies.  Random numbers are hashes of ``seed`` and doc_id, so reruns agree; equal
    ranks are in order of doc_id, null first, then size, and rows equal in both are drawn together.
    A document without words (null and empty texts) takes nothing; whole texts of any length count.  Null is a
    source of its own, the last.  Other columns of ``docs`` are ignored; an empty table gives an empty result.
    """
    sizes = keep(docs.select("doc_id", "source", n_words(docs["text"]).alias("size")), "sizes")
    rows = _copied(sizes, *plan(sizes, seed), seed)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """``docs``, with each row as often as :func:`mix` takes it; texts aren't shuffled.

    All columns stay, whatever their names; nulls, ties, repeated rows and empty tables as in :func:`mix`.
    """
    names = docs.columns
    by, small, bins = plan(keep(docs.select("doc_id", "source", n_words(docs["text"]).alias("size")), "sizes"), seed)
    own = free_name(docs)
    packed = docs.select(F.struct(*(docs[f"`{c}`"] for c in names)).alias(own), docs["source"].alias("source"), docs["doc_id"].alias("doc_id"), n_words(docs["text"]).alias("size"))
    rows = _copied(packed, by, small, bins, seed)
    # a filter of copies would be moved below the columns that it is made of, each then written out at every use
    some = F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies").cast("int")))
    rows = rows.select(own, F.explode_outer(some).alias("copy")).filter("copy is not null")
    return rows.select(*(F.col(own)[c].alias(c) for c in names))


def oracle() -> str:
    """The query in DuckDB's SQL, from the definition: levels by running sums over sizes, and passes over whole sources."""
    u = "((('0x' || substr(md5(concat_ws(':', 'mix', coalesce(doc_id::VARCHAR, ''))), 1, 12))::BIGINT)::DOUBLE + 0.5) / 281474976710656.0::DOUBLE"
    passes = ["p0 AS (SELECT *, false AS taken, goal AS lack FROM k)"]
    for k in range(PASSES):
        passes.append(f"a{k} AS (SELECT *, NOT taken AND q IS NOT NULL{' AND size <= lack' if k else ''} AS may FROM p{k})")
        passes.append(f"b{k} AS (SELECT *, sum(CASE WHEN may THEN size ELSE 0 END) OVER w AS run, sum(CASE WHEN may THEN size ELSE 0 END) OVER (PARTITION BY source, q, doc_id, size) AS own FROM a{k} WINDOW w AS (PARTITION BY source ORDER BY q NULLS LAST, doc_id NULLS FIRST, size))")
        passes.append(f"c{k} AS (SELECT * EXCLUDE (may, run, own), may AND {takes('run', 'own', 'lack', k)} AS now FROM b{k})")
        passes.append(f"p{k + 1} AS (SELECT * EXCLUDE (taken, lack, now), taken OR now AS taken, lack - sum(CASE WHEN now THEN size ELSE 0 END) OVER (PARTITION BY source) AS lack FROM c{k})")
    steps = ",\n".join(passes)
    return f"""
WITH s AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
g AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s GROUP BY source),
st AS (SELECT *, (3 * source_size)::DOUBLE / weight AS stop FROM g),
r AS (SELECT *, coalesce(sum(3 * source_size) OVER b, 0) AS stopped, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS rest, sum(source_size) OVER () AS total
  FROM st WINDOW b AS (ORDER BY stop, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (total - stopped)::DOUBLE / rest::DOUBLE AS level FROM r),
f AS (SELECT level FROM l WHERE stop >= level ORDER BY stop, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN l.stop <= f.level THEN (3 * source_size)::DOUBLE ELSE weight * f.level END AS target FROM l, f),
z AS (SELECT source, size, count(*) AS n, floor(16 * sqrt(size::DOUBLE) + 0.5)::BIGINT AS root FROM s WHERE size > 0 GROUP BY source, size),
y AS (SELECT *, (3 * size)::DOUBLE / root AS stop FROM z),
x AS (SELECT *, coalesce(sum(3 * size * n) OVER b, 0)::BIGINT AS stopped, (sum(n * root) OVER (PARTITION BY source) - coalesce(sum(n * root) OVER b, 0))::BIGINT AS rest
  FROM y WINDOW b AS (PARTITION BY source ORDER BY stop, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT x.source, stop, size, (target - stopped) / rest AS level FROM x JOIN t ON x.source IS NOT DISTINCT FROM t.source WHERE target < 3 * source_size),
m AS (SELECT source, level FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY stop, size) AS i FROM v WHERE stop >= level) WHERE i = 1),
e AS (SELECT s.doc_id, s.source, s.size, t.source_size, t.target, CASE WHEN s.size = 0 THEN 0 ELSE coalesce(least(3.0::DOUBLE, m.level * floor(16 * sqrt(s.size::DOUBLE) + 0.5) / s.size), 3.0::DOUBLE) END AS copies
  FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN m ON s.source IS NOT DISTINCT FROM m.source),
d AS (SELECT *, floor(copies)::BIGINT AS whole, copies - floor(copies) AS part, target - sum(floor(copies)::BIGINT * size) OVER (PARTITION BY source) AS goal, {u} AS u FROM e),
k AS (SELECT * EXCLUDE (part, u, copies), CASE WHEN size > 0 AND part > 0 THEN (u / (1 - u)) / (greatest(least(part, 1 - 1e-12::DOUBLE), 1e-12::DOUBLE) / (1 - greatest(least(part, 1 - 1e-12::DOUBLE), 1e-12::DOUBLE))) END AS q FROM d),
{steps}
SELECT doc_id, size, source_size, target, (size * (whole + taken::INT))::BIGINT AS taken, (whole + taken::INT)::BIGINT AS copies FROM p{PASSES}
"""
