"""Which version of a document counts (inventory P11-P20, F7, F8, H1, H2, J2, J6, J15, W2, W3)."""

from __future__ import annotations

from functools import reduce
from math import ceil, comb, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import blocks
from ..functions import frontmatter as FM
from ..functions import similarity as S
from ..functions import text as X
from .graphs import checkpointed, components

GROUP_SEGMENTS = 2
#: Segments with a number of submission, and segments that are categories.
SUBMISSIONS = [r"^submission_(\d+)$", r"^(\d+)(?:st|nd|rd|th)_submission$", r"^(\d+)(?:st|nd|rd|th)_sub$", r"^submission_v(\d+)$"]
CATEGORIES = [
    "report", "results?$", "acceptance$", "approval", "notice", "support", "budget$", "finance$", "application$", "notification", "agreement$", "declaration$", "planning$",
    "documentation$", "activity_lists?$", "supplementary$", "attachments", "confirmation", "submitted$", "final_submission$", "final_report", "mid-cycle_report",
    "submission_confirm", "press$", "promo$", "equipment",
]
#: Ends of file names and what they add to a version's score, by number where there is one; upper and lower case matter.
VERSION_ENDS = {
    "_final": 100, "_FINAL": 100, "_Final": 100, "_submitted": 90, "_SUBMITTED": 90, "_Submitted": 90, "_signed": 85, r"_v(\d+)": 10, r"_V(\d+)": 10, "_updated": 5, "_corrected": 5,
}
#: Ends of file names of drafts, and what they take off.
DRAFT_ENDS = {
    "_draft": -50, "_DRAFT": -50, "_prep": -50, "_PREP": -50, "_working": -50, "_WORKING": -50, "_todo": -50, "_ToDo": -50, "_notes": -30, "_Notes": -30,
    "_copy": -30, "_Copy": -30, "_edit": -30, "_EDIT": -30, "_blank": -30, "_short": -20, "_small": -20,
}
SCORES = {e: n for e, n in (VERSION_ENDS | DRAFT_ENDS).items() if "(" not in e}
NUMBERED = {e + "$": n for e, n in VERSION_ENDS.items() if "(" in e}
DRAFT_NAMES = r"(?i)_(?:draft|prep|working|todo)(?:_|\.)"
DRAFT_WORDS = ["draft", "work in progress", "not final", "pending review"]
MATCH_AT, DUPLICATE_AT, NAMES_AT = 0.45, 0.70, 0.25
MIN_LENGTH, COMPARED = 800, 2000
#: Texts are compared block against block, of about so many at most; fewer texts in all make so many blocks, of about LEAST_BLOCK at least.
BLOCK, BLOCKS, LEAST_BLOCK = 2000, 8, 250
#: Sets of names of so many words at most are met by their subsets; subsets with over one in HOT of all rows are sent to all.
SUBSETS_OF, HOT = 10, 2000
#: Between which ratios a model is asked, and how many characters of each file it sees.
DOUBT, ASKED = (0.25, 0.55), 800


def stem(filename: Column) -> Column:
    return F.regexp_replace(filename, r"(?<=.)\.[^.]*$", "")


def segments(filename: Column) -> Column:
    return F.filter(F.split(stem(filename), "__"), lambda s: F.trim(s, F.lit("_")) != "")


def score(filename: Column) -> Column:
    """How final a name sounds; every end that fits adds to it."""
    s = stem(filename)
    parts = [F.when(s.endswith(end), n).otherwise(0) for end, n in SCORES.items()]
    parts += [F.when(s.rlike(p), F.regexp_extract(s, p, 1).try_cast("int") * n).otherwise(0) for p, n in NUMBERED.items()]
    return sum(parts, F.lit(0))


def submission(segs: Column) -> Column:
    """The highest number of submission of any segment; null without one."""
    number = lambda s: F.greatest(*(F.regexp_extract(s, p, 1).try_cast("int") for p in SUBMISSIONS))
    return F.array_max(F.transform(segs, number))


def rest(segs: Column) -> Column:
    return F.slice(segs, GROUP_SEGMENTS + 1, F.greatest(F.size(segs), F.lit(1)))


def category(segs: Column) -> Column:
    """The first segment behind the group that is a category, or else the first."""
    known = F.filter(rest(segs), lambda s: s.rlike("(?i)^(?:" + "|".join(CATEGORIES) + ")"))
    return F.coalesce(F.get(known, 0), F.get(rest(segs), 0))


def identity(segs: Column) -> Column:
    """The segments behind the group that are no submission, or else the last segment."""
    own = F.filter(rest(segs), lambda s: X.all_of(~s.rlike(p) for p in SUBMISSIONS))
    return F.when(F.size(own) > 0, F.array_join(own, "__")).otherwise(F.coalesce(F.get(segs, F.size(segs) - 1), F.lit("")))


def app_key(segs: Column) -> Column:
    return F.when(F.size(segs) >= GROUP_SEGMENTS, F.array_join(F.slice(segs, 1, GROUP_SEGMENTS), "__")).otherwise(F.get(segs, 0))


def group_key(filename: Column) -> Column:
    """The key by which files are listed: of all parts, empty ones too, and the whole stem if they are few."""
    parts = F.split(stem(filename), "__")
    return F.when(F.size(parts) >= GROUP_SEGMENTS, F.array_join(F.slice(parts, 1, GROUP_SEGMENTS), "__")).otherwise(stem(filename))


def date_in(name: Column) -> Column:
    found = F.regexp_extract(name, r"\d{4}-\d{2}-\d{2}", 0)
    return F.when(found != "", found)


def comparable(t: Column) -> Column:
    """Lower case, one blank between words, no Markdown signs."""
    t = F.regexp_replace(F.lower(t), r"(?U)\s+", " ")
    t = F.regexp_replace(t, r"[*_`#>|\-\[\]()!]", " ")
    return X.strip(F.regexp_replace(t, r"(?U)\s+", " "))


def snippet(t: Column) -> Column:
    """What is compared of a text: without frontmatter, its first characters."""
    end = F.when(t.startswith("---"), F.locate("---", t, 4)).otherwise(0)
    return F.left(comparable(F.when(end > 0, t.substr(end + 3, F.length(t))).otherwise(t)), F.lit(COMPARED))


def name_tokens(name: Column) -> Column:
    return F.array_distinct(F.transform(F.filter(F.split(name, "_"), lambda t: F.length(t) > 2), lambda t: F.trim(F.lower(t), F.lit("_-"))))


def without_version(name: Column) -> Column:
    name = F.regexp_replace(name, r"(?i)_v\d+$", "")
    name = F.regexp_replace(name, r"_?(?:final|FINAL|Final)$", "")
    name = F.regexp_replace(name, r"_(?:updated|corrected|submitted|SUBMITTED|signed|copy|Copy|edit|EDIT|draft|DRAFT|prep|PREP|working|WORKING|todo|ToDo|notes|Notes|blank|short|small)$", "")
    return F.trim(F.regexp_replace(name, r"^\d{4}-\d{2}-\d{2}_", ""), F.lit("_"))


def is_draft(filename: Column, content: Column) -> Column:
    """A draft by its name, by the end of its stem, or by a word among its first 500 characters."""
    s = stem(filename)
    head = F.lower(F.left(content, F.lit(500)))
    return filename.rlike(DRAFT_NAMES) | X.any_of(s.endswith(e) for e, n in SCORES.items() if n < 0) | X.any_of(F.contains(head, F.lit(w)) for w in DRAFT_WORDS)


def is_webpage(filename: Column, content: Column) -> Column:
    return filename.endswith("__webpage.md") | F.coalesce(FM.field(FM.block(content), "type") == "webpage", F.lit(False))


def parsed(files: DataFrame) -> DataFrame:
    """Files (filename, content) with what their names tell."""
    segs = segments(F.col("filename"))
    return files.withColumn("segments", segs).withColumns({
        "app_key": app_key(F.col("segments")), "submission_number": submission(rest(F.col("segments"))), "category": category(F.col("segments")),
        "version_score": score(F.col("filename")), "doc_identity": identity(F.col("segments")), "date_str": date_in(stem(F.col("filename"))),
    })


def _name_sets(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files with their words, and the sets of words: tokens, k (the first name), members, n and g."""
    named = files.select("filename", name_tokens(stem(F.col("filename"))).alias("tokens")).filter(F.size("tokens") > 0)
    by = named.groupBy(F.array_sort("tokens").alias("tokens")).agg(F.min("filename").alias("k"), F.count("*").alias("members"))
    return named, checkpointed(by.withColumns({"n": F.size("tokens"), "g": F.monotonically_increasing_id()}))


def _met(sets: DataFrame, least: float, longer: int = 0) -> DataFrame:
    """g < g2 of sets that share a word of their prefixes and have sizes that allow ``least``, the larger over ``longer`` words."""
    rows = sets.select("g", "n", F.explode("tokens").alias("t"))
    seen = rows.groupBy("t").agg(F.count("*").alias("df"))
    ranked = rows.join(seen, "t").groupBy("g", "n").agg(F.array_sort(F.collect_list(F.struct("df", "t"))).alias("r"))
    prefix = ranked.select("g", "n", F.explode(F.slice("r", 1, F.col("n") - F.ceil(F.col("n") * least).cast("int") + 1)).alias("r")).select("g", "n", F.col("r.t").alias("t"))
    # numbers meet, and only their sizes; words are fetched for those that may be alike
    other = prefix.select(F.col("g").alias("g2"), F.col("n").alias("n2"), "t")
    if longer:
        large = prefix.filter(F.col("n") > longer)
        met = large.join(other, "t").filter((F.col("n2") <= longer) | (F.col("g") < F.col("g2")))
    else:
        met = prefix.join(other, "t").filter(F.col("g") < F.col("g2"))
    return met.filter(F.least("n", "n2") >= least * F.greatest("n", "n2")).select("g", "g2").distinct()


def _name_links(files: DataFrame, least: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Files with their words, links between different sets of words (k, k2, ta, tb, name_similarity), and the sets."""
    named, sets = _name_sets(files)
    left, right = sets.select("g", F.col("k").alias("x"), F.col("tokens").alias("tx")), sets.select(F.col("g").alias("g2"), F.col("k").alias("y"), F.col("tokens").alias("ty"))
    both = _met(sets, least).join(left, "g").join(right, "g2").withColumn("name_similarity", S.jaccard(F.col("tx"), F.col("ty"))).filter(F.col("name_similarity") >= least)
    first = F.col("x") < F.col("y")
    alike = both.select(F.least("x", "y").alias("k"), F.greatest("x", "y").alias("k2"), F.when(first, F.col("tx")).otherwise(F.col("ty")).alias("ta"), F.when(first, F.col("ty")).otherwise(F.col("tx")).alias("tb"), "name_similarity")
    return named, alike, sets


def shared_words(n: int, m: int, least: float) -> int:
    """How many words two sets of so many must share to be as alike as ``least``; more than either has, where they can't be."""
    return next((i for i in range(1, min(n, m) + 1) if i / (n + m - i) >= least), min(n, m) + 1)


def name_classes(files: DataFrame, least: float = NAMES_AT) -> DataFrame:
    """filename, first, cluster and links of every file: the least name with the same set of words, the least of all that are
    connected with it by alike names, and how many other files' names are as alike as ``least``.

    Pairs are never listed. Sets of n and m words are alike if they share a subset of r words (:func:`shared_words`). Subsets are
    keyed by 128-bit sums (exclusive or) of their words' hashes. How many sets of m words share at least r with one is, by inclusion and
    exclusion, the sum over its subsets of k >= r words of (-1)^(k - r) * C(k - 1, r - 1) times the other sets of m
    words that have it. In a subset all that are linked there are linked to its smallest set, so one link for each keeps
    classes whole. Both grow with the files. Sets of over :data:`SUBSETS_OF` words, which have too many subsets, are
    met by :func:`_met`. A name without words is a class of its own.
    """
    named, sets = _name_sets(files)
    short = sets.filter(F.col("n") <= SUBSETS_OF)
    sizes = range(1, SUBSETS_OF + 1)
    fewest = {n: min(shared_words(n, m, least) for m in sizes) for n in sizes}
    side = SUBSETS_OF + 1
    needs = [shared_words(n, m, least) if n and m else side for n in range(side) for m in range(side)]
    terms = [(-1) ** (k - r) * comb(k - 1, r - 1) if r <= k <= min(i // side, i % side) else 0 for i, r in enumerate(needs) for k in range(side)]
    # of n and m words: how many must be shared; of n, m and k: what a set of m words in a subset of k counts
    need, term = (lambda *at, t=t: F.get(F.expr(f"array({', '.join(map(str, t))})"), reduce(lambda i, x: i * side + x, at)) for t in (needs, terms))
    word = F.transform("tokens", lambda t: F.struct(F.xxhash64(t).alias("a"), F.xxhash64(F.lit(1), t).alias("b"), F.lit(1).alias("k")))
    none = F.array(F.struct(F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"), F.lit(0).alias("k")))
    grown = F.aggregate(word, none, lambda acc, t: F.concat(acc, F.transform(acc, lambda x: F.struct(x["a"].bitwiseXOR(t["a"]).alias("a"), x["b"].bitwiseXOR(t["b"]).alias("b"), (x["k"] + 1).alias("k")))))
    enough = F.get(F.expr(f"array(0, {', '.join(str(fewest[n]) for n in sizes)})"), F.col("n"))
    rows = short.select("g", "n", "members", F.explode(F.filter(grown, lambda x: x["k"] >= enough)).alias("u")).select("g", "n", "members", "u.*")
    counts = rows.groupBy("a", "b", "k", "n").agg(F.sum("members").alias("members"), F.count("*").alias("sets"), F.min("g").alias("g"))
    by = counts.groupBy("a", "b", "k").agg(F.collect_list(F.struct("n", "members", "g")).alias("of"), F.sum("sets").alias("sets")).filter("sets > 1")
    by = by.select("a", "b", "k", "sets", F.array_min("of").alias("pivot"), "of")
    value = lambda n: F.aggregate("of", F.lit(0).cast("bigint"), lambda acc, o: acc + o["members"] * term(n, o["n"], F.col("k")))
    by = checkpointed(by.select("a", "b", "k", "sets", "pivot", F.explode(F.transform("of", lambda o: F.struct(o["n"].alias("n"), value(o["n"]).alias("value")))).alias("v")).select("a", "b", "k", "sets", F.col("pivot.n").alias("pn"), F.col("pivot.g").alias("pg"), "v.*"))
    # subsets that very many sets have are few, and are sent to all
    at = ["a", "b", "k", "n"]
    limit = max(HOT, by.filter("sets > 1").agg(F.sum("sets")).first()[0] or 0) // HOT
    hot, cold = by.filter(F.col("sets") > limit), by.filter(F.col("sets") <= limit)
    often = rows.join(F.broadcast(hot), at)
    rare = rows.join(F.broadcast(hot.select(*at)), at, "left_anti").join(cold, at)
    own = term(F.col("n"), F.col("n"), F.col("k"))
    reach = need(F.col("pn"), F.col("n")) <= F.col("k")
    met = often.unionByName(rare).groupBy("g").agg(F.sum(F.col("value") - own * F.col("members")).alias("links"), F.collect_set(F.when(reach, F.col("pg"))).alias("pivots"))
    met = checkpointed(met)
    links, edges = met.select("g", "links"), met.select(F.explode("pivots").alias("b"), F.array_min("pivots").alias("least"), "g")
    # what a set's pivots are linked by is the least of them
    edges = edges.select(F.col("least").alias("a"), "b").union(edges.select(F.col("least").alias("a"), F.col("g").alias("b")))
    if not sets.filter(F.col("n") > SUBSETS_OF).isEmpty():
        words = lambda g: sets.select(F.col("g").alias(g), F.col("tokens").alias("t" + g), F.col("members").alias("w" + g))
        long = _met(sets, least, SUBSETS_OF).join(words("g"), "g").join(words("g2"), "g2").filter(S.jaccard(F.col("tg"), F.col("tg2")) >= least)
        long = checkpointed(long.select("g", "g2", "wg", "wg2"))
        links = links.union(long.select("g", "wg2")).union(long.select("g2", "wg"))
        edges = edges.union(long.select("g", "g2"))
    links = links.groupBy("g").agg(F.sum("links").alias("links"))
    linked = edges.filter("a <> b").distinct()
    comp = components(linked).withColumnRenamed("node", "g")
    found = sets.join(links, "g", "left").join(comp, "g", "left").select("tokens", "k", F.coalesce("cluster", "g").alias("c"), (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("links"))
    heads = found.groupBy("c").agg(F.min("k").alias("cluster"))
    found = found.join(heads, "c").select("tokens", F.col("k").alias("first"), "cluster", "links")
    every = files.select("filename", F.array_sort(name_tokens(stem(F.col("filename")))).alias("tokens"))
    out = every.join(found, "tokens", "left")
    return out.select("filename", F.coalesce("first", "filename").alias("first"), F.coalesce("cluster", "filename").alias("cluster"), F.coalesce("links", F.lit(0).cast("bigint")).alias("links"))


def name_links(files: DataFrame, least: float = NAMES_AT) -> DataFrame:
    """Pairs a < b of file names, each the first of those with its set of words, that are as alike as ``least``, with their similarity.

    With :func:`name_members` they say all that :func:`name_pairs` does, without listing files of equal sets by pairs.
    """
    return _name_links(files, least)[1].select(F.col("k").alias("a"), F.col("k2").alias("b"), "name_similarity")


def name_members(files: DataFrame) -> DataFrame:
    """filename, first (the least name with the same set of words) and members (how many have that set), of names with a word."""
    named = files.select("filename", F.array_sort(name_tokens(stem(F.col("filename")))).alias("t")).filter(F.size("t") > 0)
    by = named.groupBy("t").agg(F.min("filename").alias("first"), F.count("*").alias("members"))
    return named.join(by, "t").select("filename", "first", "members")


def name_pairs(files: DataFrame, least: float = NAMES_AT) -> DataFrame:
    """Pairs a < b of file names that are as alike as ``least``, with their similarity.

    Names must share a word, so pairs come from a join on words.  Names with the same words are
    grouped first, and the words' sets are paired, the rarest words of each as its prefix: two sets of a
    similarity of t share one of the first n - ceil(t * n) + 1 of their n words in order of rarity.
    """
    named, alike, sets = _name_links(files, least)
    linked = alike.select("ta", "tb", "name_similarity").union(sets.select("tokens", "tokens", F.lit(1.0)))
    keyed = named.select("filename", F.array_sort("tokens").alias("s"))
    a, b = keyed.select(F.col("filename").alias("x"), F.col("s").alias("ta")), keyed.select(F.col("filename").alias("y"), F.col("s").alias("tb"))
    pairs = linked.join(a, "ta").join(b, "tb").filter("x <> y")
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "name_similarity").distinct()


def block_count(n: int, total: int) -> int:
    """Into how many blocks ``n`` of ``total`` texts go: each pair of blocks is one task, and few large ones would leave most cores idle."""
    return ceil(n / min(BLOCK, max(LEAST_BLOCK, ceil(total / BLOCKS))))


def _may_match(held: DataFrame, least: float, names: float) -> DataFrame:
    """a < b of files (filename, t, s, n) with alike names whose texts may have a ratio of ``least``; no pair that has it is missing.

    Texts meet block against block, in blocks by length, as lengths of under least / (2 - least) of each other can't have the ratio.
    """
    step = log((2 - least) / least) if least < 1 else 1e-9
    d = held.withColumn("class", F.floor(F.log(F.col("n").cast("double")) / step).cast("int"))
    counts = {r["class"]: r["count"] for r in d.groupBy("class").count().collect()}  # as many as lengths up to COMPARED have classes
    if not counts:
        return held.select(F.col("filename").alias("a"), F.col("filename").alias("b")).limit(0)
    parts = {c: block_count(n, sum(counts.values())) for c, n in counts.items()}
    first, blocks_ = {}, 0
    for c in sorted(parts):
        first[c], blocks_ = blocks_, blocks_ + parts[c]
    # classes on end meet, and those two apart where a rounded logarithm may have put a length one too high or low
    near = {c: [x for x in parts if abs(x - c) <= 2] for c in parts}
    at = F.create_map(*(F.lit(v) for c in parts for v in (c, first[c])))
    count = F.create_map(*(F.lit(v) for c in parts for v in (c, parts[c])))
    low = F.create_map(*(F.lit(v) for c in parts for v in (c, min(first[x] for x in near[c]))))
    high = F.create_map(*(F.lit(v) for c in parts for v in (c, max(first[x] + parts[x] for x in near[c]) - 1)))
    d = d.withColumn("block", (at[F.col("class")] + F.pmod(F.xxhash64("filename", "t"), count[F.col("class")])).cast("int"))
    d = d.withColumn("other", F.explode(F.sequence(low[F.col("class")], high[F.col("class")])))
    d = d.select("filename", "t", "s", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    met = sum(parts[c] * sum(parts[x] for x in near[c]) for c in parts) // 2 + blocks_
    # pairs of blocks are dealt by hash; so many parts that few hold two
    return d.repartition(max(3 * met, 1), "i", "j").groupBy("i", "j").applyInArrow(blocks.may_match(least, names), blocks.FOUND).distinct()


def duplicate_pairs(files: DataFrame, least: float = DUPLICATE_AT, names: float = NAMES_AT) -> DataFrame:
    """Pairs of files with alike names whose compared texts have a ratio of ``least``: a, b, name_similarity, similarity.

    All pairs of alike names are compared, block against block: lengths, the longest common runs (:mod:`..functions.blocks`) and
    longest common subsequences bound the ratio from above, so most need no comparison of blocks.  Files of one text and one set of name words are one, and are paired with the first of them.
    Names of one text that are linked, also over others, form a group; of the alike pairs between two groups, only the
    first of either order is compared, which links as much.
    """
    texts = files.select("filename", F.left(comparable(F.col("content")), F.lit(COMPARED)).alias("t")).filter("t <> ''")
    texts = texts.withColumn("s", F.array_sort(name_tokens(stem(F.col("filename"))))).filter(F.size("s") > 0)
    texts = checkpointed(texts.withColumn("first", F.min("filename").over(Window.partitionBy("t", "s"))))
    copies = texts.filter("filename <> first").select(F.col("first").alias("a"), F.col("filename").alias("b"), F.lit(1.0).alias("name_similarity"), F.lit(1.0).alias("similarity"))
    held = texts.filter("filename = first").select("filename", "t", "s", F.xxhash64("t").alias("h"), F.length("t").alias("n"))
    may = checkpointed(_may_match(held, least, names))
    a, b = (held.select(F.col("filename").alias(x), F.col("h").alias(f"h{x}"), F.col("n").alias(f"n{x}"), F.col("s").alias(f"s{x}")) for x in "ab")
    both = may.join(a, "a").join(b, "b").filter(2.0 * F.least("na", "nb") / (F.col("na") + F.col("nb")) >= least)
    both = checkpointed(both.withColumn("name_similarity", S.jaccard(F.col("sa"), F.col("sb"))).drop("sa", "sb"))
    same = both.filter("ha = hb").select("a", "b", "name_similarity", F.lit(1.0).alias("similarity"))
    groups = checkpointed(clusters(same).select("filename", "cluster"))
    ga, gb = groups.select(F.col("filename").alias("a"), F.col("cluster").alias("ga")), groups.select(F.col("filename").alias("b"), F.col("cluster").alias("gb"))
    near = both.filter("ha <> hb").join(ga, "a", "left").join(gb, "b", "left")
    one = near.groupBy(F.coalesce("ga", "a").alias("ga"), F.coalesce("gb", "b").alias("gb")).agg(F.min(F.struct("a", "b", "name_similarity")).alias("x")).select("ga", "gb", "x.*")
    ta, tb = held.select(F.col("filename").alias("a"), F.col("t").alias("ta")), held.select(F.col("filename").alias("b"), F.col("t").alias("tb"))
    found = one.join(ta, "a").join(tb, "b").repartition("a", "b").withColumn("similarity", S.ratio_from(F.col("ta"), F.col("tb"), least)).filter(F.col("similarity") >= least)
    first = found.groupBy(F.least("ga", "gb"), F.greatest("ga", "gb")).agg(F.min(F.struct("a", "b", "name_similarity", "similarity")).alias("x")).select("x.*")
    return first.unionByName(same).unionByName(copies)


def exact_duplicates(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows whose text others have as well: key, first (the least key of those), copies."""
    by = docs.groupBy(F.sha2(text, 256).alias("h")).agg(F.min(key).alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    return docs.select(key, F.sha2(text, 256).alias("h")).join(by, "h").drop("h")


def clusters(pairs: DataFrame) -> DataFrame:
    return components(pairs).withColumnRenamed("node", "filename")


def pick_best(rows: DataFrame) -> DataFrame:
    """Rows (filename, cluster, version_score, date_str, length) with ``best``: highest score, then date, then length, then least name."""
    order = Window.partitionBy("cluster").orderBy(F.desc("version_score"), F.coalesce("date_str", F.lit("")).desc(), F.desc("length"), "filename")
    return rows.withColumn("best", F.row_number().over(order) == 1)


def alike_submissions(subs: DataFrame, least: float = MATCH_AT) -> DataFrame:
    """Pairs of a lower and a higher submission of one application whose names or texts are as alike as ``least``.

    ``subs``: filename, app_key, submission_number, snippet, bare.  Columns: low, high, high_number, similarity, the
    higher of the names' and the texts' similarity.  Texts are compared in Arrow batches, where their lengths allow ``least``.
    """
    rows = subs.withColumn("tokens", name_tokens(F.col("bare")))
    low = rows.select("app_key", F.col("filename").alias("low"), F.col("submission_number").alias("low_number"), F.col("snippet").alias("x"), F.col("tokens").alias("tx"))
    high = rows.filter("snippet <> ''").select("app_key", F.col("filename").alias("high"), F.col("submission_number").alias("high_number"), F.col("snippet").alias("y"), F.col("tokens").alias("ty"))
    both = low.join(high, "app_key").filter("low_number < high_number").withColumn("names", S.jaccard(F.col("tx"), F.col("ty")))
    n, m = F.length("x"), F.length("y")
    may = (n > 0) & (2.0 * F.least(n, m) / F.greatest(n + m, F.lit(1)) >= least)
    both = both.withColumns({"x": F.when(may, F.col("x")), "y": F.when(may, F.col("y"))}).filter((F.col("names") >= least) | may)
    # dealt evenly, as an application may have very many pairs
    texts = both.select("low", "high", "high_number", "names", "x", "y").repartition("low", "high").withColumn("texts", S.ratio_from(F.col("x"), F.col("y"), least))
    return texts.withColumn("similarity", F.greatest("names", F.coalesce("texts", F.lit(0.0)))).filter(F.col("similarity") >= least).select("low", "high", "high_number", "similarity")


def settled(subs: DataFrame) -> DataFrame:
    """filename, canonical and reason of each submission (filename, app_key, submission_number, snippet, bare).

    A last submission without a text of MIN_LENGTH is taken for broken.  A submission below the highest
    whole one is superseded by the most alike file of a higher one, unless that was itself superseded and comes before it
    by name.  Files only ever depend on higher submissions, so the levels are settled from the top, one round for each.
    """
    app = Window.partitionBy("app_key")
    whole = F.length("snippet") >= MIN_LENGTH
    d = subs.withColumns({"last": F.max("submission_number").over(app), "top": F.max(F.when(whole, F.col("submission_number"))).over(app), "level": F.dense_rank().over(app.orderBy(F.desc("submission_number")))})
    d = d.withColumn("broken", (F.col("submission_number") == F.col("last")) & ~F.coalesce(F.col("top") == F.col("last"), F.lit(False)))
    d = checkpointed(d.withColumn("top", F.coalesce("top", "last")))
    live = d.filter("not broken")
    open_ = live.filter("submission_number < top").select(F.col("filename").alias("low"), "level")
    pairs = checkpointed(alike_submissions(live.select(subs.columns)).join(open_, "low"))
    levels = [r["level"] for r in pairs.select("level").distinct().orderBy("level").collect()]  # as many as one application has submissions
    gone = d.sparkSession.createDataFrame([], "low string, number int, similarity double")
    for level in levels:
        before = gone.select(F.col("low").alias("high"))
        own = pairs.filter(F.col("level") == level)
        stays = own.join(before.filter("high is not null"), (own["high"] == before["high"]) & (own["high"] < own["low"]), "left_anti")
        best = stays.groupBy("low").agg(F.min(F.struct((-F.col("similarity")).alias("s"), F.col("high_number").alias("n"))).alias("b"))
        gone = checkpointed(gone.union(best.select("low", F.col("b.n").cast("int"), -F.col("b.s"))))
    out = d.join(gone, d["filename"] == gone["low"], "left")
    superseded = F.concat(F.lit("superseded by submission_"), F.col("number").cast("string"), F.format_string(" (content sim=%.2f)", F.col("similarity")))
    broken = F.concat(F.lit("submission_"), F.col("last").cast("string"), F.lit(" file too small ("), F.length("snippet").cast("string"), F.lit(" chars), likely corrupted"))
    reason = F.when(F.col("broken"), broken).when(F.col("low").isNotNull(), superseded).when(F.col("submission_number") < F.col("top"), "unique doc not in later submission")
    return out.select("filename", (~F.col("broken") & F.col("low").isNull()).alias("canonical"), reason.alias("reason"))


def doubtful_pairs(subs: DataFrame) -> DataFrame:
    """low, high, app_key, last and similarity of pairs of a lower and a last submission that a ratio can't tell apart."""
    app = Window.partitionBy("app_key")
    rows = subs.filter("snippet <> ''").withColumn("last", F.max("submission_number").over(app))
    low = rows.filter("submission_number < last").select("app_key", "last", F.col("filename").alias("low"), F.col("snippet").alias("x"))
    high = rows.filter("submission_number = last").select("app_key", F.col("filename").alias("high"), F.col("snippet").alias("y"))
    n, m = F.length("x"), F.length("y")
    both = low.join(high, "app_key").filter(2.0 * F.least(n, m) / (n + m) >= DOUBT[0]).repartition("low", "high")
    return both.withColumn("similarity", S.ratio_from(F.col("x"), F.col("y"), DOUBT[0])).filter(F.col("similarity").between(*DOUBT))


def resolve_doubtful(subs: DataFrame, make) -> DataFrame:
    """filename and reason of lower submissions that a model holds for the same as one of the last (inventory J16).

    Each pair is a prompt of its own, so an answer is about just one pair; an answer that can't be read changes nothing.
    """
    from ..sources.providers import answers

    shown = lambda name, text: F.concat_ws("\n", F.concat(F.lit("File "), F.col(name)), F.left(F.col(text), F.lit(ASKED)))
    head = F.lit('Are these two files the same document, perhaps edited? Answer as JSON: {"same": true} or {"same": false}.')
    asked = doubtful_pairs(subs).select("low", "last", F.concat_ws("\n\n", head, shown("low", "x"), shown("high", "y")).alias("prompt"))
    said = F.from_json(F.regexp_extract("answer", r"(?s)\{.*?\}", 0), "same boolean")["same"]
    same = answers(asked, make).filter(F.coalesce(said, F.lit(False)))
    return same.groupBy(F.col("low").alias("filename")).agg(F.concat(F.lit("superseded by submission_"), F.max("last").cast("string"), F.lit(" (LLM confirmed match)")).alias("reason"))


def canonicalize(files: DataFrame, model=None) -> DataFrame:
    """filename, status (webpage, draft, superseded, duplicate or canonical), reason, app_key, version_score.

    Webpages stand apart; drafts go; of submissions of an application the last ones count; of near duplicates
    the best version.  With ``model``, which makes a language model, it decides where submissions are neither alike nor unlike.
    """
    d = parsed(files.select("filename", "content")).withColumns({"webpage": is_webpage(F.col("filename"), F.col("content")), "draft": is_draft(F.col("filename"), F.col("content"))})
    d = checkpointed(d)
    live = d.filter("not webpage and not draft")
    subs = live.filter("submission_number is not null").select("filename", "app_key", "submission_number", snippet(F.col("content")).alias("snippet"), without_version(F.col("doc_identity")).alias("bare"))
    judged = settled(subs)
    if model is not None:
        kept = judged.filter("canonical").select("filename").join(subs, "filename")
        told = resolve_doubtful(kept, model).select("filename", F.col("reason").alias("told"))
        judged = judged.join(told, "filename", "left").select("filename", (F.col("canonical") & F.col("told").isNull()).alias("canonical"), F.coalesce("told", "reason").alias("reason"))
    judged = checkpointed(judged)
    stays = live.join(judged.filter("not canonical").select("filename"), "filename", "left_anti")
    pairs = duplicate_pairs(stays)
    ranked = pick_best(clusters(pairs).join(stays.select("filename", "version_score", "date_str", F.lit(0).alias("length")), "filename"))
    out = d.join(judged, "filename", "left").join(ranked.select("filename", "best"), "filename", "left")
    status = F.when(F.col("webpage"), "webpage").when(F.col("draft"), "draft").when(~F.col("canonical"), "superseded").when(~F.col("best"), "duplicate").otherwise("canonical")
    reason = F.when(F.col("webpage") | F.col("draft"), F.lit("")).when(~F.col("best"), "duplicate; kept version with higher score").otherwise(F.coalesce("reason", F.when(F.col("submission_number").isNull(), "non-submission category").otherwise("")))
    return out.select("filename", status.alias("status"), reason.alias("reason"), "app_key", "version_score")
