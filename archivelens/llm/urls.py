"""Dated URL lists: each capture is judged by the entries that were active when it was fetched.

An entry adds or removes a pattern on a date.  The entries of a pattern, in order, become validity
intervals; a capture matches a pattern if its URL does and its fetch time lies in one of them.
Patterns are hosts (which cover their subdomains) or a host and the start of a path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A list of so many intervals at most is broadcast (its count is checked); a longer one is joined by salted keys.
MOST_BROADCAST = 100_000
SALTS = 16

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host(url: Column) -> Column:
    """The host of a URL in lower case; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, _HOST, 1), F.lit("")))


def patterns_of(url: Column, deepest: int | None = None) -> Column:
    """All patterns that cover a URL: its host, each parent domain, and its host with each start of the path, segment by segment.

    ``deepest``: the most parts, of hosts and paths, that any listed pattern has; longer ones can't be listed and aren't made, so a
    very long URL has no more patterns than a list can use.
    """
    h = host(url)
    labels = F.split(h, r"\.")
    least = F.lit(1) if deepest is None else F.greatest(F.lit(1), F.size(labels) - deepest + 1)
    domains = F.transform(F.sequence(least, F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    segments = F.filter(F.split(F.coalesce(F.regexp_extract(url, _PATH, 1), F.lit("")), "/"), lambda s: s != "")
    segments = segments if deepest is None else F.slice(segments, 1, deepest)
    paths = F.transform(segments, lambda s, i: F.concat(h, F.lit("/"), F.array_join(F.slice(segments, 1, i + 1), "/")))
    return F.when(h == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(domains, paths)))


def intervals(entries: DataFrame) -> DataFrame:
    """Intervals pattern, category, active_from, active_to (null: still active) from entries pattern, category, action, effective_on.

    Of a pattern's entries of one day the last by action counts, so "remove" wins over "add"; adding
    again what is active starts a new interval and ends the one before; repeated entries are one.
    """
    by = Window.partitionBy("pattern", "category").orderBy("effective_on")
    day = entries.filter("pattern is not null and effective_on is not null").groupBy("pattern", "category", "effective_on").agg(F.max("action").alias("action"))
    return day.withColumn("active_to", F.lead("effective_on").over(by)).filter("action = 'add'").select("pattern", "category", F.col("effective_on").alias("active_from"), "active_to")


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """One row for each capture (columns capture_id, url, fetched_on): capture_id, host, fetched_on, blocked,
    n_matches, and the longest matching pattern with its category and active_from.

    As-of join: equal patterns, and an interval that holds the fetch date (its first day, not its
    last).  Each pattern has one such interval at most for each category, so nothing multiplies.  Of
    equally long patterns the first category by name counts.  Captures without a URL, a host or a date match
    nothing, nor do very long URLs beyond what the list's patterns reach; captures of one id are one capture for
    each different URL and date; other columns are ignored, whatever their names; an empty list blocks nothing.
    """
    listed = intervals(entries)
    size = listed.agg(F.count("*").alias("n"), F.max(F.greatest(F.size(F.split("pattern", "/")), F.size(F.split("pattern", r"\.")))).alias("deepest")).first()
    keyed = captures.select("capture_id", "url", "fetched_on", F.explode(F.concat(F.array(F.lit(None).cast("string")), F.coalesce(patterns_of(F.col("url"), size["deepest"] or 1), F.array().cast("array<string>")))).alias("key"))
    if size["n"] <= MOST_BROADCAST:
        matched = keyed.join(F.broadcast(listed), _active(keyed, listed), "left")
    else:
        salted = keyed.withColumn("salt", F.pmod(F.xxhash64("capture_id"), F.lit(SALTS)).cast("int"))
        every = listed.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        matched = salted.join(every, _active(salted, every) & (salted["salt"] == every["salt_"]), "left")
    first = F.min(F.when(F.col("pattern").isNotNull(), F.struct((-F.length("pattern")).alias("n"), "pattern", "category", "active_from"))).alias("best")
    found = matched.groupBy("capture_id", "url", "fetched_on").agg(F.count("pattern").alias("n_matches"), first)
    return found.select("capture_id", host(F.col("url")).alias("host"), "fetched_on", (F.col("n_matches") > 0).alias("blocked"), "n_matches", F.col("best.pattern").alias("pattern"), F.col("best.category").alias("category"), F.col("best.active_from").alias("active_from"))


def _active(captures: DataFrame, listed: DataFrame) -> Column:
    return (captures["key"] == listed["pattern"]) & (captures["fetched_on"] >= listed["active_from"]) & (listed["active_to"].isNull() | (captures["fetched_on"] < listed["active_to"]))


def captures_of(pages: DataFrame) -> DataFrame:
    """The table ``pages`` as captures; it has no dates, so each page is given one of 2024 by its id."""
    return pages.select(F.col("page_id").alias("capture_id"), "url", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.coalesce("page_id", F.lit(0)) * 7, F.lit(366)).cast("int")).alias("fetched_on"))


def example_entries(pages: DataFrame) -> DataFrame:
    """A dated list about the hosts of ``pages``, by rule: the fixtures have none.

    By two digits of a hash of the host: a quarter of the hosts is listed on one day, a quarter is
    listed and removed later, a quarter is listed twice with a gap, the rest is not; hosts of one in
    five have their English pages listed as well.  The domain example.org is listed in December.
    """
    hosts = pages.select(host(F.col("url")).alias("h")).filter("h <> ''").distinct()
    digits = lambda at: F.conv(F.substring(F.md5(F.col("h").cast("binary")), at, 4), 16, 10).cast("int")
    n = hosts.withColumn("n", digits(1)).withColumn("m", digits(5) % 120)
    day = lambda offset: F.date_add(F.lit("2024-01-01").cast("date"), F.col("m") + offset)
    row = lambda pattern, category, action, on: F.struct(pattern.alias("pattern"), F.lit(category).alias("category"), F.lit(action).alias("action"), on.alias("effective_on"))
    own = F.col("h")
    listed = F.array(row(own, "spam", "add", day(0)))
    removed = F.concat(listed, F.array(row(own, "spam", "remove", day(90))))
    again = F.concat(removed, F.array(row(own, "spam", "add", day(180))))
    kind = F.col("n") % 4
    some = F.when(kind == 0, listed).when(kind == 1, removed).when(kind == 2, again).otherwise(F.slice(listed, 1, 0))
    paths = F.when(F.col("n") % 5 == 0, F.array(row(F.concat(own, F.lit("/en")), "adult", "add", day(60)))).otherwise(F.slice(listed, 1, 0))
    entries = n.select(F.explode(F.concat(some, paths)).alias("e")).select("e.*")
    domain = pages.sparkSession.range(1).select(row(F.lit("example.org"), "phishing", "add", F.lit("2024-12-01").cast("date")).alias("e")).select("e.*")
    return entries.unionByName(domain)


def oracle() -> str:
    """The query in DuckDB's SQL."""
    host_sql = "lower(coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), ''))"
    path_sql = "coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '')"
    day = "DATE '2024-01-01' + (m + {})::INT"
    return f"""
WITH c AS (SELECT page_id AS capture_id, url, DATE '2024-01-01' + ((page_id * 7) % 366)::INT AS fetched_on, {host_sql} AS host, {path_sql} AS path FROM pages),
h AS (SELECT DISTINCT host AS h FROM c WHERE host <> ''),
n AS (SELECT h, ('0x' || substr(md5(h), 1, 4))::INT AS n, ('0x' || substr(md5(h), 5, 4))::INT % 120 AS m FROM h),
e AS (SELECT h AS pattern, 'spam' AS category, 'add' AS action, {day.format(0)} AS effective_on FROM n WHERE n % 4 < 3
  UNION ALL SELECT h, 'spam', 'remove', {day.format(90)} FROM n WHERE n % 4 IN (1, 2)
  UNION ALL SELECT h, 'spam', 'add', {day.format(180)} FROM n WHERE n % 4 = 2
  UNION ALL SELECT h || '/en', 'adult', 'add', {day.format(60)} FROM n WHERE n % 5 = 0
  UNION ALL SELECT 'example.org', 'phishing', 'add', DATE '2024-12-01'),
d AS (SELECT pattern, category, effective_on, max(action) AS action FROM e GROUP BY ALL),
i AS (SELECT * FROM (SELECT *, lead(effective_on) OVER (PARTITION BY pattern, category ORDER BY effective_on) AS active_to FROM d) WHERE action = 'add'),
m AS (SELECT c.*, i.pattern, i.category, i.effective_on AS active_from FROM c JOIN i ON c.host <> '' AND c.fetched_on >= i.effective_on AND (i.active_to IS NULL OR c.fetched_on < i.active_to)
  AND (c.host = i.pattern OR ends_with(c.host, '.' || i.pattern) OR starts_with(rtrim(c.host || c.path, '/') || '/', i.pattern || '/') AND contains(i.pattern, '/'))),
b AS (SELECT *, row_number() OVER (PARTITION BY capture_id ORDER BY length(pattern) DESC, pattern, category, active_from) AS k, count(*) OVER (PARTITION BY capture_id) AS n_matches FROM m)
SELECT c.capture_id, c.host, c.fetched_on::VARCHAR AS fetched_on, b.pattern IS NOT NULL AS blocked, coalesce(b.n_matches, 0) AS n_matches, b.pattern, b.category, b.active_from::VARCHAR AS active_from
FROM c LEFT JOIN b ON b.capture_id = c.capture_id AND b.k = 1
"""
