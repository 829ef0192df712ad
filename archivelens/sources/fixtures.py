"""Markdown archives derived from the table ``documents``, as SQL that Spark and DuckDB both run.

The table holds plain prose.  The view puts each whole text into a Markdown document with a file name,
frontmatter, headings, links and the kinds of noise that the operators look for, all chosen by
doc_id.  One template gives both engines their SQL, so a query and its oracle see equal input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FUNDERS = {"OAC": "Ontario Arts Council", "TAC": "Toronto Arts Council", "CCA": "Canada Council for the Arts", "OTF": "Ontario Trillium Foundation"}
KINDS = ["application", "report", "budget", "notification", "activity_list", "staff_board"]
DENYLIST = ["Jane Doe", "John Q. Public"]

_N = "chr(10)"


def _when(step: int, rest: int, value: str, other: str = "''") -> str:
    return f"CASE WHEN doc_id % {step} = {rest} THEN {value} ELSE {other} END"


def _pick(step: int, values: list[str]) -> str:
    return f"CASE doc_id % {step} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + f" ELSE '{values[-1]}' END"


def _lines(*parts: str) -> str:
    return f" || {_N} || ".join(parts)


_ID = "CAST(doc_id AS STRING)"

_NAMES = f"""
SELECT doc_id, text, source, lang,
  {_pick(4, list(FUNDERS))} AS funder_code,
  CAST(2018 + doc_id % 7 AS STRING) AS year_code,
  {_pick(6, KINDS)} AS kind,
  {_pick(6, ["Application", "Report", "Budget", "Notification", "Activities", "Board"])} AS kind_dir,
  {_pick(7, ["", "_final", "_draft", "_v2", "_v3", "_copy", "_signed"])} AS suffix,
  CASE WHEN doc_id % 5 IN (1, 2, 3) THEN 'submission_' || CAST(doc_id % 5 AS STRING) || '__' WHEN doc_id % 5 = 4 THEN 'supplementary__' ELSE '' END AS submission,
  CAST(CAST(floor(doc_id / 200) AS BIGINT) AS STRING) AS program,
  CASE WHEN doc_id % 41 = 0 THEN '555-010-' || lpad(CAST(doc_id % 10000 AS STRING), 4, '0')
    WHEN doc_id % 25 = 0 THEN 'Doc_' || CAST(doc_id + 1 AS STRING) ELSE 'doc-' || {_ID} END AS article
FROM documents"""

_FRONT = _lines(
    "'---'",
    f"'funder: ' || {_when(19, 0, chr(39) + 'XYZ' + chr(39), 'funder_code')}",
    f"'type: ' || {_when(23, 0, chr(39) + 'support materials' + chr(39), 'kind')}",
    f"{_when(17, 0, chr(39) + 'period_start: 2021-04-01' + chr(39), _when(31, 0, chr(39) + 'year_written: ' + chr(39) + ' || year_code', chr(39) + 'written: ' + chr(39) + ' || year_code'))}",
    f"'period: ' || {_when(3, 0, chr(39) + 'from 2019 to 2021' + chr(39), 'year_code')}",
    f"'priority: ' || {_when(29, 0, chr(39) + '7' + chr(39), 'CAST(1 + doc_id % 3 AS STRING)')}",
    f"'confidence: ' || {_when(20, 0, chr(39) + 'low' + chr(39), chr(39) + 'high' + chr(39))}",
    f"'sources: ' || {_when(18, 0, chr(39) + '[]' + chr(39), chr(39) + '[a.pdf, b.pdf]' + chr(39))}",
    f"'aliases: [Alias ' || {_ID} || ']'",
    "'---'",
    "''",
    "''",
)

_FIGURES = f"""CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 7 = 1 THEN 'No data available.' WHEN doc_id % 7 = 2 THEN 'There is no specific figure.' || {_N} || {_N} || 'No data.'
  ELSE 'Attendance was ' || CAST(doc_id % 500 AS STRING) || ' people in ' || year_code || '.' END"""

_NOISE = " || ".join(
    f"CASE WHEN doc_id % {step} = {rest} THEN {_N} || {value} || {_N} ELSE '' END"
    for step, rest, value in [
        (3, 0, "'12'"),
        (5, 0, "'q'"),
        (6, 0, f"'**Program Summary**' || {_N}"),
        (8, 0, f"'## Writing tip: keep it short' || {_N} || 'Writing tip: use plain words'"),
        (9, 0, "'What is the goal? The goal is to reach a wide audience in the whole region'"),
        (10, 0, f"'[x] Confirmed by staff' || {_N} || '[ ] Approved' || {_N} || 'Total Files: 3'"),
        (12, 0, "'Season 2019&#8211;2020 and &#x41;ugust overview, 250 words'"),
        (15, 0, f"'## FINANCIAL SUMMARY OF THE YEAR' || {_N}"),
        (21, 0, f"'## Costs (in dollars)' || {_N} || 'The grant was $12,500 in total.'"),
        (18, 0, f"'Address:' || {_N} || '123-456 789' || {_N} || 'Email:' || {_N} || 'someone@example.org'"),
        (22, 0, f"'| Item | Cost |' || {_N} || '| --- | --- |' || {_N} || '| Hall | ' || {_ID} || ' |' || {_N} || '| Staff | A1A 1A1 |'"),
        (26, 0, "'Number 123-45-6789 on file.'"),
        (27, 0, "'Sent to 12345-6789 by mail.'"),
        (28, 0, "'Signed by Jane Doe.'"),
        (11, 5, "'<!-- image -->' || chr(10) || '[IMAGE]' || chr(10) || chr(10) || chr(10) || 'Two  spaces' || chr(9) || 'and a tab.'"),
        (14, 0, "'TBD: [TODO] ask ??? about it. There is no source data for this.'"),
        (15, 1, "'It is possibly the case, and may have been so today.'"),
        (4, 1, "'See [[doc-' || CAST(doc_id + 1 AS STRING) || ']] and [site](http://example.org/' || CAST(doc_id AS STRING) || ').'"),
        (4, 0, "'See [[Missing ' || CAST(doc_id AS STRING) || '|a page]] and [[missing-x]] and ![pic](p' || CAST(doc_id % 9 AS STRING) || '.png).'"),
        (30, 7, "'A stray [abc.def token.'"),
        (16, 0, "'The list is pending retrieval of the records'"),
    ]
)

_BODY = _lines(
    f"'# Document ' || {_ID}",
    "''",
    "'## Body'",
    "''",
    f"replace(coalesce(text, ''), '. ', '.' || {_N})",
    "''",
    "'## Key Figures'",
    _FIGURES,
    "''",
    f"{_when(13, 1, chr(39) + '## Body' + chr(39), chr(39) + '## See also' + chr(39))}",
    _NOISE,
)

_FILES = f"""
SELECT doc_id, source, lang, article, kind, funder_code, year_code,
  funder_code || '__' || year_code || '_Program' || program || '__' || submission || kind || suffix || CASE WHEN doc_id % 13 = 0 THEN '__webpage' ELSE '' END || '.md' AS filename,
  'archive/' || coalesce(source, 'none') || '/' || {_when(9, 0, "''", "year_code || '/'")} || {_when(8, 0, "''", "kind_dir || '/'")} AS folder,
  {_when(11, 0, "''", _FRONT)} AS front, {_BODY} AS body
FROM ({_NAMES}) AS names"""

#: Columns doc_id, source, lang, article, kind, filename, filepath, content.
MD_SQL = f"""SELECT doc_id, source, lang, article, kind, funder_code, year_code, filename, folder || filename AS filepath, front || body AS content FROM ({_FILES}) AS files"""

#: Web pages with the header that a scraper leaves; every tenth has none.
SCRAPED_SQL = f"""SELECT page_id, url, CASE WHEN page_id % 10 = 0 THEN '' ELSE '<!-- source: ' || url || ' | scraped: 2025-06-' || lpad(CAST(1 + page_id % 28 AS STRING), 2, '0') || 'T12:00:00+00:00 | hash: ' || md5(html) || ' -->' || {_N} || {_N} END || 'Page text of ' || url || '.' AS content FROM pages"""

#: Golden documents and what three pseudo-converters made of them.
BENCH_SQL = f"""SELECT m.doc_id, lower(funder_code) || '-' || kind || '-' || CAST(doc_id AS STRING) AS slug, kind, converter,
  CASE WHEN doc_id % 3 = 0 THEN 'docx' WHEN doc_id % 3 = 1 THEN 'pdf' ELSE 'xlsx' END AS fmt,
  content AS golden,
  CASE converter WHEN 'echo' THEN content WHEN 'lossy' THEN replace(replace(content, 'the ', ''), '| Hall |', '| Room |') ELSE replace(content, '## ', '') END AS candidate,
  CASE WHEN converter = 'docx_only' AND doc_id % 3 <> 0 THEN 'unsupported' WHEN converter = 'lossy' AND doc_id % 17 = 0 THEN 'failed' ELSE 'scored' END AS status
FROM ({MD_SQL}) AS m CROSS JOIN (SELECT 'echo' AS converter UNION ALL SELECT 'lossy' UNION ALL SELECT 'docx_only') AS converters"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, sql: str, name: str) -> DataFrame:
    return spark.sql(sql.replace(f"FROM {name}", f"FROM {{{name}}}"), **{name: table(spark, sf_dir, name)})


def md_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, MD_SQL, "documents")


def scraped_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, SCRAPED_SQL, "pages")


def bench_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, BENCH_SQL, "documents")


def md_cte(body: str) -> str:
    """An oracle over the view: ``md`` is it."""
    return f"WITH md AS ({MD_SQL})\n{body}"
