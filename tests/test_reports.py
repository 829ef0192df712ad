"""Blocks, extraction, sources, streams, settings and reports on small inputs."""

import io
import os
import random
import zipfile
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from archivelens import config
from archivelens.functions import frontmatter as FM
from archivelens.functions import ratios
from archivelens.operators import audit, canonical, fidelity, markdown, prioritize, reports
from archivelens.plans import pipeline
from archivelens.sources import connectors, extract, files, fixtures, providers
from archivelens.streaming import ingest

from .conftest import canonical_rows


def brute_blocks(text):
    """Line by line: (kind, text or rows, section)."""
    out, section, held, table = [], None, [], None
    rule = lambda x: "-" in x and not set(x.strip()) - set("|:- ")
    cells = lambda x: [c.strip() for c in x.strip().removeprefix("|").removesuffix("|").split("|")]
    lines = text.splitlines() + [""]
    for i, line in enumerate(lines):
        if table is not None:
            if "|" in line:
                if not rule(line):
                    table.append(cells(line))
                continue
            out.append(("table", table, section))
            table = None
        hashes = len(line) - len(line.lstrip("#"))
        heading = 1 <= hashes <= 6 and line[hashes : hashes + 1] in (" ", "\t") and line[hashes:].strip()
        opens = "|" in line and i + 1 < len(lines) and "|" not in line.strip()[:0] and rule(lines[i + 1])
        if (heading or opens or not line.strip()) and held:
            out.append(("paragraph", " ".join(held), section))
            held = []
        if heading:
            section = line[hashes:].replace("**", "").strip()
            out.append(("heading", section, section))
        elif opens:
            table = [cells(line)]
        elif line.strip():
            held.append(line.strip())
    return out


def test_blocks_against_lines():
    rng = random.Random(3)
    pieces = ["# One", "## **Two** x", "plain text", "more text ", "", "| a | b |", "| --- | --- |", "|c|d|", "e | f", "   ", "#no"]
    for _ in range(400):
        text = "\n".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        got = [(b["kind"], b["rows"] if b["kind"] == "table" else b["text"], b["section"]) for b in markdown.blocks_of(text)]
        assert got == brute_blocks(text), text


def test_titles_templates_and_names(spark):
    d = spark.createDataFrame([(["A/B", "A/B", None, "x" * 40, "x" * 40, "A B_2"], "Ontario Arts Council", "hi {a} {b} {"), (None, "single", None)], "s array<string>, n string, t string")
    rows = d.select(markdown.sheet_titles(F.col("s")).alias("s"), markdown.abbreviation(F.col("n")).alias("n"), markdown.filled(F.col("t"), {"a": F.lit("{b}")}).alias("t")).collect()
    assert rows[0]["s"] == ["A B", "A B_2", "Sheet3", "x" * 31, "x" * 29 + "_2", "A B_2_2"] and rows[0]["n"] == "OAC" and rows[0]["t"] == "hi {b} {b} {"
    assert rows[1]["s"] is None and rows[1]["n"] == "SIN" and rows[1]["t"] is None
    times = [r[0] for r in spark.createDataFrame([(0.25,), (2.0,), (61.0,), (7265.0,)], "x double").select(markdown.human_time(F.col("x"))).collect()]
    assert times == ["250ms", "2.0s", "1m 1s", "2h 1m"]


def office(parts):
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return bytearray(held.getvalue())


def test_files_of_any_kind_are_scanned(spark):
    word = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    sheet = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    docx = office({"word/document.xml": f'<w:document xmlns:w="{word}"><w:body><w:p><w:r><w:t>Dear </w:t></w:r><w:r><w:t>Jane Doe</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a@b.org</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>'})
    xlsx = office({"xl/sharedStrings.xml": f'<sst xmlns="{sheet}"><si><t>c@d.org</t></si></sst>', "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{sheet}"><sheetData><row><c t="s"><v>0</v></c><c><v>12</v></c><c t="inlineStr"><is><t>x</t></is></c></row></sheetData></worksheet>'})
    rows = [("a.docx", docx), ("b.xlsx", xlsx), ("c.md", bytearray(b"plain\ne@f.org")), ("d.docx", bytearray(b"no archive")), ("e.txt", bytearray(b"\xff\xfe\x00")), ("f.pdf", bytearray(b"%PDF-broken"))]
    d = spark.createDataFrame([(n, f"/x/{n}", c) for n, c in rows], "filename string, filepath string, content binary")
    texts = {r["filename"]: r for r in extract.extracted(d).collect()}
    assert texts["a.docx"]["text"] == "Dear Jane Doe\na@b.org" and texts["b.xlsx"]["text"] == "c@d.org\n12\nx" and all((r["text"] is None) != (r["error"] is None) for r in texts.values())
    found = {(r["filepath"], r["line"], r["kind"]) for r in extract.scan(d, ["Jane Doe"]).collect()}
    assert found == {("/x/a.docx", 1, "denylisted_name"), ("/x/a.docx", 2, "email"), ("/x/b.xlsx", 1, "email"), ("/x/c.md", 2, "email"), *((f"/x/{n}", 0, "unscannable") for n in ("d.docx", "e.txt", "f.pdf"))}


@pytest.fixture
def folder(tmp_path):
    for name, text in [("a.md", "# A\r\nx"), ("sub/b.md", "# B"), (".hidden.md", "no"), ("c.txt", "C"), ("sub/d.PDF", "D"), ("sub/noext", "E")]:
        p = tmp_path / name
        p.parent.mkdir(exist_ok=True)
        p.write_bytes(text.encode())
    return str(tmp_path)


def test_folders_are_read(spark, folder):
    listed = {r["filename"]: r for r in files.listing(spark, folder).collect()}
    assert set(listed) == {"a.md", "b.md", "d.PDF"} and listed["a.md"]["size_bytes"] == 6 and listed["d.PDF"]["extension"] == ".pdf"
    assert {r["filename"] for r in files.listing(spark, folder, files.SCANNABLE).collect()} == {"a.md", "b.md", "c.txt", "d.PDF"}
    assert {(r["filename"], r["content"]) for r in files.texts(spark, folder).filter("filename not like '.%'").collect()} == {("a.md", "# A\r\nx"), ("b.md", "# B")}
    assert {bytes(r["content"]) for r in files.contents(spark, folder).filter("filename = 'c.txt'").collect()} == {b"C"}
    connectors.register(spark)
    rows = {r["filename"]: r for r in spark.read.format("archive").load(folder).collect()}
    assert set(rows) == {"a.md", "b.md"} and rows["a.md"]["content"] == "# A\r\nx" and rows["b.md"]["size_bytes"] == 3
    assert spark.read.format("archive").option("pattern", "*.txt").load(folder).first()["content"] == "C"
    with pytest.raises(Exception, match="no connector for gdrive"):
        spark.read.format("gdrive").load().collect()
    with pytest.raises(NotImplementedError):
        files.listing(spark, "dropbox://x")
    out = f"{folder}/table"
    files.write_table(spark.range(3).withColumn("p", F.col("id") % 2), out, ["p"])
    files.write_table(spark.range(2).withColumn("p", F.lit(7)), out, ["p"])
    assert sorted(os.listdir(out))[-1] == "p=7" and spark.read.parquet(out).count() == 2
    kept, left = files.split_by(spark.createDataFrame([(1,), (2,), (None,)], "x int"), F.col("x") > 1)
    assert kept.count() == 1 and left.count() == 2


def test_cases_and_runs(spark):
    golden = spark.createDataFrame([("oac-budget-01", "text " * 501), ("tac-report-02", "t")], "slug string, content string")
    names = spark.createDataFrame([(n,) for n in ("oac-budget-01.scanned.pdf", "oac-budget-01.docx", "tac-report-02.pdf", "tac-report-02.exe", "other.pdf", "cca-x-03.pdf")], "name string")
    found = fidelity.cases(golden, names)
    assert {(r["slug"], r["fmt"]) for r in found.collect()} == {("oac-budget-01", "pdf_scanned"), ("oac-budget-01", "docx"), ("tac-report-02", "pdf")}
    spec = [{"name": "p", "extensions": [".pdf"], "cost_per_page": 0.5}, {"name": "q", "extensions": [".docx"], "enabled": False}]
    rows = {(r["name"], r["converter"]): (r["supported"], r["pages"], r["cost_usd"]) for r in fidelity.runs(found, spec).collect()}
    assert rows == {("oac-budget-01.scanned.pdf", "p"): (True, 2, 1.0), ("oac-budget-01.docx", "p"): (False, 2, 1.0), ("tac-report-02.pdf", "p"): (True, 1, 0.5)}


def test_streams(spark, tmp_path):
    source, done = str(tmp_path / "in"), {}
    schema = "filename string, content string"
    spark.createDataFrame([("OAC__2020_P__report_draft.md", "a"), ("OAC__2020_P__report.md", "b")], schema).write.parquet(source)

    def each(batch, number):
        stored = spark.createDataFrame([("OAC__2020_P__report.md", "old"), ("TAC__2021_Q__x.md", "c")], schema)
        done.update({r["filename"]: r["status"] for r in ingest.resolve_versions(batch, stored).collect()})

    for _ in range(2):
        ingest.run_once(ingest.file_stream(spark, source, schema), each, str(tmp_path / "state"))
    assert done == {"OAC__2020_P__report_draft.md": "draft", "OAC__2020_P__report.md": "canonical"}
    seen = []
    spark.createDataFrame([("TAC__2021_Q__y.md", "d")], schema).write.mode("append").parquet(source)
    ingest.run_once(ingest.file_stream(spark, source, schema, per_trigger=1), lambda batch, _: seen.extend(r["filename"] for r in batch.collect()), str(tmp_path / "state"))
    assert seen == ["TAC__2021_Q__y.md"]


def test_scraped_pages_as_a_stream(spark, tmp_path):
    head = "<!-- source: http://a.b/{0} | scraped: 2025-06-01T12:00:00+00:00 | hash: {1} -->\n\ntext"
    rows = [(1, head.format("x", "h1")), (2, head.format("x", "h1")), (3, head.format("x", "h2")), (4, "no header")]
    spark.createDataFrame(rows, "page_id int, content string").write.parquet(str(tmp_path / "in"))
    stream = ingest.page_stream(ingest.file_stream(spark, str(tmp_path / "in"), "page_id int, content string"), "IA")
    got = []
    ingest.run_once(stream, lambda batch, _: got.extend((r["source_url"], r["content_hash"]) for r in batch.collect()), str(tmp_path / "state"))
    assert sorted(got) == [("http://a.b/x", "h1"), ("http://a.b/x", "h2")]


def test_website_stages(spark):
    page = "<!-- source: http://a.b/about-us | scraped: 2025-06-01T12:00:00+00:00 | hash: h -->\n\n# About\n\nPeople work here.\n"
    d = spark.createDataFrame([(1, page), (2, "nothing")], "page_id int, content string")
    got = pipeline.website(d, "IA", ["clean"])
    assert [r["filename"] for r in got["documents"].collect()] == ["IA__2025-06-01__about_us__webpage.md"] and got["errors"].count() == 1
    assert pipeline.website(d, "IA", [])["report"].first()["files"] == 1


def test_sole_writer(spark, tmp_path):
    with pipeline.sole_writer(spark, f"file://{tmp_path}", "one"):
        with pytest.raises(RuntimeError, match="another run"):
            with pipeline.sole_writer(spark, f"file://{tmp_path}", "two"):
                pass
    with pipeline.sole_writer(spark, f"file://{tmp_path}", "three") as lock:
        with pipeline.sole_writer(spark, f"file://{tmp_path}", "four", stale_seconds=-1):  # left by a run that died
            assert lock.endswith("_writer.lock")


def test_settings():
    assert config.denylist("names: [A, ' ', 3]") == ["A", "3"] and config.denylist("") == []
    for bad in ("names: x", "- a", "a: [b"):
        with pytest.raises(ValueError):
            config.denylist(bad)
    profile = "headings:\n  OAC:\n    headings:\n      Budget: [Costs]\n      Plan: []\n  TAC: {}\n"
    assert config.profile_headings(profile, "OAC") == ["Budget", "Plan"]
    for funder in ("TAC", "XXX"):
        with pytest.raises(ValueError):
            config.profile_headings(profile, funder)
    assert config.project("org: X\nfunders: {A: B}", org="Y").org == "Y"
    assert config.from_scan({"OAC": "Arts"}, ["report"], "/a")["paths"] == {"raw_archive": "/a"} and "funders" not in config.from_scan({}, [])
    assert config.stages_of(None) is None and config.stages_of("none") == [] and config.stages_of("clean, classify") == ["clean", "classify"]
    with pytest.raises(ValueError, match="unknown stages: x"):
        config.stages_of("clean,x")
    assert config.prioritizing({"rubric": {1: "a", 2: "b"}}, {"rubric": {"2": "c"}})["rubric"] == {1: "a", 2: "c"}
    assert [c["n"] for c in config.enabled([{"n": 1}, {"n": 2, "enabled": False}])] == [1]
    assert config.extensions_of([providers.HtmlConverter(), providers.TextConverter(), extract.PANDOC]) >= {".html", ".csv", ".docx"}
    assert config.corpus_spec("counts: {budget: 2}\nfunders: [A]", ["budget"])["counts"] == {"budget": 2}
    with pytest.raises(ValueError, match="unknown kind x; no funders"):
        config.corpus_spec("counts: {x: 2}", ["budget"])
    assert [s for _, s, _ in config.health(config.ProjectConfig())] == ["warn", "warn", "warn"]
    assert providers.converter("html").name == "html"
    with pytest.raises(ValueError):
        providers.converter("none")


def test_reports(spark):
    d = spark.createDataFrame([("a", i) for i in range(25)] + [("b", 1)], "kind string, n int").repartition(7)
    rows = reports.shown(d, "kind", "n", n=10).collect()
    assert sorted((r["kind"], r["n"], r["more"]) for r in rows) == [*(("a", i, 15) for i in range(10)), ("b", 1, 0)]
    assert sorted(r["n"] for r in reports.sample(d.filter("kind = 'a'"), 5, "n", 1).collect()) == sorted(r["n"] for r in reports.sample(d.filter("kind = 'a'").repartition(3), 5, "n", 1).collect())
    assert reports.first_of(d, 3, "n", "kind").count() == 3 and reports.first_of(d, None).count() == 26
    text = reports.as_table(spark.createDataFrame([("x", 1.5, [1, 2]), ("a", None, [])], "k string, v double, l array<int>"), "k", title="T")
    assert text == "## T\n\n| k | v | l |\n|---|---|---|\n| a |  |  |\n| x | 1.5 | 1, 2 |\n"


def test_vectors_and_words_as_one_score(spark):
    words = spark.createDataFrame([(1, 4.0), (2, 2.0)], "id int, score double")
    vectors = providers.vector_search(spark.createDataFrame([(2, [1.0, 0.0]), (3, [1.0, 1.0]), (4, [0.0, 0.0])], "id int, v array<double>"), "id", "v", [1.0, 0.0])
    assert {r["id"]: round(r["score"], 4) for r in vectors.collect()} == {2: 1.0, 3: 0.7071, 4: 0.0}
    assert {r["id"]: round(r["score"], 3) for r in providers.hybrid(words, vectors, "id").collect()} == {1: 0.7, 2: 0.65, 3: 0.212, 4: 0.0}


def test_model_settles_doubtful_pairs(spark):
    class Same:
        def complete(self, system, prompt):
            return ('Well: {"same": true}' if "first plan" in prompt else "no idea"), 1, 1

    rng = random.Random(1)
    base = "".join(rng.choice("abcdefghij ") for _ in range(1000))
    mixed = lambda n: base[:n] + "k" * (1000 - n)
    rows = [("low_a", "app", 1, "first plan " + mixed(400), "x"), ("low_b", "app", 1, mixed(450), "y"), ("high", "app", 2, base, "z"), ("low_c", "app", 1, "klmnopq" * 100, "w")]
    subs = spark.createDataFrame(rows, "filename string, app_key string, submission_number int, snippet string, bare string")
    doubt = {r["low"] for r in canonical.doubtful_pairs(subs).collect()}
    ratio = lambda a, b: SequenceMatcher(None, a, b, autojunk=False).ratio()
    assert doubt == {f for f, _, n, t, _ in rows if n == 1 and 0.25 <= ratio(t, base) <= 0.55} >= {"low_a", "low_b"}
    assert [(r["filename"], r["reason"]) for r in canonical.resolve_doubtful(subs, Same).collect()] == [("low_a", "superseded by submission_2 (LLM confirmed match)")]


def test_priority_of_one_file(spark):
    d = spark.createDataFrame([("g", "a.md", "---\nfunder: A\n---\nText"), ("g", "b.md", "B"), ("h", "c.md", "C")], "group_key string, filename string, content string")
    r = prioritize.file_prompt(d, "a.md").first()
    assert r["files"] == ["a.md"] and "- b.md" in r["prompt"] and "c.md" not in r["prompt"] and "### a.md" in r["prompt"] and "1." in r["prompt"]


def words_of(t):
    return " ".join((t or "").split()).lower().split()


def test_scores_against_the_standard_library(spark, sf):
    """bench_text_score, bench_structure_score, bench_scores and both weighted roll-ups."""
    pairs = fixtures.bench_pairs(spark, sf).filter("doc_id < 40")
    rows = fidelity.scored(pairs).collect()
    golden = {(r["slug"], r["converter"]): r for r in pairs.withColumns({"g": fidelity.body(F.col("golden")), "c": fidelity.body(F.col("candidate"))}).collect()}
    for r in rows:
        p = golden[r["slug"], r["converter"]]
        if p["status"] != "scored":
            assert r["text"] is None and r["weighted"] is None
            continue
        g, c = words_of(p["g"]), words_of(p["c"])
        assert r["text"] == (1.0 if not g and not c else 0.0 if not c else SequenceMatcher(None, g, c).ratio())
        assert abs(r["weighted"] - (0.4 * r["text"] + 0.25 * r["tables"] + 0.25 * r["structure"] + 0.1 * r["links_images"])) < 1e-9
    rolled = {r["converter"]: r for r in fidelity.rollup(fidelity.scored(pairs)).collect()}
    for name, r in rolled.items():
        own = [x for x in rows if x["converter"] == name]
        scored = [x["weighted"] for x in own if x["status"] == "scored"]
        assert r["n_scored"] == len(scored) and abs(r["mean"] - sum(scored) / len(scored)) < 1e-9 and abs(r["overall"] - r["mean"] * len(scored) / len(own)) < 1e-9


def test_near_articles_and_collisions_against_all_pairs(spark, sf):
    """audit_near_duplicates, audit_name_collisions and the roll-up of all checks."""
    a = audit.articles(fixtures.md_documents(spark, sf).filter("doc_id < 70").select("article", "content"))
    held = {r["article"]: r for r in a.select("article", "body").collect()}
    key = lambda n: "".join(c for c in n.lower() if c.isascii() and c.isalnum())
    import re

    bag = {n: {w.lower() for w in re.findall(r"\w{4,}", r["body"])} for n, r in held.items()}
    c, want = audit.CONFIG, {}
    for x in held:
        for y in held:
            if x >= y:
                continue
            if key(x) == key(y):
                want[x, y] = 1.0
                continue
            first, second = sorted((x, y), key=lambda n: (len(bag[n]) // c["band"], n))
            t, u = held[first]["body"], held[second]["body"]
            if not bag[x] or not bag[y] or abs(len(bag[x]) // c["band"] - len(bag[y]) // c["band"]) > 1 or min(len(t), len(u)) < 0.5 * max(len(t), len(u)):
                continue
            if len(bag[x] & bag[y]) < c["word_overlap"] * min(len(bag[x]), len(bag[y])) or 2 * min(len(t), len(u)) / (len(t) + len(u)) < c["near_duplicate"]:
                continue
            if SequenceMatcher(None, t[:800], u[:800]).quick_ratio() >= c["near_duplicate"] and (r := SequenceMatcher(None, t, u).ratio()) >= c["near_duplicate"]:
                want[x, y] = round(r, 4)
    found = {(r["a"], r["b"]): r["similarity"] for r in audit.near_duplicates(a).collect()}
    assert found == pytest.approx(want) and found
    names = {frozenset((r["article_a"], r["article_b"])): r for r in audit.name_collisions(a).collect()}
    assert set(names) == {frozenset(p) for p in want if key(p[0]) == key(p[1])}
    for p, r in names.items():
        x, y = sorted(p)
        assert abs(r["similarity"] - SequenceMatcher(None, held[x]["body"], held[y]["body"]).ratio()) < 1e-4 and (r["subtype"] == "content_divergent") == (r["similarity"] < c["divergent_below"])
    roll = {r["check"]: r["findings"] for r in audit.rollup(audit.checks(a)).collect()}
    assert list(roll) == audit.CHECKS and roll["near_duplicates"] == len(found) and roll["name_collisions"] == len(names)


def _all_near(rows, least=audit.CONFIG["near_duplicate"]):
    """All pairs of (article, body) whose whole texts have the ratio, in the order of comparison."""
    import re

    band = {n: len({w.lower() for w in re.findall(r"\w{4,}", t)}) // audit.CONFIG["band"] for n, t in rows}
    held = sorted(rows, key=lambda r: (band[r[0]], r[0]))
    found = {}
    for i, (x, t) in enumerate(held):
        for y, u in held[i + 1 :]:
            if (r := SequenceMatcher(None, t, u).ratio()) >= least:
                found[min(x, y), max(x, y)] = round(r, 4)
    return found


@pytest.mark.parametrize("block", [7, 20_000])
def test_near_duplicates_are_all_pairs(spark, monkeypatch, block):
    """audit_near_duplicates: pairs of few words in common, of sizes far apart, without words, without characters, in any block."""
    monkeypatch.setattr(audit, "BLOCK", block)
    monkeypatch.setattr(audit, "LEAST_BLOCK", 5)
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(80)]
    texts = ["", "", "ab", "ab cd ef", "ab cd eg", "ab cd ef", "é😀 ü"]
    for size in (60, 150, 199, 200, 260, 900, 3000):
        for _ in range(4):
            t = ""
            while len(t) < size:
                t += rng.choice(words) + " "
            texts.append(t[:size])
            for share in (0.03, 0.08, 0.12):
                changed = [rng.choice("xyzq ") if rng.random() < share else ch for ch in t[:size]]
                texts.append("".join(changed[: int(size * (1 - share * rng.random()))]))
    spaced = "".join(f"w{k:03}x " for k in range(90))
    texts += [spaced, spaced.replace("x ", " x "), spaced[:-40]]  # bags of 90 words and of 90 others; bands apart
    rows = [(f"n{rng.randrange(10**6)}i{i}", t) for i, t in enumerate(texts)]
    found = audit.near_duplicates(spark.createDataFrame(rows, "article string, body string")).collect()
    want = _all_near(rows)
    assert len(found) == len(want) and {(r["a"], r["b"]): r["similarity"] for r in found} == pytest.approx(want)
    c = audit.CONFIG
    assert set(want) - {tuple(sorted(r)) for r in audit.near_candidates(spark.createDataFrame(rows, "article string, body string"), c).collect()}


def test_ratios_in_parts(monkeypatch):
    """audit_near_duplicates: a block's runs are held for so many characters at once, texts longer than that by themselves; ratios end where they can't be reached."""
    import pyarrow as pa

    rng = random.Random(8)
    base = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzéü .,;0123456789") for _ in range(900))
    texts = [base[: rng.randint(1, 900)] for _ in range(12)] + ["".join(c if rng.random() > 0.07 else "#" for c in base) for _ in range(6)] + [""]
    t = pa.table({"article": [f"a{i:02}" for i in range(len(texts))], "key": [str(i) for i in range(len(texts))], "band": pa.array([0] * len(texts), pa.int64()), "body": texts, "block": pa.array([0] * len(texts), pa.int32())})
    want = {(f"a{i:02}", f"a{j:02}"): r for i, x in enumerate(texts) for j, y in enumerate(texts) if i < j and (r := SequenceMatcher(None, x, y).ratio()) >= 0.85}
    for characters in (700, 3_000, 4_000_000):
        monkeypatch.setattr(ratios, "CHARACTERS", characters)
        found = ratios.alike(0.85)((pa.scalar(0), pa.scalar(0)), t).to_pylist()
        assert {(r["a"], r["b"]): r["r"] for r in found} == want and len(found) == len(want) > 5
    for x, y in zip(texts, texts[3:]):
        r = SequenceMatcher(None, x, y).ratio()
        assert ratios.ratio_from(x, y, 0.01) == (r if r >= 0.01 else None) and ratios.ratio_from(x, y, 0.9) == (r if r >= 0.9 else None)


def test_near_duplicates_see_whole_texts(spark):
    """audit_near_duplicates, audit_rollup_all: texts that only begin in different ways."""
    rng = random.Random(4)
    rest = " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(6)) + chr(0x4E00 + k) * (k % 20 == 0) for k in range(2500))
    rows = [("a", "QRSTUVWX " * 95 + rest), ("b", "0123456 " * 105 + rest)]
    want = _all_near(rows)
    a = spark.createDataFrame(rows, "article string, content string")
    found = {(r["a"], r["b"]): r["similarity"] for r in audit.near_duplicates(audit.articles(a)).collect()}
    assert found == pytest.approx(want) and len(want) == 1
    assert {r["check"]: r["findings"] for r in audit.rollup(audit.checks(audit.articles(a))).collect()}["near_duplicates"] == 1


def test_rollup_counts_every_check(spark, tmp_path):
    """audit_rollup: near duplicates as well, in the query and in its SQL; texts with few characters, without rare ones and with copies."""
    import duckdb

    from archivelens.queries import catalogue

    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 8))) for _ in range(50)]
    texts = [None, "", "a", "éé", "abab" * 90]
    for size in (5, 40, 120, 500):
        t = [rng.choice(words) for _ in range(size)]
        texts += [" ".join(w if rng.random() > share else rng.choice(words) for w in t) for share in (0, 0, 0.04, 0.12, 0.2)]
    rows = [(i * 11, t, "en", "s", 5) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    run, sql = catalogue()["audit_rollup"]
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = {r["check"]: r["findings"] for r in run(spark, str(tmp_path)).collect()}
    held = audit.articles(fixtures.md_documents(spark, str(tmp_path)).select("article", "content")).select("article", "body").collect()
    key = lambda n: "".join(c for c in n.lower() if c.isascii() and c.isalnum())
    want = [p for p in _all_near([tuple(r) for r in held]) if key(p[0]) != key(p[1])]
    assert list(found) == audit.CHECKS and found == dict(duck.execute(sql).fetchall())
    assert found["near_duplicates"] == len(want) + found["name_collisions"] and want


def test_near_candidates_have_lengths_for_the_ratio(spark):
    """audit_near_duplicates, audit_rollup_all: pairs whose lengths rule the ratio out end where words are counted, before texts are fetched."""
    words = [f"word{k}" for k in range(20)]
    rows = [("a", " ".join(words)), ("b", " ".join(words) + " xy" * 14), ("c", " ".join(words) + " xy" * 30)]
    d = spark.createDataFrame(rows, "article string, body string")
    pairs = {tuple(sorted(r)) for r in audit.near_candidates(d).collect()}
    limit = audit.CONFIG["near_duplicate"]
    kept = {tuple(sorted(r)) for r in audit.near_candidates(d, length=limit / (2 - limit) - 1e-9).collect()}
    n = {x: len(t) for x, t in rows}
    assert len(pairs) == 3 and kept == {(x, y) for x, y in pairs if 2 * min(n[x], n[y]) / (n[x] + n[y]) >= limit} and len(kept) == 2
    plan = audit.near_duplicates(d)
    assert {(r["a"], r["b"]) for r in plan.collect()} <= kept


def test_fixes_against_lines(spark):
    """audit_fix: weak sections go, link noise is escaped."""
    text = "# T\n\n## Key Figures\nNo data.\n\n## Body\nA [abc.def token here.\n"
    r = audit.fixed(audit.articles(spark.createDataFrame([("x", text), ("y", "# T\n\n## Body\nfine.\n")], "article string, content string"))).collect()
    assert len(r) == 1 and r[0]["article"] == "x" and r[0]["content"] == "# T\n\n## Body\nA \\[abc.def token here.\n" and set(r[0]["actions"]) == {"removed_weak_sections", "escaped_link_noise"}


def test_frontmatter_values(spark):
    """Each variant of a type is folded, whatever surrounds it (P9)."""
    for variant, canonical_name in FM.TYPE_VALUES.items():
        d = spark.createDataFrame([(f"funder: A\ntype: {variant}\nempty:\nperiod: from 2019 to 2021",)], "t string")
        assert d.select(FM.fold_values(F.col("t"))).first()[0].split("\n") == ["funder: A", f"type: {canonical_name}", "period: 2019–2021"]


def test_ingest(spark):
    d = spark.createDataFrame([("My plan (new)", "text", 2024)], "name string, content string, year int")
    r = pipeline.ingest(d, "OAC", "report").first()
    assert r["filename"] == "OAC__2024_My_plan_new__report.md" and r["content"] == '---\nfunder: "OAC"\ntype: "report"\nwritten: 2024\n---\n\ntext\n'
    w = spark.createDataFrame([("a", "XX", ["report", "odd"]), ("b", "OAC", None), ("c", None, [])], "filename string, funder string, types array<string>")
    got = sorted((x["filename"], x["warning"].split('"')[0].strip()) for x in pipeline.ingest_warnings(w, ["OAC"], ["report"]).collect())
    assert got == [("a", "Unrecognized funder"), ("a", "Unrecognized type"), ("c", "Unrecognized funder")]


@pytest.mark.parametrize("name", ["audit_dead_links", "audit_weak_sections", "audit_rollup"])
def test_articles_of_one_name(name, spark, tmp_path):
    """audit_dead_links, audit_weak_sections, audit_rollup: ids 410,000 apart have one article name, as at 1 GB."""
    import duckdb

    from archivelens.queries import catalogue

    ids = [164, 410164, 41 * 5, 410000 + 41 * 5, 41 * 15, 410000 + 41 * 15, 41 * 8, 410000 + 41 * 8, 3]
    rows = [(i, "A walk. " * (12 - k), "en", "s", 5) for k, i in enumerate(ids)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    run, sql = catalogue()[name]
    duck = duckdb.connect()
    duck.execute(f"SET threads = 1; CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet' ORDER BY doc_id")
    assert canonical_rows(run(spark, str(tmp_path)).toPandas()) == canonical_rows(duck.execute(sql).df())


def test_pii_report_as_its_sql(spark, tmp_path):
    """pii_report: numbers with one sign between them, letters that aren't ASCII, hard spaces; the operator still finds all."""
    import duckdb

    from archivelens.operators import pii
    from archivelens.queries import catalogue

    rows = [(1, "token 6405768150e0411590525c and"), (2, "éA1A 1A1 x"), (3, "a@b.org\u00a0"), (4, "١٢٣-٤٥-٦٧٨٩ and 123-45-6789,987-65-4321"), (5, "KÉJane Doeé +1 (416) 555-0100")]
    spark.createDataFrame([(i, t, "en", "s", 5) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    run, sql = catalogue()["pii_report"]
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert canonical_rows(run(spark, str(tmp_path)).toPandas()) == canonical_rows(duck.execute(sql).df())
    found = pii.findings(spark.createDataFrame(rows[:1], "id int, t string"), "id", "t").collect()
    assert {r["match"] for r in found} == {"6405768150", "0411590525"}


@pytest.mark.parametrize("block", [150, 2_000_000])
def test_near_candidates_in_blocks(spark, block):
    """audit_near_dup_candidates: words that all share, copies, several blocks of a band; nothing is joined by words."""
    rng = random.Random(5)
    bags = [["common", "others", *rng.sample([f"word{k}" for k in range(60)], rng.randint(1, 40))] for _ in range(90)]
    bags += [bags[0]] * 3 + [["common"]] * 2
    rows = [(f"a{i:03}", " ".join(b)) for i, b in enumerate(bags)]
    c = audit.CONFIG | {"block": block}
    found = audit.near_candidates(spark.createDataFrame(rows, "article string, body string"), c)
    want, sets = set(), [set(b) for b in bags]
    for i, x in enumerate(sets):
        for j in range(i):
            n, m, y = len(rows[i][1]), len(rows[j][1]), sets[j]
            if abs(len(x) // 30 - len(y) // 30) <= 1 and min(n, m) >= 0.5 * max(n, m) and len(x & y) >= 0.35 * min(len(x), len(y)):
                want.add((rows[j][0], rows[i][0]))
    got = [tuple(sorted(r)) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    plan = found._jdf.queryExecution().analyzed().toString()
    assert "explode(bag" not in plan
