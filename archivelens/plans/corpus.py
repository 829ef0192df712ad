"""Synthetic documents for tests of converters and detectors (inventory G1-G5, A24, A29).

Rows are made where they are needed: each has a random generator seeded by its own kind and number,
so a document is the same whatever partition or order it is made in.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ["application", "report", "budget", "activity_list", "staff_board", "support_letter"]
_GIVEN = "Ada Ben Cleo Dag Eve Finn Gwen Hal Ines Jon".split()
_FAMILY = "Alder Birch Cedar Dogwood Elm Fir Gorse Hazel Ivy Juniper".split()
_WORDS = "art stage season youth music light river paper garden studio town harbour story craft voice winter public shared open new".split()


def sentence(rng: random.Random) -> str:
    words = [rng.choice(_WORDS) for _ in range(rng.randint(6, 14))]
    return " ".join(words).capitalize() + "."


def filler(rng: random.Random, chars: int) -> str:
    """Sentences of about so many characters, ten in a hundred more or less."""
    out = sentence(rng)
    while len(out) < chars * 0.95:
        out += " " + sentence(rng)
    return out[: int(chars * 1.1)].rsplit(" ", 1)[0] if len(out) > chars * 1.1 else out


def person(rng: random.Random) -> str:
    return f"{rng.choice(_GIVEN)} {rng.choice(_FAMILY)}"


def money(rng: random.Random) -> int:
    return rng.randrange(500, 20_000, 50)


def body(kind: str, rng: random.Random) -> str:
    if kind == "budget":
        rows = [(w.capitalize(), money(rng)) for w in rng.sample(_WORDS, 5)]
        table = [f"| {n} | ${v:,} |" for n, v in rows] + [f"| Total | ${sum(v for _, v in rows):,} |"]
        return "## Budget\n\n| Item | Amount |\n| --- | --- |\n" + "\n".join(table)
    if kind == "activity_list":
        return "## Activities\n\n" + "\n".join(f"- {sentence(rng)}" for _ in range(6))
    if kind == "staff_board":
        return "## Staff and board\n\n| Name | Role |\n| --- | --- |\n" + "\n".join(f"| {person(rng)} | {rng.choice(['Director', 'Chair', 'Member', 'Producer'])} |" for _ in range(5))
    heads = {"application": ["Summary", "Need", "Plan"], "report": ["Results", "Lessons"], "support_letter": ["To whom it may concern"]}[kind]
    return "\n\n".join(f"## {h}\n\n{filler(rng, 400)}" for h in heads)


def document(seed: int, kind: str, number: int, funder: str) -> dict:
    rng = random.Random(f"{seed}:{kind}:{number}")
    year = rng.randint(2018, 2024)
    front = f"---\nfunder: {funder}\ntype: {kind}\nwritten: {year}\nperiod: {year}\nlanguage: en\n---\n"
    return {"slug": f"{funder.lower()}-{kind}-{number:02d}", "kind": kind, "funder": funder, "content": f"{front}\n# {kind.replace('_', ' ').title()} {number}\n\n{body(kind, rng)}\n"}


def generate(spark: SparkSession, counts: dict[str, int], funders: list[str], seed: int = 42) -> DataFrame:
    """slug, kind, funder and content of so many documents of each kind."""
    spec = spark.createDataFrame(sorted(counts.items()), "kind string, n int").select("kind", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("number"))

    def made(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            rows = [document(seed, r["kind"], r["number"], funders[r["number"] % len(funders)]) for r in b.to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([(c, pa.string()) for c in ("slug", "kind", "funder", "content")]))

    return spec.mapInArrow(made, "slug string, kind string, funder string, content string")


def outputs(counts: dict[str, int], formats: dict[str, list[str]]) -> int:
    """Files that a corpus has: its documents times the formats of their kind."""
    return sum(n * len(formats.get(k, [])) for k, n in counts.items())
