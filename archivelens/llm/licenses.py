"""Licence scans: passages of normalised text against licence templates, by the Dice coefficient of word bigrams.

Passages are the lines of a text, its paragraphs, and the whole.  A Dice coefficient of T or more
with a template of n bigrams asks for n * T / (2 - T) to n * (2 - T) / T bigrams in the passage, so
sizes rule most pairs out.  What is left must share bigrams: the passages' bigrams are looked up in the
templates' table, which is of fixed size and broadcast, and the shared ones are counted.

Any passage or window of T has one of each template's rarest bigrams, so whole texts are first searched for
those; the few that have one are kept, and only they are cut into passages.

What no passage covers is compared by windows: of each template's number of words, from every
bigram the template has to the last one it has, over ends of sentences, lines and paragraphs.  For
them, the paragraphs of licences, further licence texts and the openings of the long ones are templates as well.  A window of T shares
n * T / (2 - T) of the template's bigrams at least, so it has one of any set of all but so many less one;
texts with none of the rarest of them are left out, without loss.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import keep

THRESHOLD = 0.7
#: Paragraphs of fewer words say too little to be templates.
LEAST_PARAGRAPH = 10

#: Licences by their public identifiers, with the names that notices give them.
NAMES = {
    "AGPL-3.0": ["GNU Affero General Public License version 3"],
    "Apache-2.0": ["Apache License Version 2.0"],
    "BSD-2-Clause": ["BSD 2 Clause License"],
    "BSD-3-Clause": ["BSD 3 Clause License"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY NC 4.0", "Creative Commons Attribution NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY SA 4.0", "Creative Commons Attribution ShareAlike 4.0 International License"],
    "GPL-2.0": ["GNU General Public License version 2"],
    "GPL-3.0": ["GNU General Public License version 3"],
    "ISC": ["ISC License"],
    "LGPL-3.0": ["GNU Lesser General Public License version 3"],
    "MIT": ["MIT License"],
    "MPL-2.0": ["Mozilla Public License version 2.0"],
}
#: How notices name a licence.
NOTICES = ["licensed under the {}", "licensed under {}", "released under the {}", "this work is licensed under the {}", "this program is distributed under the terms of the {}"]
#: Fixed value: the tag that names a licence by its public identifier.
TAG = "SPDX-License-Identifier: {}"
#: Texts of public licences.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see http://www.gnu.org/licenses/.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
}

_GNU = """This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software Foundation, either version {2} of the License, or (at your option) any later version.

This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} for more details.

You should have received a copy of the GNU {1} along with this {0}. If not, see https://www.gnu.org/licenses/."""
_BSD_TERMS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_REST = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_CC = "This work is licensed under the Creative Commons {} 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/{}/4.0/ or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA."
#: Texts that only windows are compared with, by paragraphs and as wholes.
BLOCKS = {
    "AGPL-3.0": _GNU.format("program", "Affero General Public License", "3"),
    "Apache-2.0": re.sub(r"(You may obtain|Unless required|See the License)", r"\n\n\1", TEXTS["Apache-2.0"]),
    "BSD-2-Clause": "\n\n".join([_BSD_TERMS, _BSD_REST]),
    "BSD-3-Clause": "\n\n".join([_BSD_TERMS, _BSD_NAMES, _BSD_REST]),
    "CC-BY-4.0": _CC.format("Attribution", "by"),
    "CC-BY-NC-4.0": _CC.format("Attribution-NonCommercial", "by-nc"),
    "CC-BY-SA-4.0": _CC.format("Attribution-ShareAlike", "by-sa"),
    "GPL-2.0": _GNU.format("program", "General Public License", "2"),
    "GPL-3.0": re.sub(r"(This program is distributed|You should have)", r"\n\n\1", TEXTS["GPL-3.0"]),
    "ISC": re.sub(r"(THE SOFTWARE IS|IN NO EVENT)", r"\n\n\1", TEXTS["ISC"]),
    "LGPL-3.0": _GNU.format("library", "Lesser General Public License", "3"),
    "MIT": re.sub(r"(The above copyright|THE SOFTWARE IS PROVIDED)", r"\n\n\1", TEXTS["MIT"]),
    "MPL-2.0": re.sub(r"(If a copy)", r"\n\n\1", TEXTS["MPL-2.0"]),
}
#: How the full texts of long licences begin; by these the full texts are known.
OPENINGS = {
    "AGPL-3.0": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc.",
    "Apache-2.0": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "CC-BY-4.0": "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution 4.0 International Public License",
    "CC-BY-NC-4.0": "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution-NonCommercial 4.0 International Public License",
    "CC-BY-SA-4.0": "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution-ShareAlike 4.0 International Public License",
    "GPL-2.0": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc.",
    "GPL-3.0": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc.",
    "LGPL-3.0": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc.",
    "MPL-2.0": "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software.",
}


def templates() -> list[tuple[str, list[str]]]:
    """Licence and words of every template, without repeats."""
    found = {}
    for licence, names in NAMES.items():
        for name in names:
            for notice in NOTICES:
                found.setdefault(" ".join(_words(notice.format(name))), licence)
        found.setdefault(" ".join(_words(TAG.format(licence))), licence)
    for licence, text in TEXTS.items():
        found.setdefault(" ".join(_words(text)), licence)
    return [(licence, text.split(" ")) for text, licence in found.items()]


def window_templates() -> list[tuple[str, list[str]]]:
    """Licence and words of every template of windows; a paragraph that licences share is the first one's."""
    found = {" ".join(words): licence for licence, words in templates()}
    for licence, text in BLOCKS.items():
        for part in (text, *text.split("\n\n")):
            words = _words(part)
            if len(words) >= LEAST_PARAGRAPH:
                found.setdefault(" ".join(words), licence)
    for licence, text in OPENINGS.items():
        found.setdefault(" ".join(_words(text)), licence)
    return [(licence, text.split(" ")) for text, licence in found.items()]


def _needed(size: int, threshold: float) -> int:
    """Bigrams of a template of ``size`` that any passage of ``threshold`` has."""
    return size_bounds(size, threshold)[0]


def _rarest(sets: list[list[str]], threshold: float) -> list[list[str]]:
    """For each template, bigrams of which any passage that matches it has one."""
    seen = Counter(p for b in sets for p in b)
    plain = lambda p: sum(len(w) < 4 for w in p.split(" "))
    return [sorted(b, key=lambda p: (plain(p), seen[p], p))[: len(b) - _needed(len(b), threshold) + 1] for b in sets]


def _words(text: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9]+", text.lower()) if w]


def _bigrams(words: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def size_bounds(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """The numbers of bigrams between which a passage may reach ``threshold`` with a template of ``n``."""
    low, high = n * threshold / (2 - threshold), n * (2 - threshold) / threshold
    return int(-(-low // 1)) if low % 1 > 1e-9 else round(low), int(high + 1e-9)


def normal_words(text: Column) -> Column:
    """Lower-case words of ASCII letters and digits."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def bigrams(words: Column) -> Column:
    """The different pairs of neighbouring words."""
    return F.array_distinct(F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(1))), lambda a, b: F.concat_ws(" ", a, b)))


def passages(text: Column) -> Column:
    """Lines, paragraphs and the whole of a text, each once."""
    return F.array_distinct(F.concat(F.split(text, "\n"), F.split(text, "\n[ \t\r]*\n"), F.array(text)))


def _pairs(words: Column) -> Column:
    """The pairs of neighbouring words by place, repeats too."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat_ws(" ", a, b))


def _spans(parts: Column) -> Column:
    """Hash, first word and end of each of ``parts`` that follow one another."""
    sized = F.transform(parts, lambda x: F.struct(F.xxhash64(x).alias("p"), F.size(normal_words(x)).alias("n")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<p:bigint,start:int,stop:int>>").alias("out"))
    step = lambda acc, x: F.struct((acc["at"] + x["n"]).alias("at"), F.concat(acc["out"], F.array(F.struct(x["p"].alias("p"), acc["at"].alias("start"), (acc["at"] + x["n"]).alias("stop")))).alias("out"))
    return F.aggregate(sized, start, step, lambda acc: acc["out"])


def _with_rare(docs: DataFrame, all_rare: list[str]) -> DataFrame:
    """doc_id and text of the documents that have one of some bigrams; most have none of their words, so bigrams needn't be made."""
    text = F.col("text")
    rare_words = sorted({max(p.split(" "), key=len) for p in all_rare})
    return docs.select("doc_id", "text").filter(F.arrays_overlap(F.split(F.lower(text), "[^a-z0-9]+"), F.lit(rare_words)) & F.arrays_overlap(_pairs(normal_words(text)), F.lit(all_rare)))


def candidates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A kept table, doc_id and text, of the documents in which any template, of passages or of windows, can match."""
    rarest = _rarest([_bigrams(words) for _, words in window_templates()], threshold)
    return keep(_with_rare(docs, sorted({p for r in rarest for p in r})), "licenses")


def windows(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Windows that match: doc_id, start and stop (words), licence, shared, dice, and ``over``, the hashes of the passages they meet."""
    spark = docs.sparkSession
    sets = [(i, licence, len(words), _bigrams(words)) for i, (licence, words) in enumerate(window_templates())]
    rows = [(i, licence, n, len(b), _needed(len(b), threshold), j, p) for i, licence, n, b in sets for j, p in enumerate(b)]
    table = F.broadcast(spark.createDataFrame(rows, "template int, licence string, t_words int, t_size int, needed int, id int, pair string"))  # some thousand rows, fixed by the templates
    rarest = _rarest([s[3] for s in sets], threshold)
    all_rare = sorted({p for r in rarest for p in r})
    text = F.col("text")
    some = _with_rare(docs, all_rare)
    may = lambda has: F.array_compact(F.array(*(F.when(F.arrays_overlap(has, F.lit(r)), i) for i, r in enumerate(rarest))))
    # bound as a lambda's variable, the shared pairs are found once a text; kept, the list isn't made again for each pair
    has = F.array(F.array_intersect(_pairs(normal_words(text)), F.lit(all_rare)))
    some = keep(some.withColumns({"k": F.xxhash64("doc_id", "text"), "may": F.transform(has, may)[0]}), "licenses")
    placed = some.select("k", "may", F.posexplode(_pairs(normal_words(text))).alias("pos", "pair")).join(table, "pair").filter(F.array_contains("may", F.col("template")))
    groups = placed.groupBy("k", "template", "licence", "t_words", "t_size", "needed").agg(F.sort_array(F.collect_set(F.struct("pos", "id"))).alias("hits"))
    near = groups.filter(F.size(F.array_distinct("hits.id")) >= F.col("needed"))
    from_hit = lambda h, i: F.filter(F.slice("hits", i + 1, F.col("t_words") - 1), lambda x: x["pos"] < h["pos"] + F.col("t_words") - 1)
    found = near.select("k", "licence", "t_size", "needed", F.explode(F.transform("hits", from_hit)).alias("h")).withColumn("shared", F.size(F.array_distinct("h.id"))).filter("shared >= needed")
    found = found.select("k", F.struct("licence", "t_size", "shared", F.col("h")[0]["pos"].alias("start"), (F.element_at("h", -1)["pos"] + 2).alias("stop")).alias("x"))
    both = some.join(found.groupBy("k").agg(F.collect_list("x").alias("xs")), "k").withColumn("b", _pairs(normal_words(text)))
    whole = F.array(F.struct(F.xxhash64("text").alias("p"), F.lit(0).alias("start"), (F.size("b") + 1).alias("stop")))
    spans = F.concat(_spans(F.split(text, "\n")), _spans(F.split(text, "\n[ \t\r]*\n")), whole)
    size = lambda x: F.size(F.array_distinct(F.slice("b", x["start"] + 1, x["stop"] - x["start"] - 1)))
    met = lambda x: F.transform(F.filter("spans", lambda s: (s["start"] < x["stop"]) & (s["stop"] > x["start"])), lambda s: s["p"])
    scored = both.withColumn("spans", spans).withColumn("xs", F.filter(F.transform("xs", lambda x: x.withField("dice", 2 * x["shared"] / (size(x) + x["t_size"]))), lambda x: x["dice"] >= threshold))
    return scored.select("doc_id", "k", F.explode(F.transform("xs", lambda x: x.withField("over", met(x)))).alias("x")).select("doc_id", "k", "x.start", "x.stop", "x.licence", "x.shared", "x.dice", "x.over")


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document: doc_id, license, dice (both null without a match), n_licenses and n_passages that match.

    The best match counts; of equal ones, the first licence by name.  Windows that meet a matching passage
    are left out; of the others, the one that shares most counts, if its Dice coefficient is higher than
    that of the best passage, and windows that overlap are one passage.  Whole texts of any length are
    scanned; a null or empty text has no passage; rows of one id, null too, count as one document whose
    passages are those of all rows; other columns of ``docs`` are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = [(i, licence, len(b), *size_bounds(len(b), threshold), p) for i, (licence, words) in enumerate(templates()) for b in [_bigrams(words)] for p in b]
    table = F.broadcast(spark.createDataFrame(rows, "template int, licence string, t_size int, low int, high int, pair string"))  # some thousand rows, fixed by the templates
    least, most = min(r[3] for r in rows), max(r[4] for r in rows)
    some = candidates(docs, threshold)
    words = some.select("doc_id", F.explode(passages(some["text"])).alias("passage")).select("doc_id", "passage", normal_words(F.col("passage")).alias("w"))
    # a passage of few words has fewer bigrams; one of very many may repeat a few, so only the lower bound can be used on words
    sized = words.filter(F.size("w") > least).select("doc_id", "passage", bigrams(F.col("w")).alias("b"))
    pairs = sized.filter(F.size("b").between(least, most)).select("doc_id", F.xxhash64("passage").alias("p"), F.size("b").alias("n"), F.explode("b").alias("pair_"))
    hits = pairs.join(table, (F.col("pair_") == F.col("pair")) & F.col("n").between(F.col("low"), F.col("high")))
    shared = hits.groupBy("doc_id", "p", "template", "licence", "t_size", "n").agg(F.count("pair").alias("shared"))
    dice = shared.withColumn("dice", 2 * F.col("shared") / (F.col("n") + F.col("t_size")))
    good = F.col("dice") >= threshold
    best = F.min(F.when(good, F.struct((-F.col("dice")).alias("d"), "licence"))).alias("best")
    found = dice.groupBy(F.col("doc_id").alias("f_id")).agg(best, F.collect_set(F.when(good, F.col("licence"))).alias("licences"), F.collect_set(F.when(good, F.col("p"))).alias("ps"))
    w = windows(some, threshold).groupBy(F.col("doc_id").alias("id")).agg(F.sort_array(F.collect_set(F.struct("k", "start", "stop", "licence", "shared", "dice", "over"))).alias("w"))
    all_ = docs.select("doc_id").distinct().join(found, F.col("doc_id").eqNullSafe(F.col("f_id")), "left").join(w, F.col("doc_id").eqNullSafe(F.col("id")), "left")
    for c, kind in (("licences", "array<string>"), ("ps", "array<bigint>"), ("w", w.schema["w"].dataType)):
        all_ = all_.withColumn(c, F.coalesce(c, F.array().cast(kind)))
    all_ = all_.withColumn("w", F.filter("w", lambda x: ~F.arrays_overlap(x["over"], "ps")))
    most_shared = F.array_min(F.transform("w", lambda x: F.struct((-x["shared"]).alias("s"), (-x["dice"]).alias("d"), x["licence"].alias("licence"))))
    none = F.struct(F.lit(0).alias("n"), F.lit(None).cast("bigint").alias("k"), F.lit(0).alias("reach"))
    # windows are in order of text and start; one that begins where none before reaches is a new passage
    fresh = lambda acc, x: acc["k"].isNull() | (acc["k"] != x["k"]) | (x["start"] >= acc["reach"])
    step = lambda acc, x: F.struct((acc["n"] + fresh(acc, x).cast("int")).alias("n"), x["k"].alias("k"), F.when(fresh(acc, x), x["stop"]).otherwise(F.greatest(acc["reach"], x["stop"])).alias("reach"))
    islands = F.aggregate("w", none, step, lambda acc: acc["n"])
    all_ = all_.withColumn("top", most_shared)
    top = F.when(F.col("best").isNull() | (F.col("top.d") < F.col("best.d")), F.struct(F.col("top.d").alias("d"), F.col("top.licence").alias("licence"))).otherwise(F.col("best"))
    top = F.when(F.col("top").isNull(), F.col("best")).otherwise(top)
    n_licenses = F.size(F.array_union("licences", F.transform("w", lambda x: x["licence"]))).cast("bigint")
    return all_.select("doc_id", top["licence"].alias("license"), (-top["d"]).alias("dice"), n_licenses.alias("n_licenses"), (F.size("ps") + islands).cast("bigint").alias("n_passages"))


def oracle() -> str:
    """The query in DuckDB's SQL."""
    values = ", ".join(f"({i}, '{licence}', {len(b)}, '{p}')" for i, (licence, words) in enumerate(templates()) for b in [_bigrams(words)] for p in b)
    return f"""
WITH t(template, licence, t_size, pair) AS (VALUES {values}),
d AS (SELECT DISTINCT doc_id, unnest(string_split(text, chr(10)) || string_split_regex(text, '\\n[ \\t\\r]*\\n') || [text]) AS passage FROM documents),
w AS (SELECT doc_id, row_number() OVER () AS p, regexp_extract_all(lower(passage), '[a-z0-9]+') AS w FROM d),
b AS (SELECT DISTINCT doc_id, p, w[i] || ' ' || w[i + 1] AS pair FROM (SELECT *, unnest(range(1, len(w))) AS i FROM w)),
n AS (SELECT p, count(*) AS n FROM b GROUP BY p),
s AS (SELECT doc_id, p, template, licence, t_size, count(*) AS shared FROM b JOIN t USING (pair) GROUP BY ALL),
c AS (SELECT *, 2.0::DOUBLE * shared / (n + t_size) AS dice FROM s JOIN n USING (p)),
r AS (SELECT doc_id, licence, dice, p, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, licence) AS k FROM c WHERE dice >= {THRESHOLD}),
a AS (SELECT doc_id, count(DISTINCT licence) AS n_licenses, count(DISTINCT p) AS n_passages FROM r GROUP BY doc_id)
SELECT d.doc_id, r.licence AS license, r.dice, coalesce(a.n_licenses, 0) AS n_licenses, coalesce(a.n_passages, 0) AS n_passages
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN r ON r.doc_id = d.doc_id AND r.k = 1 LEFT JOIN a ON a.doc_id = d.doc_id
"""
