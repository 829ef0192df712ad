"""Language identification: nearest centroids of TF-IDF n-gram vectors by cosine, with rejection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import texts as T
from .quality import free_name

#: N-grams of two and three bytes of lower-case words are counted in so many hashed places each.
PLACES = 2048
#: About so many labelled documents of each language train the centroids, about 4096 of all languages together, and never over
#: twice as many; drawn by a hash of id and text. Beyond so many languages the most frequent are learned.
SAMPLE = 512
SAMPLE_TOTAL = 4096
CENTROIDS = 3
#: A text is rejected if its cosine is under this part of what nearly all training texts of that language reach.
REJECT_BELOW = 0.5
UNKNOWN = "und"
_ROWS = 512

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[:128] = [c if chr(c).isalpha() else 32 for c in range(128)]


def vectors(texts: pa.Array) -> Iterator[np.ndarray]:
    """Counts of hashed n-grams, a row for each text, some hundred rows at a time; whole texts are counted."""
    lower = pc.utf8_lower(texts)
    for at in range(0, len(lower), _ROWS):
        part = lower.slice(at, _ROWS)
        data, starts = T.utf8(part)
        row = np.repeat(np.arange(len(part), dtype=np.int64), np.diff(starts))
        c = _FOLD[data]
        out = np.zeros((len(part), 2 * PLACES), np.float32)
        for n, base in ((2, 0), (3, PLACES)):
            if len(c) < n:
                continue
            h = np.zeros(len(c) - n + 1, np.uint32)
            for k in range(n):
                h = h * np.uint32(0x01000193) + c[k : len(c) - n + 1 + k]
            h = (h * np.uint32(0x9E3779B1)) >> np.uint32(21)
            # n-grams within one text, without those that are all space
            ok = (row[: len(h)] == row[n - 1 :]) & ((c[: len(h)] != 32) | (c[1 : len(h) + 1] != 32))
            out[:, base : base + PLACES] = np.bincount((row[: len(h)] * PLACES + h)[ok], minlength=len(part) * PLACES).reshape(len(part), PLACES)
        yield out


@dataclass(frozen=True)
class Model:
    """Centroids of unit length, the language of each, and the cosine below which it rejects."""

    idf: np.ndarray
    centroids: np.ndarray
    langs: list[str]
    floors: np.ndarray

    def weigh(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _clusters(x: np.ndarray, k: int, steps: int = 12) -> np.ndarray:
    """Spherical k-means; starts at the mean's farthest rows, so equal input gives equal centroids."""
    unit = lambda v: v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-12)
    centres = unit(x.mean(0))[None]
    while len(centres) < min(k, len(x)):
        centres = np.vstack([centres, x[(x @ centres.T).max(1).argmin()]])
    for _ in range(steps):
        near = (x @ centres.T).argmax(1)
        centres = np.vstack([unit(x[near == j].mean(0)) if (near == j).any() else centres[j] for j in range(len(centres))])
    return centres


def train(rows: list[tuple[str, np.ndarray]], centroids: int = CENTROIDS) -> Model | None:
    """``rows``: language and n-gram counts of labelled texts; None if there are none."""
    if not rows:
        return None
    langs = np.array([r[0] for r in rows])
    counts = np.stack([r[1] for r in rows])
    idf = (np.log((1 + len(rows)) / (1 + (counts > 0).sum(0))) + 1).astype(np.float32)
    model = Model(idf, np.zeros((0, len(idf)), np.float32), [], np.zeros(0))
    x, centres, names, floors = model.weigh(counts), [], [], []
    for lang in sorted(set(langs.tolist())):
        own = x[langs == lang]
        found = _clusters(own, centroids)
        floors += [REJECT_BELOW * float(np.quantile((own @ found.T).max(1), 0.01))] * len(found)
        centres.append(found)
        names += [lang] * len(found)
    return Model(idf, np.vstack(centres).astype(np.float32), names, np.array(floors))


def fit(labelled: DataFrame, sample: int = SAMPLE, total: int = SAMPLE_TOTAL) -> Model | None:
    """Train on the columns doc_id, text and lang; rows without a language are no use.

    Different rows of each language are counted over all rows; then about ``sample`` of each are drawn by a hash
    of doc_id and text, and their n-gram counts, of fixed size, reach the driver.  Rows that repeat both are one, so
    neither null ids nor copies can swell the sample, and twice ``total`` rows are the most in any case.
    """
    labelled = labelled.select("doc_id", "text", "lang").filter("lang is not null and text is not null")
    own = F.xxhash64(F.lit("language sample"), "doc_id", "text")
    labelled = labelled.withColumn("h", own)
    by = labelled.groupBy("lang").agg(F.count("*").alias("rows"), F.approx_count_distinct("h").alias("n"))
    seen = {r["lang"]: max(1, r["n"]) for r in by.orderBy(F.desc("rows"), "lang").limit(total).collect()}
    if not seen:
        return None
    share = min(sample, max(1, total // len(seen)))
    rate = F.element_at(F.create_map(*(F.lit(v) for k, n in sorted(seen.items()) for v in (k, min(1.0, share / n)))), F.col("lang"))
    drawn = labelled.filter(F.pmod("h", F.lit(1 << 40)) < F.coalesce(rate, F.lit(0.0)) * (1 << 40))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, part in enumerate(T.slices(b.column("text"), 1)):
                row = np.minimum(next(vectors(part))[0], 65535).astype("<u2").tobytes()
                yield pa.RecordBatch.from_arrays([b.column("h").slice(i, 1), b.column("lang").slice(i, 1), pa.array([row], pa.binary())], ["h", "lang", "v"])

    sample_of = drawn.mapInArrow(counted, "h bigint, lang string, v binary").dropDuplicates(["h", "lang"])
    rows = sample_of.orderBy("h", "lang").limit(2 * total).collect()
    rows.sort(key=lambda r: (r["lang"], r["h"]))
    return train([(r["lang"], np.frombuffer(r["v"], "<u2").astype(np.float32)) for r in rows])


_TYPE = "struct<lang:string,score:double,rejected:boolean>"


def predict(text: Column, model: Model | None) -> Column:
    """A struct of lang, score (the cosine, 0 to 1) and rejected, for a column of text.

    Without a letter, for null, or without a model, lang is ``und``, score 0 and rejected true.
    """

    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names, floors = pa.array(model.langs) if model else pa.array([], pa.string()), model.floors if model else None
        for batch in batches:
            best, score = [], []
            for part in T.slices(batch):
                for counts in vectors(part) if model else ():
                    cosine = model.weigh(counts) @ model.centroids.T
                    best.append(cosine.argmax(1))
                    score.append(np.clip(cosine.max(1), 0, 1).astype(float))
            if not score:
                n = len(batch)
                yield pa.StructArray.from_arrays([pa.nulls(n, pa.string()), pa.array(np.zeros(n)), pa.array(np.ones(n, bool))], ["lang", "score", "rejected"])
                continue
            best, score = np.concatenate(best), np.concatenate(score)
            yield pa.StructArray.from_arrays([names.take(pa.array(best)), pa.array(score), pa.array(score < floors[best])], ["lang", "score", "rejected"])

    predicted.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    found = F.arrow_udf(predicted, _TYPE)(text)
    readable = F.coalesce(text.rlike(r"\p{L}"), F.lit(False)) & found["lang"].isNotNull()
    return F.struct(F.when(readable, found["lang"]).otherwise(UNKNOWN).alias("lang"), F.when(readable, found["score"]).otherwise(F.lit(0.0)).alias("score"), (~readable | found["rejected"]).alias("rejected"))


def held_out(doc_id: Column) -> Column:
    """Documents that no model may learn from: the crc32 of their id as text leaves 1, divided by 3; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def identify(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, held_out, lang_pred, score and rejected.

    Learns from the texts and languages of documents that aren't held out; predictions see the text
    alone.  Ties go to the language that sorts first.  A null text, or one without a letter, is
    ``und``, as is every text if no document is labelled.  Whole texts of any length count; repeated rows give
    repeated rows; other columns of ``docs`` are ignored; an empty table gives an empty result.
    """
    model = fit(docs.filter(~held_out(docs["doc_id"])))
    found = docs.select("doc_id", held_out(docs["doc_id"]).alias("held_out"), predict(docs["text"], model).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"), F.col("p.rejected").alias("rejected"))


def language_filter(docs: DataFrame) -> DataFrame:
    """The documents whose language isn't rejected, with their columns, whatever their names.

    Null, empty and letterless texts go, as does every text if no document is labelled; whole texts of any length
    count; repeated rows share their fate and stay as often as they are; an empty table gives an empty result.
    """
    model = fit(docs.filter(~held_out(docs["doc_id"])))
    name = free_name(docs)
    return docs.withColumn(name, predict(docs["text"], model)).filter(~F.col(name)["rejected"]).select(*(docs[f"`{c}`"] for c in docs.columns))
