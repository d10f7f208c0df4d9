"""Language identification by nearest centroids.

A text's vector holds its character n-grams (1 to 4 code points of the lower-cased text,
everything but letters folded to one space), hashed into 2**BITS slots. A slot's value is
1 + log(count), times its inverse document frequency; vectors have length one.

Each language has up to CLUSTERS centroids (spherical k-means over its vectors, first
centroids farthest from those before). A text takes the language of the centroid with the
greatest cosine (ties to the smaller language value); ``score`` is that cosine. It is
``rejected`` if it lies farther from the centroid than ``reach`` says, the distance within
which the centroid's own training vectors lie but for outliers. A rejected text keeps its
nearest language, so callers choose what to do with it.

Document frequencies are counted over all learning rows. Centroids are fitted on at most
MAX_ROWS of them a language, those with the smallest hashes of id and text, one language a
task; only they and the frequencies go to the scoring tasks, at most MAX_LANGUAGES *
CLUSTERS * 2**BITS numbers. More language values than MAX_LANGUAGES raise an error.

Edge cases: a text that is missing, empty or has no letter is ``und`` with score 0 and
rejected. Learning rows without language or letters are left out. Without learning rows
every text is ``und``. Repeated rows are scored each. Very long texts are taken whole.
Empty input: empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored

BITS, GRAMS = 14, 4
CLUSTERS, MAX_ROWS, MAX_LANGUAGES, STEPS = 3, 1024, 256, 8
#: standard deviations of the members' distances that still belong to a centroid
REACH = 4.0
UNKNOWN = "und"
#: texts that are scored as one matrix
TOGETHER = 64
_SPACE = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def _points(text: str) -> np.ndarray:
    """Lower-case letters as code points, everything between them as one space, a space
    at both ends; nothing for a text without letters."""
    x = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[x]
    if not letter.any():
        return np.empty(0, np.uint32)
    x = np.concatenate([[_SPACE], np.where(letter, x, _SPACE), [_SPACE]]).astype(np.uint32)
    blank = x == _SPACE
    keep = np.ones(len(x), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    return x[keep]


def counts(text: str | None, bits: int = BITS) -> np.ndarray | None:
    """How often each slot occurs in the text; None if it has no letter."""
    x = _points(text or "")
    if not len(x):
        return None
    found, h = [], np.zeros(len(x), np.uint32)
    for n in range(min(GRAMS, len(x))):
        h = (h[:len(x) - n] ^ x[n:]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        found.append(h[1:] if n == 0 else h)  # the first single is the space at the front
    slots = np.concatenate(found) >> np.uint32(0)
    return np.bincount((slots * np.uint32(0x85EBCA77)) >> np.uint32(32 - bits), minlength=1 << bits)


def vector(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The normalised TF-IDF vector."""
    out = np.zeros(len(found), np.float32)
    at = np.flatnonzero(found)
    out[at] = (1 + np.log(found[at])) * idf[at]
    size = np.sqrt(float(out @ out))
    return out / size if size else out


@dataclass
class Model:
    """``languages`` and ``reach`` have an item a centroid; ``centroids`` a row."""

    idf: np.ndarray
    languages: list[str]
    centroids: np.ndarray
    reach: np.ndarray


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts have each slot; slot -1 counts the texts."""
    total, n = np.zeros(1 << BITS, np.int64), 0
    for b in batches:
        for t in b.column(0):
            found = counts(t.as_py())
            if found is not None:
                total += found > 0
                n += 1
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))], names=["slot", "n"])


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [counts(t.as_py()) for t in b.column(2)]
        at = [None if f is None else np.flatnonzero(f) for f in found]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(at, pa.list_(pa.int64())),
             pa.array([None if f is None else f[a] for f, a in zip(found, at, strict=True)], pa.list_(pa.int64()))],
            names=["lang", "k", "slots", "counts"])


def cluster(vectors: np.ndarray, clusters: int = CLUSTERS, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, reach) of one language: spherical k-means. Equal vectors share a
    centroid; a centroid that loses all its vectors goes."""
    mean = vectors.mean(axis=0)
    first = [int(np.argmax(vectors @ mean))]
    near = vectors @ vectors[first[0]]
    while len(first) < clusters and near.min() < 1 - 1e-6:
        first.append(int(np.argmin(near)))
        near = np.maximum(near, vectors @ vectors[first[-1]])
    centroids = vectors[first]
    for _ in range(steps):
        owner = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.stack([vectors[owner == c].sum(axis=0) for c in range(len(centroids)) if (owner == c).any()])
        centroids = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    cosines = vectors @ centroids.T
    owner = np.argmax(cosines, axis=1)
    away = 1 - cosines[np.arange(len(vectors)), owner]
    reach = [float(d.mean() + REACH * d.std()) if len(d := away[owner == c]) else 0.0 for c in range(len(centroids))]
    return centroids, np.array(reach)


def _clusters(rows: pd.DataFrame, idf: np.ndarray) -> pd.DataFrame:
    vectors = np.zeros((len(rows), len(idf)), np.float32)
    for i, (slots, n) in enumerate(zip(rows["slots"], rows["counts"], strict=True)):
        found = np.zeros(len(idf), np.int64)
        found[np.asarray(slots, np.int64)] = n
        vectors[i] = vector(found, idf)
    centroids, reach = cluster(vectors)
    at = [np.flatnonzero(c) for c in centroids]
    return pd.DataFrame({"lang": rows["lang"].iloc[0], "cluster": range(len(centroids)), "reach": reach, "slots": at,
                         "weights": [c[a].astype(float) for c, a in zip(centroids, at, strict=True)]})


def fit(rows: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """The model of (doc_id, lang, text) learning rows; rows without language count nothing."""
    spark = rows.sparkSession
    rows = rows.where(F.col("lang").isNotNull())
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    spread = rows.select("text").mapInArrow(_frequencies, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    frequency = {r.slot: r.n for r in spread.collect()}
    total = frequency.pop(-1, 0)
    idf = np.zeros(1 << BITS, np.float32)
    for slot, n in frequency.items():
        idf[slot] = np.log((1 + total) / (1 + n)) + 1
    if not total:
        return Model(idf, [], np.zeros((0, 1 << BITS), np.float32), np.zeros(0))
    # a hash below a language's share first, so that the ranking meets few rows a language
    share = F.element_at(F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, 2.0 * max_rows / n))]), F.col("lang"))
    k = F.xxhash64("doc_id", "text")
    drawn = rows.select("lang", k.alias("k"), "text").where(F.pmod(k, F.lit(1 << 30)) < share * float(1 << 30))
    drawn = stored(drawn.mapInArrow(_sparse, "lang string, k long, slots array<long>, counts array<long>").where("slots is not null"), "language-sample")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("k"))
    drawn = drawn.withColumn("_rank", rank).where(F.col("_rank") <= max_rows).drop("_rank")
    held = spark.sparkContext.broadcast(idf)
    found = drawn.groupBy("lang").applyInPandas(lambda x: _clusters(x.sort_values("k"), held.value),
                                                "lang string, cluster int, reach double, slots array<long>, weights array<double>")
    lines = sorted(found.collect(), key=lambda r: (r.lang, r.cluster))
    centroids = np.zeros((len(lines), 1 << BITS), np.float32)
    for i, r in enumerate(lines):
        centroids[i, r.slots] = r.weights
    return Model(idf, [r.lang for r in lines], centroids, np.array([r.reach for r in lines]))


def nearest(texts: list[str | None], model: Model) -> list[tuple[str, float, bool]]:
    """(language, score, rejected) of each text."""
    out: list[tuple[str, float, bool]] = [(UNKNOWN, 0.0, True)] * len(texts)
    if not model.languages:
        return out
    for a in range(0, len(texts), TOGETHER):
        found = [(i, c) for i, t in enumerate(texts[a:a + TOGETHER], a) if (c := counts(t)) is not None]
        if not found:
            continue
        cosines = np.stack([vector(c, model.idf) for _, c in found]) @ model.centroids.T
        best = np.argmax(cosines, axis=1)
        for (i, _), b, row in zip(found, best, cosines, strict=True):
            score = float(row[b])
            out[i] = (model.languages[b], round(min(1.0, max(0.0, score)), 6), bool(1 - score > model.reach[b]))
    return out


def _predicted(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    model = Model(*held.value)
    for b in batches:
        got = nearest(b.column(1).to_pylist(), model)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                                          pa.array([g[2] for g in got], pa.bool_())], names=["doc_id", "lang_pred", "score", "rejected"])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # plain parts: a broadcast names its classes, which workers may not be able to import
    held = docs.sparkSession.sparkContext.broadcast((model.idf, model.languages, model.centroids, model.reach))
    return rows.mapInArrow(partial(_predicted, held=held), "doc_id long, lang_pred string, score double, rejected boolean")


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected), learnt from the rows not held out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    model = fit(rows.where(~held_out(F.col("doc_id"))))
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


ship(__name__)
