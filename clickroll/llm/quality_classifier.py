"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-
leader (FTRL-proximal) updates, scores as sparse dot products.

Features of a text: its words ``[^\\x20\\x09-\\x0D]+``, pairs of neighbouring words, and the
same two over word shapes (letters and digits folded to classes, runs to one; a pair of
shapes also says whether the words are equal), each hashed into 2**bits slots. Values are
shares of all features, times SCALE. Nothing but the text is an input. In training both
classes weigh the same in total.

The fit takes at most ``max_rows`` labelled rows, those with the smallest hash of their
id, so the model and the rows that make it have a fixed bound: one task trains, and the
non-zero weights (at most 2**bits) go to every scoring task. All documents are scored.

Edge cases: empty or missing text scores by the bias alone. Labels with a missing id or
quality are left out; several labels of one id count as their mean, rounded up. Without
labels every score is 0.5; with one class the model is that class's prior. Repeated
documents are scored each. Empty input: empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, text_of

BITS, MAX_ROWS, EPOCHS = 18, 8192, 2
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.005, 0.01
#: what a text's feature values sum up to
SCALE = 10.0
#: a document is kept from this score on
THRESHOLD = 0.3
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SHAPE = [(re.compile(p), r) for p, r in ((r"[^\W\d_]*[A-Z][^\W\d_]*[A-Z][^\W\d_]*", "A"), (r"[^\W\d_]+", "a"), (r"[0-9]+", "0"), (r"(\W)\1+", r"\1\1"))]
_REMEMBERED = 300_000


class Features:
    """Slots of a text's features; hashes of recent words are remembered."""

    def __init__(self, bits: int):
        self.mask = np.uint32((1 << bits) - 1)
        self.seen: dict[str, int] = {}

    def _hash(self, word: str) -> int:
        core = word.rstrip(".,")
        if core.isalpha() and (core[1:].islower() or len(core) == 1) and len(word) - len(core) < 2:
            shape = "a" + word[len(core):]  # what the patterns give for a plain word
        else:
            shape = word
            for pattern, by in _SHAPE:
                shape = pattern.sub(by, shape)
        got = crc32(word.encode("utf-8", "surrogatepass")) << 32 | crc32(b"\0" + shape.encode("utf-8", "surrogatepass"))
        if len(self.seen) >= _REMEMBERED:
            self.seen.clear()
        if len(word) <= 64:
            self.seen[word] = got
        return got

    def __call__(self, text: str) -> np.ndarray:
        """Slots of all features, repeats included."""
        known = self.seen
        words = _WORD.findall(text)
        for w in set(words).difference(known):
            self._hash(w)
        h = np.fromiter((known[w] if w in known else self._hash(w) for w in words), np.uint64, len(words))
        both = h.view(np.uint32).reshape(-1, 2)  # shape and word
        two = (both[:-1] * np.uint32(0x9E3779B1)) ^ (both[1:] * np.uint32(0x85EBCA77))
        two[:, 0] ^= (h[1:] == h[:-1]).astype(np.uint32) * np.uint32(0x27D4EB2F)
        two ^= two >> np.uint32(15)
        one = both * np.uint32(0xC2B2AE3D)
        one ^= one >> np.uint32(13)
        return (np.concatenate([one.ravel(), two.ravel()]) & self.mask).astype(np.int64)


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


def _train(batches: Iterator[pa.RecordBatch], bits: int, epochs: int) -> Iterator[pa.RecordBatch]:
    """FTRL-proximal over the rows, in their order; slot -1 is the bias."""
    of, rows = Features(bits), []
    for b in batches:
        for k, t, y in zip(b.column(0), b.column(1), b.column(2), strict=True):
            slots, counts = np.unique(of(t.as_py()), return_counts=True)
            rows.append((k.as_py(), slots, counts * (SCALE / max(1, counts.sum())), float(y.as_py())))
    rows.sort(key=lambda r: r[0])
    ones = sum(r[3] for r in rows)
    share = {1.0: len(rows) / max(1.0, 2 * ones), 0.0: len(rows) / max(1.0, 2 * (len(rows) - ones))}
    if ones in (0, len(rows)):
        share = {1.0: 1.0, 0.0: 1.0}
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(i: np.ndarray) -> np.ndarray:
        w = -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(z[i]) <= L1, 0.0, w)

    for _ in range(epochs):
        for _, slots, values, y in rows:
            i, x = np.append(slots, size), np.append(values, 1.0)
            w = weights(i)
            g = (_sigmoid(float(w @ x)) - y) * share[y] * x
            s = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - s * w
            n[i] += g * g
    w = weights(np.arange(size + 1))
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([pa.array(np.where(at == size, -1, at)), pa.array(w[at])], names=["slot", "weight"])


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS,
                  usable: Column | None = None) -> DataFrame:
    """(k, text, y) of at most ``max_rows`` labelled documents: the smallest hashes of ids."""
    picked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y"))
    picked = picked.where(F.col("doc_id").isNotNull() & F.col("y").isNotNull())
    if usable is not None:
        picked = picked.where(usable)
    picked = (picked.groupBy("doc_id").agg(F.round(F.avg("y")).alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    found = texts.join(F.broadcast(picked), "doc_id")  # at most max_rows ids
    return found.select(F.xxhash64("doc_id", "text").alias("k"), "text", "y").orderBy("k").limit(max_rows)


def fit(rows: DataFrame, bits: int = BITS, epochs: int = EPOCHS) -> dict[int, float]:
    """Non-zero weights by slot from (k, text, y) rows of a bounded sample."""
    got = rows.coalesce(1).mapInArrow(partial(_train, bits=bits, epochs=epochs), "slot long, weight double")
    return {r.slot: r.weight for r in got.collect()}


def _score(slots: np.ndarray, weights: np.ndarray, bias: float) -> float:
    """Sparse dot product of the features' shares with the weights, through the logistic."""
    dot = float(weights[slots].sum()) * (SCALE / len(slots)) if len(slots) else 0.0
    return round(_sigmoid(dot + bias), 9)


def _scored(batches: Iterator[pa.RecordBatch], model, bits: int) -> Iterator[pa.RecordBatch]:
    weights, bias = model.value
    of = Features(bits)
    for b in batches:
        scores = []
        for t in b.column(1):
            scores.append(_score(of(t.as_py()), weights, bias))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], names=[b.schema.names[0], "score"])


def _model(spark, weights: dict[int, float], bits: int):
    dense = np.zeros(1 << bits, dtype=np.float64)
    for slot, w in weights.items():
        if slot >= 0:
            dense[slot] = w
    return spark.sparkContext.broadcast((dense, weights.get(-1, 0.0)))


def score(docs: DataFrame, weights: dict[int, float], bits: int = BITS) -> DataFrame:
    """(doc_id, score) of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    return rows.mapInArrow(partial(_scored, model=_model(docs.sparkSession, weights, bits), bits=bits),
                           "doc_id long, score double")


def _passing(batches: Iterator[pa.RecordBatch], model, bits: int, column: str, threshold: float) -> Iterator[pa.RecordBatch]:
    weights, bias = model.value
    of = Features(bits)
    for b in batches:
        texts = b.column(b.schema.get_field_index(column))
        keep = []
        for t in texts:
            keep.append(_score(of(t.as_py() or ""), weights, bias) >= threshold)
        yield b.filter(pa.array(keep, pa.bool_()))


def keep_good(docs: DataFrame, weights: dict[int, float], bits: int = BITS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, all columns, that the model does not reject."""
    return docs.mapInArrow(partial(_passing, model=_model(docs.sparkSession, weights, bits), bits=bits,
                                   column="text", threshold=threshold), docs.schema)


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 5 == 0, F.lit(False))


ship(__name__)
