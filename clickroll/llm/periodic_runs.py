"""Periodic run detection: stretches of words that repeat with a period, found by seeds
extended along diagonals.

A run of smallest period q is a maximal stretch of words in which words q apart are equal,
of length at least max(MIN_LENGTH, 3 * q). On the diagonal of lag q it is a row of at least
max(MIN_LENGTH - q, 2 * q) equal word pairs; that is its guaranteed overlap.

Lags are taken in classes [Q, Q'] with Q' at most (3 * Q + 1) / 2 (the first is 1 to 8).
Each class has an index of k-grams, where k is the smallest guaranteed overlap of its lags.
A seed pairs a k-gram with its next occurrence in the same text at a lag of Q or more. One
seed a position is enough: if a k-gram occurs twice within [Q, Q'] of a position, it has a
period p <= Q' - Q, and as p + q <= k + 1 a run of smallest period q over it would have the
smaller period gcd(p, q), which is a contradiction. So a text of n words has at most n seeds
a class, however often it repeats itself. Seeds are taken in order; a table of the furthest
word covered on each lag suppresses those inside what was already extended.

k-grams are compared by 64-bit hashes; every seed is then compared word by word, and a seed
that fails has its text searched again under other hashes, so results are exact.

Texts are handled in groups of about GROUP words, so that numpy works on long arrays; a
longer text is a group of its own. Work is O(n log n) array operations a text.

Edge cases: a missing or empty text has no words, no run and the digest of an empty string.
Repeated rows are searched each. Empty input: empty result. Texts are whole; time for a text
of one word repeated grows as its length times its logarithm.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, ship

MIN_LENGTH, EXPONENT = 24, 3
GROUP = 150_000
_WORDS = re.compile(WORD)
_FIRST_LAGS = 8


def classes(longest: int) -> Iterator[tuple[int, int, int]]:
    """(Q, Q', k) for all lags that a run in ``longest`` words can have as its period."""
    low, high = 1, _FIRST_LAGS
    while low * EXPONENT <= longest:
        yield low, high, min(max(MIN_LENGTH - q, 2 * q) for q in range(low, high + 1))
        low = high + 1
        high = (3 * low + 1) // 2


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Grams:
    """Hashes of the k-grams that start at given words, apart for different texts; powers
    of two are kept."""

    def __init__(self, words: np.ndarray, begins: np.ndarray, seed: int):
        text = _mix(begins.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64))
        self.levels = [_mix(words.astype(np.uint64) + text)]

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return _mix(a * np.uint64(0xD6E8FEB86659FD93) + _mix(b))

    def at(self, starts: np.ndarray, k: int) -> np.ndarray:
        """Every start has k words after it."""
        level = k.bit_length() - 1
        while len(self.levels) <= level:
            last, reach = self.levels[-1], 1 << (len(self.levels) - 1)
            # entries near the end lack a second half and are never asked for
            self.levels.append(self._pair(last, np.concatenate([last[reach:], last[:reach]])[:len(last)]))
        h = self.levels[level]
        return h[starts] if k == 1 << level else self._pair(h[starts], h[starts + k - (1 << level)])


def _equal_run(a: np.ndarray, b: np.ndarray) -> int:
    """Number of leading pairs that are equal; looks at twice as many each time."""
    at, step, n = 0, 64, min(len(a), len(b))
    while at < n:
        end = min(n, at + step)
        differ = a[at:end] != b[at:end]
        first = int(differ.argmax())
        if differ[first]:
            return at + first
        at, step = end, step * 2
    return n


def _factors(n: int) -> list[int]:
    out, f = [], 2
    while f * f <= n:
        if n % f == 0:
            out.append(f)
            while n % f == 0:
                n //= f
        f += 1
    return out + [n] * (n > 1)


def _is_smallest(words: np.ndarray, start: int, lag: int) -> bool:
    """A stretch of three or more times ``lag`` has a smaller period only if that divides ``lag``."""
    return not any(np.array_equal(words[start:start + lag], words[start + lag // f:start + lag + lag // f]) for f in _factors(lag))


class _Collision(Exception):
    """Two different k-grams with one hash, in the text that has this word."""


def _seeds(grams: _Grams, places: np.ndarray, ends: np.ndarray, low: int, high: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, lag): each place with the next occurrence of its k-gram at a lag of
    ``low`` or more, where that is at most ``high`` and in the same text."""
    h = grams.at(places, k)
    order = np.argsort(h, kind="stable")  # places are ascending, so they are within equal hashes
    at, h = places[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    group = np.cumsum(new) - 1
    width = np.int64(len(ends) + high + 1)
    key = group * width + at
    found = np.searchsorted(key, key + low)
    ok = found < len(key)
    other = np.where(ok, found, 0)
    lag = at[other] - at
    ok &= (group[other] == group) & (lag <= high) & (ends[at] == ends[at[other]])
    return at[ok], lag[ok]


def find_in(words: np.ndarray, bounds: np.ndarray, seed: int = 0) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run; ``words`` are numbered words of texts one
    after the other, and text i is ``words[bounds[i]:bounds[i + 1]]``."""
    longest = int(np.diff(bounds).max(initial=0))
    if longest < MIN_LENGTH:
        return []
    sizes = np.diff(bounds)
    ends, begins = np.repeat(bounds[1:], sizes), np.repeat(bounds[:-1], sizes)
    grams = _Grams(words, begins, seed)
    runs: list[tuple[int, int, int]] = []
    places = None
    for low, high, k in classes(longest):
        if places is None:  # all later classes need a k-gram of the first that occurs again
            places = np.flatnonzero(np.arange(len(words)) + k <= ends)
            h = grams.at(places, k)
            order = np.argsort(h)
            again = np.zeros(len(h), bool)
            same = h[order][1:] == h[order][:-1]
            again[order[1:][same]] = True
            again[order[:-1][same]] = True
            places = places[again]
        places = places[places + k <= ends[places]]
        if not len(places):
            break
        start, lag = _seeds(grams, places, ends, low, high, k)
        order = np.lexsort((start, lag))
        start, lag = start[order], lag[order]
        first = np.ones(len(start), bool)
        first[1:] = (lag[1:] != lag[:-1]) | (start[1:] != start[:-1] + 1)
        last = np.append(np.flatnonzero(first)[1:] - 1, len(start) - 1) if len(start) else first
        covered: dict[int, int] = {}
        for i, j in zip(np.flatnonzero(first), last, strict=True):
            a, z, d = int(start[i]), int(start[j]), int(lag[i])
            if a >= covered.get(d, -1):
                end, begin = int(ends[a]), int(begins[a])
                left = a - _equal_run(words[begin:a][::-1], words[begin + d:a + d][::-1])
                right = a + _equal_run(words[a:end - d], words[a + d:end])
                covered[d] = right
                if right - left + d >= max(MIN_LENGTH, EXPONENT * d) and _is_smallest(words, left, d):
                    runs.append((left, right - left + d, d))
            if z + k > covered[d]:
                raise _Collision(a)
    return runs


def runs_of(words: np.ndarray, bounds: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """The runs of every text, by start, then period; starts count from the text's first word."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(bounds) - 1)]
    seed = 0
    while True:
        try:
            found = find_in(words, bounds, seed)
            break
        except _Collision:
            seed += 1
    for start, length, period in found:
        i = int(np.searchsorted(bounds, start, "right")) - 1
        out[i].append((start - int(bounds[i]), length, period))
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in out]


def numbered(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Words as numbers, equal words alike, and the bounds of the texts."""
    known: dict[str, int] = {}
    flat = [known.setdefault(w, len(known)) for words in texts for w in words]
    return np.array(flat, np.int64), np.cumsum([0] + [len(t) for t in texts])


@dataclass
class Summary:
    n_runs: int
    best: tuple[int, int, int] | None  # start, length, period
    runs_sha256: str
    collapsed: str


def kept(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """Words that no run contains after its first period."""
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, g in zip(words, np.cumsum(gone).tolist(), strict=False) if not g]


def summary(words: list[str], runs: list[tuple[int, int, int]]) -> Summary:
    best = None
    for r in runs:  # by start, then period; a later one wins only with a greater exponent
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    lines = "".join(f"{a},{n},{p}\n" for a, n, p in runs)
    return Summary(len(runs), best, hashlib.sha256(lines.encode()).hexdigest(), " ".join(kept(words, runs) if runs else words))


def planted(words: list[str], doc_id: int | None) -> list[str]:
    """The query's words: those of every tenth id's text (by hash) repeat with a period from some word on."""
    if doc_id is None or not words:
        return words
    h = crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _grouped(batches: Iterator[pa.RecordBatch], plant: bool) -> Iterator[tuple[list, list[list[str]]]]:
    """(ids, words) of texts, about GROUP words at a time."""
    ids, texts, held = [], [], 0
    for b in batches:
        for i, t in zip(b.column(0), b.column(1), strict=True):
            key = i.as_py()
            words = _WORDS.findall(t.as_py() or "")
            ids.append(key)
            texts.append(planted(words, key) if plant else words)
            held += len(words)
            if held >= GROUP:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


RUN = "array<struct<start:long,length:long,period:long>>"
_RUN_TYPE = pa.list_(pa.struct([(f, pa.int64()) for f in ("start", "length", "period")]))


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in _grouped(batches, False):
        runs = runs_of(*numbered(texts))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in x] for x in runs], _RUN_TYPE),
             pa.array([" ".join(kept(w, r)) for w, r in zip(texts, runs, strict=True)], pa.string())],
            names=["doc_id", "runs", "collapsed"])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, runs, collapsed): every run of every text, and the text with each run cut
    down to its first period, words joined by one space."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_found, f"doc_id long, runs {RUN}, collapsed string")


def _digests(batches: Iterator[pa.RecordBatch], plant: bool) -> Iterator[pa.RecordBatch]:
    for ids, texts in _grouped(batches, plant):
        got = [summary(w, r) for w, r in zip(texts, runs_of(*numbered(texts)), strict=True)]
        best = [s.best or (None, None, None) for s in got]
        long = pa.int64()
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, long), pa.array([s.n_runs for s in got], long), *[pa.array([b[i] for b in best], long) for i in range(3)],
             pa.array([1000 * b[1] // b[2] if b[2] else None for b in best], long), pa.array([s.runs_sha256 for s in got]),
             pa.array([hashlib.sha256(s.collapsed.encode("utf-8", "surrogatepass")).hexdigest() for s in got])],
            names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])


def digests(docs: DataFrame, plant: bool = False) -> DataFrame:
    """One line a text: number of runs, the run of greatest exponent, digests of all runs
    and of the collapsed text. ``plant`` first makes every tenth text periodic."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(partial(_digests, plant=plant),
                           "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")


ship(__name__)
