"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, word shingles (repeats
count), XXH64 with seed 42 of each; a bit is 1 where more than half of the hashes have it.

Linking at up to ``radius`` differing bits: cut the 64 bits in two halves. Two linked
fingerprints differ in at most ``radius // 2`` bits of one half, so on that half the ball
of variants around one meets the other. Every distinct fingerprint emits, for each half,
all variants within half the radius (33 for radius 3), and the variants are the shuffle
key. In the rows of one variant, those who own it are verified on all 64 bits against
the others, and a spanning forest of the verified links is kept instead of all pairs.
Emitting full-width balls needs 2,081 variants a fingerprint for radius 3; this needs 66.

Edge cases: no words (empty or missing text): fingerprint zero, linked like any other.
Fewer words than a shingle: the whole sequence is one shingle. Repeated rows and exact
copies share a fingerprint and are handled once. A missing id never becomes a component's
name; a group of only missing ids has a missing component. Empty input: empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pack, salted_lookup, ship, stored, text_of, unpack

SHINGLE, RADIUS, HALF = 3, 3, 32
_WORDS = re.compile(rb"[^\x20\x09-\x0d]+")
#: hashes turned to bits at a time: bounds memory on very long texts
_SLICE = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text as a signed integer."""
    words = _WORDS.findall(text.encode("utf-8", "surrogatepass").lower())
    if not words:
        return 0
    parts = [b" ".join(words)] if len(words) < shingle else list(
        map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)))
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=42), parts), dtype=">u8", count=len(parts))
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(parts), _SLICE):
        ones += np.unpackbits(hashes[at:at + _SLICE].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(parts)).tobytes(), "big", signed=True)


def _fingerprint_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        prints = [fingerprint(t.as_py(), shingle) for t in b.column("text")]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row_key"), pa.array(prints, pa.int64())],
                                         names=["doc_id", "row_key", "fp"])


def _row_key(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id, text)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, row_key, fp) of every row; row_key is a hash of id and text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.select("doc_id", _row_key(F.col("doc_id"), F.col("text")).alias("row_key"), "text")
    return rows.mapInArrow(partial(_fingerprint_batches, shingle=shingle), "doc_id long, row_key long, fp long")


def _flips(bits: int, within: int) -> list[int]:
    return [sum(1 << i for i in c) for r in range(within + 1) for c in combinations(range(bits), r)]


def variants(prints: DataFrame, radius: int) -> DataFrame:
    """(variant, fp): for each half, the half's ball of ``radius // 2`` bits. The variant's
    bit 32 says which half it is of."""
    fp, low = F.col("fp"), F.lit((1 << HALF) - 1)
    ball = F.array(*[F.lit(x).cast("long") for x in _flips(HALF, radius // 2)])
    halves = F.array(fp.bitwiseAND(low), F.shiftrightunsigned(fp, HALF).bitwiseOR(F.lit(1 << HALF)))
    return (prints.select("fp", F.explode(halves).alias("half"))
            .select("fp", "half", F.explode(ball).alias("flip"))
            .select("fp", F.col("half").bitwiseXOR(F.col("flip")).alias("variant")))


def _forest(prints: np.ndarray, owns: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (smaller member, larger member) that connect what verified links connect."""
    root = np.arange(len(prints))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i in np.flatnonzero(owns):
        near = np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= radius)
        for j in near:
            a, b = find(i), find(int(j))
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((int(i), int(j)))
    return out


def _verified(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by variant; a variant's rows may run on into the next batch."""
    left: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        prints = fps.view(np.uint64)
        half = np.where(keys >> HALF & 1, prints >> np.uint64(HALF), prints & np.uint64((1 << HALF) - 1))
        owns = half == (keys & ((1 << HALF) - 1)).astype(np.uint64)
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
        sizes = np.diff(np.r_[starts, len(keys)])
        owners = np.add.reduceat(owns, starts) if len(keys) else sizes
        a, b = [], []
        for s in np.flatnonzero((sizes > 1) & (owners > 0)):
            at, to = starts[s], starts[s] + sizes[s]
            for i, j in _forest(prints[at:to], owns[at:to], radius):
                a.append(int(fps[at + i]))
                b.append(int(fps[at + j]))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in batches:
        keys = np.concatenate([left[0], batch.column(0).to_numpy()])
        fps = np.concatenate([left[1], batch.column(1).to_numpy()])
        cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        if cut:
            yield links(keys[:cut], fps[:cut])
        left = keys[cut:], fps[cut:]
    yield links(*left)


def near_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) fingerprints within ``radius`` bits: enough of them to connect every group.
    ``prints`` has one row a distinct fingerprint."""
    keyed = variants(prints, radius).select("variant", "fp")
    return (keyed.repartition("variant").sortWithinPartitions("variant")
            .mapInArrow(partial(_verified, radius=radius), "a long, b long")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def connected(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label) of every node of ``links`` (a < b); label: the smallest node reachable.

    Alternating large-star and small-star steps on written tables until the links no
    longer change; every link then goes from a node to its component's smallest.
    """
    def mark(e: DataFrame) -> tuple:
        r = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    edges = stored(links, "links")
    seen = mark(edges)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(low, "a").where(F.col("b") > F.col("a"))
                 .select(F.col("m").alias("a"), "b").where("a < b").distinct())
        # small star: each node points its smaller neighbours, and itself, at the smallest
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (large.join(low, "b").select(F.explode(F.array("a", "b")).alias("b"), F.col("m").alias("a"))
                 .where("a < b").select("a", "b").distinct())
        edges = stored(small, "links")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return (edges.select(F.col("b").alias("node"), F.col("a").alias("label"))
            .unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct()))


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int) -> DataFrame:
    """(doc_id, row_key, fp, n, label, component_id) of every row; label names the group."""
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    total = prints.count()
    reps = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "prints")
    labels = connected(near_links(reps.select("fp"), radius))
    labelled = stored(reps.join(labels.withColumnRenamed("node", "fp"), "fp"), "labelled")
    groups = labelled.groupBy("label").agg(F.min("rep").alias("first"), F.count("*").alias("members"))
    merged = salted_lookup(labelled, groups, "label", "members", total, F.xxhash64("fp")).select(
        "fp", "label", "first")
    named = reps.join(merged, "fp", "left").select(
        "fp", "n", F.coalesce("label", "fp").alias("label"),
        F.when(F.col("label").isNull(), F.col("rep")).otherwise(F.col("first")).alias("component_id"))
    return salted_lookup(prints, named, "fp", "n", total, F.xxhash64("doc_id", "row_key"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id, fingerprint_rows) of every row."""
    return _grouped(docs, id_col, text_col, shingle, radius).select(
        "doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id", F.col("n").alias("fingerprint_rows"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns: the row with the
    smallest id (of several with that id or of a group without ids, the smallest hash of
    id and text; of equal rows, one)."""
    best = _grouped(docs, id_col, text_col, shingle, radius).groupBy("label").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("best"))
    key = _row_key(F.col("row").getField(id_col).cast("long"),
                   F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit("")))
    rows = pack(docs).withColumn("k", key).withColumn("id", F.col("row").getField(id_col).cast("long"))
    best = best.select(F.col("best.doc_id").alias("best_id"), F.col("best.row_key").alias("best_key"))
    kept = (rows.join(best, F.col("id").eqNullSafe(F.col("best_id")) & (F.col("k") == F.col("best_key")), "left_semi")
            .dropDuplicates(["id", "k"]))
    return unpack(kept, docs.columns)


ship(__name__)
