"""Vector code compression: product codes whose codebooks come from a dual-tree Lloyd.

Vectors become integers floor(SCALE * x) and are cut into PARTS equal parts. Each part
position has a codebook of up to ENTRIES entries, refined by ROUNDS rounds of Lloyd and
exact in integers: nearest entry by squared distance, ties to the lower index, means
rounded down, unused entries unchanged.

Rows are first written as blocks (``blocks``): the vectors of one Arrow batch, with a
k-d tree over each part position whose nodes keep bounding boxes and cached sums. A pass
walks these trees against a tree over the entries. Box distances bound what a pair of
nodes can hold: pairs that cannot hold a nearest entry are pruned, a node left with one
entry is assigned whole by its cached sums, and only the leaves that stay uncertain
compare integers. A pass returns one line a slot (part position, entry, component) from
each task; the driver sees PARTS * ENTRIES * (1 + part length) sums, whatever the rows.

Edge cases: rows without a vector or with a missing or non-finite component are dropped.
Shorter vectors are filled with zeros to the longest, and that to a multiple of PARTS; an
empty vector is all zeros. Fewer rows than ENTRIES give that many entries. Repeated ids are
rows of their own, the smaller vector first; missing ids come last. Components count as at
most 2**28 in size (less for parts of over 31 components), so that squared distances fit
64 bits; an error beyond the range of a long counts as its maximum. Without rows the result
is empty.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import salted_lookup, ship, stored

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: rows of a tree's leaf, and the most rows of a block
LEAF, BLOCK = 16, 8192
MAX_LONG = 2**63 - 1


@dataclass
class Tree:
    """Nodes over rows of several part positions at once. ``rows[start:stop]`` are a
    node's rows; ``left`` is the first of its two children, -1 for a leaf."""

    part: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    left: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray
    rows: np.ndarray  # (parts, n): the rows of each part position in tree order


def grow(points: np.ndarray, leaf: int) -> Tree:
    """A k-d tree over every part position of (n, parts, length) integer points: a node
    of more than ``leaf`` rows is halved along its widest component."""
    n, parts, length = points.shape
    rows = np.tile(np.arange(n), (parts, 1))
    part, start, stop, left, low, high, sums = [], [], [], [], [], [], []

    def add(p: int, a: int, b: int) -> int:
        mine = points[rows[p, a:b], p]
        part.append(p)
        start.append(a)
        stop.append(b)
        left.append(-1)
        low.append(mine.min(axis=0))
        high.append(mine.max(axis=0))
        sums.append(mine.sum(axis=0, dtype=np.int64))
        return len(part) - 1

    todo = [add(p, 0, n) for p in range(parts)] if n else []
    for node in todo:  # grows while it is walked
        a, b, p = start[node], stop[node], part[node]
        wide = high[node] - low[node]
        if b - a <= leaf or not wide.any():
            continue
        axis, half = int(np.argmax(wide)), (a + b) // 2
        rows[p, a:b] = rows[p, a:b][np.argpartition(points[rows[p, a:b], p, axis], half - a)]
        left[node] = add(p, a, half)
        add(p, half, b)
        todo += [left[node], left[node] + 1]
    box = (len(part), length)
    return Tree(*[np.array(x, np.int64) for x in (part, start, stop, left)],
                *[np.array(x, np.int64).reshape(box) for x in (low, high, sums)], rows)


def _split(pairs: np.ndarray, left: np.ndarray, which: int) -> np.ndarray:
    """Every pair twice, once with each child of its node in column ``which``."""
    out = np.repeat(pairs, 2, axis=0)
    out[:, which] = left[out[:, which]]
    out[1::2, which] += 1
    return out


def assign(points: np.ndarray, tree: Tree, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, counts, sums): the nearest entry of every part, and the number and sum of
    the parts that each entry got. ``books`` is (parts, entries, length)."""
    n, parts, length = points.shape
    entries = books.shape[1]
    codes = np.zeros((n, parts), np.int64)
    counts = np.zeros((parts, entries), np.int64)
    sums = np.zeros((parts, entries, length), np.int64)
    if not n:
        return codes, counts, sums
    of = grow(np.ascontiguousarray(books.transpose(1, 0, 2)), 1)
    # equal entries share a leaf, and the first of them wins every tie
    entry = np.array([of.rows[p, a:b].min() for p, a, b in zip(of.part, of.start, of.stop, strict=True)])
    size_p, size_e = (tree.high - tree.low).max(axis=1), (of.high - of.low).max(axis=1)
    roots = np.arange(parts)  # the first nodes of both trees are the roots, by part position
    pairs = np.stack([roots, roots], axis=1)
    while len(pairs):
        p, e = pairs[:, 0], pairs[:, 1]
        gap = np.maximum(np.maximum(tree.low[p] - of.high[e], of.low[e] - tree.high[p]), 0)
        reach = np.maximum(tree.high[p] - of.low[e], of.high[e] - tree.low[p])
        near, far = (gap * gap).sum(axis=1), (reach * reach).sum(axis=1)
        best = np.full(len(tree.part), MAX_LONG)
        np.minimum.at(best, p, far)
        pairs = pairs[near <= best[p]]
        p, e = pairs[:, 0], pairs[:, 1]
        left_over = np.bincount(p, minlength=len(tree.part))
        open_entry = of.left[e] >= 0
        widest = np.full(len(tree.part), -1)
        np.maximum.at(widest, p[open_entry], size_e[e[open_entry]])
        # one entry left: the whole node is assigned by its cached sums
        sure = (left_over[p] == 1) & ~open_entry
        for node, k in zip(p[sure], entry[e[sure]], strict=True):
            at = tree.part[node]
            codes[tree.rows[at, tree.start[node]:tree.stop[node]], at] = k
            counts[at, k] += tree.stop[node] - tree.start[node]
            sums[at, k] += tree.sums[node]
        # a leaf with several single entries left compares integers
        leaf = tree.left[p] < 0
        unsure = ~sure & leaf & (widest[p] < 0)
        if unsure.any():
            by = np.argsort(p[unsure], kind="stable")
            nodes, first = np.unique(p[unsure][by], return_index=True)
            for node, ks in zip(nodes, np.split(entry[e[unsure][by]], first[1:]), strict=True):
                at, ks = tree.part[node], np.sort(ks)
                rows = tree.rows[at, tree.start[node]:tree.stop[node]]
                mine = points[rows, at]
                away = mine[:, None, :] - books[at, ks][None]
                got = ks[np.argmin((away * away).sum(axis=2), axis=1)]
                codes[rows, at] = got
                np.add.at(counts[at], got, 1)
                np.add.at(sums[at], got, mine)
        rest = ~sure & ~unsure
        entries_first = rest & (widest[p] >= 0) & (leaf | (widest[p] >= size_p[p]))
        rows_first = rest & ~entries_first
        pairs = np.concatenate([pairs[entries_first & ~open_entry], _split(pairs[entries_first & open_entry], of.left, 1),
                                _split(pairs[rows_first], tree.left, 0)])
    return codes, counts, sums


def _limit(length: int) -> int:
    """Largest size of a component for which squared distances of a part fit 64 bits."""
    return 1 << ((62 - max(0, math.ceil(math.log2(length)))) // 2 - 1)


def _integers(batch_values: pa.Array, dim: int) -> np.ndarray:
    """(n, PARTS, dim / PARTS) integers of a list column, filled up with zeros."""
    sizes = np.diff(batch_values.offsets.to_numpy())
    flat = batch_values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    limit = _limit(dim // PARTS)
    out = np.zeros((len(sizes), dim), np.int64)
    at = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.cumsum(sizes)
    with np.errstate(over="ignore"):
        out[at, np.arange(len(flat)) - np.repeat(ends - sizes, sizes)] = np.clip(np.floor(flat * SCALE), -limit, limit).astype(np.int64)
    return out.reshape(len(sizes), PARTS, dim // PARTS)


def _packed(x: np.ndarray) -> bytes:
    """Integers in as few bytes each as they need, after a byte that tells their width."""
    for kind in (np.int8, np.int16, np.int32):
        if not len(x.ravel()) or (x.min() >= np.iinfo(kind).min and x.max() <= np.iinfo(kind).max):
            return bytes([np.dtype(kind).itemsize]) + x.astype(kind).tobytes()
    return bytes([8]) + x.tobytes()


def _unpacked(data: bytes, *shape: int) -> np.ndarray:
    return np.frombuffer(data, f"i{data[0]}", offset=1).astype(np.int64).reshape(shape)


TREE_FIELDS = ("part", "start", "stop", "left", "low", "high", "sums", "rows")


def _block_rows(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, BLOCK):
            part = b.slice(at, BLOCK)
            points = _integers(part.column(2), dim)
            tree = grow(points, LEAF)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.column(0).to_pylist()], pa.list_(b.schema.field(0).type)),
                 pa.array([part.column(1).to_pylist()], pa.list_(b.schema.field(1).type)),
                 pa.array([_packed(points)], pa.binary()),
                 *[pa.array([_packed(getattr(tree, f))], pa.binary()) for f in TREE_FIELDS]],
                names=["ids", "labels", "points", *TREE_FIELDS])


def _blocks(batches: Iterator[pa.RecordBatch], dim: int):
    """(ids, labels, points, tree) of stored blocks."""
    length = dim // PARTS
    for b in batches:
        for row in b.to_pylist():
            points = _unpacked(row["points"], -1, PARTS, length)
            flat = [_unpacked(row[f], -1) for f in ("part", "start", "stop", "left")]
            boxes = [_unpacked(row[f], -1, length) for f in ("low", "high", "sums")]
            yield row["ids"], row["labels"], points, Tree(*flat, *boxes, _unpacked(row["rows"], PARTS, -1))


def _pass(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One line a slot that is not zero: the counts first, then the sums, flattened."""
    parts, entries, length = books.shape
    total = np.zeros(parts * entries * (1 + length), np.int64)
    for _, _, points, tree in _blocks(batches, parts * length):
        _, counts, sums = assign(points, tree, books)
        total += np.concatenate([counts.ravel(), sums.ravel()])
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["slot", "value"])


def _coded(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    parts, _, length = books.shape
    for b in batches:
        kinds = [b.schema.field(i).type.value_type for i in (0, 1)]
        for ids, labels, points, tree in _blocks(iter([b]), parts * length):
            codes, _, _ = assign(points, tree, books)
            away = points - books[np.arange(parts), codes]
            each = (away * away).sum(axis=2)
            error = [min(sum(row), MAX_LONG) for row in each.tolist()]
            code = ["".join(f"{k:02x}" for k in row) for row in codes.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, kinds[0]), pa.array(labels, kinds[1]), pa.array(code, pa.string()),
                                              pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, v) of the rows whose vector has only finite components."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("v").isNotNull() & ~bad)


def first_entries(rows: DataFrame, dim: int, entries: int = ENTRIES) -> np.ndarray:
    """The integer parts of the rows with the smallest ids: (parts, entries, length)."""
    got = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    values = pa.array([r.v for r in got], pa.list_(pa.float64()))
    return np.ascontiguousarray(_integers(values, dim).transpose(1, 0, 2))


def refined(sums: dict[int, int], books: np.ndarray) -> np.ndarray:
    """Entries replaced by the rounded-down means of their parts."""
    parts, entries, length = books.shape
    total = np.zeros(parts * entries * (1 + length), np.int64)
    for slot, value in sums.items():
        total[slot] = value
    counts = total[:parts * entries].reshape(parts, entries, 1)
    means = total[parts * entries:].reshape(books.shape) // np.maximum(counts, 1)
    return np.where(counts > 0, means, books)


@dataclass
class Codes:
    rows: DataFrame      # vec_id, label, code, error
    books: np.ndarray    # parts, entries, length


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             rounds: int = ROUNDS, entries: int = ENTRIES) -> Codes:
    """Codes and errors of all usable rows, and the codebooks they refer to."""
    rows = usable(vectors, id_col, vector_col, label_col)
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    dim = max(1, -(-longest // PARTS)) * PARTS
    label = rows.schema["label"].dataType
    books = first_entries(rows, dim, entries)
    kind = T.StructType([T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("labels", T.ArrayType(label)),
                         *[T.StructField(f, T.BinaryType()) for f in ("points", *TREE_FIELDS)]])
    blocks = stored(rows.mapInArrow(partial(_block_rows, dim=dim), kind), "vector-blocks")
    for _ in range(rounds):
        sums = (blocks.drop("ids", "labels").selectExpr("null AS ids", "null AS labels", "*")
                .mapInArrow(partial(_pass, books=books), "slot long, value long")
                .groupBy("slot").agg(F.sum("value").alias("value")))
        books = refined({r.slot: r.value for r in sums.collect()}, books)
    out = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", label),
                        T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return Codes(stored(blocks.mapInArrow(partial(_coded, books=books), out), "vector-codes"), books)


def report(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of all usable rows."""
    codes = compress(vectors)
    digest = hashlib.sha256(",".join(map(str, codes.books.ravel().tolist())).encode()).hexdigest()
    key = F.when(F.col("label").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("label").cast("string")))
    rows = codes.rows.select("vec_id", "code", "error", key.alias("_key"))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MAX_LONG).cast("decimal(38,0)")).cast("long")
    stats = rows.groupBy("_key").agg(total.alias("label_error"), F.count("*").alias("_rows"))
    stats = stored(stats, "label-errors")
    n = stats.agg(F.sum("_rows")).first()[0] or 0
    joined = salted_lookup(rows, stats, "_key", "_rows", n, F.xxhash64("vec_id", "code", "error"))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


ship(__name__)
