"""Gradient boosting with leaf-wise trees, L1 and L2 penalties, and stopping during the fit.

Squared loss. Features are cut into at most ``max_bins`` bins once; rows are kept as blocks
of bin codes, target and margin (the score so far). All models of a run (folds, seeds, a
full train beside its hold-out) advance together: a job takes the rows' gradients and sums
them with the row counts by (model, leaf, feature, bin), summed map-side in each task and
then by one aggregate. Only these sums reach the driver: at most models * leaves *
features * bins lines, whatever the rows. The driver chooses the splits.

* Tasks move rows down a tree by operations on whole arrays and count the combinations of
  features of few bins together; the sums by feature are taken once a task.
* A tree grows best first: the open leaf of greatest gain is split next, up to
  ``max_leaves``. Which leaves that takes is settled in a few rounds of jobs, not one a
  split: leaves are played through with the gains known so far, and the children of those
  that would be split are measured together, until none is missing.
* Of two children only the one with fewer rows is measured; the other is the parent less it.
* A leaf's value is -rate * T(G) / (H + lambda), where T shrinks the gradient sum towards 0
  by alpha; gains are T(G)^2 / (H + lambda) of the children less the parent's.
* The job that opens a round also sums the squared errors on each model's validation rows,
  of the trees so far. A model stops once ``patience`` rounds pass without a new least
  error, so at most best + patience rounds are fitted, and its first trees up to the best
  are the model: there is no second fit.

Gradients are rounded to a power of two (chosen from the number of rows and the range of
the target so that sums stay exact in doubles and longs). Sums therefore do not depend on
partitions or task order, and a fit repeats exactly. Rows are drawn by a hash of their
key, seed and round, columns by a hash of seed and round.

The new margins are written every ``STORE_EVERY`` rounds; in between, tasks add the trees
since then, so a lost executor costs at most that work again.
"""

from __future__ import annotations

import heapq
import math
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickroll.session import scratch_path

STORE_EVERY = 8
#: rows of a block
BLOCK = 1 << 16
#: rows that are counted together: calls on arrays cost less a row, and still stay in the processor's cache
AT_ONCE = 1 << 15
#: bin counts (rows * features * models) that one task makes in a job; below that, starting tasks costs more
TASK_WORK = 1 << 22


@dataclass(frozen=True)
class GBTParams:
    """The reference's settings: rounds, rate, size, samples, least leaf weight, penalties."""

    max_iter: int = 50
    step_size: float = 0.05
    max_depth: int = 6               # 0: no limit
    max_leaves: int = 31
    subsampling_rate: float = 0.8    # rows a tree
    column_sample: float = 0.7       # features a tree
    min_instances_per_node: int = 6
    min_info_gain: float = 0.0
    reg_lambda: float = 0.0
    reg_alpha: float = 0.0
    max_bins: int = 64               # at most 256
    seed: int = 2025
    patience: int | None = None      # early stopping: rounds without improvement


@dataclass
class Tree:
    """Nodes in arrays; node 0 is the root. Rows with bin <= ``bin`` go left. A leaf has
    feature -1 and a value."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])

    def arrays(self) -> tuple[np.ndarray, ...]:
        return (np.array(self.feature, np.int32), np.array(self.bin, np.int32), np.array(self.left, np.int32), np.array(self.value))


def _leaves(tree: tuple[np.ndarray, ...], codes: np.ndarray) -> np.ndarray:
    """The node each row ends in; ``codes`` is (features, rows). Children have greater numbers than
    their parent, so one pass over the nodes moves all rows: a few operations on whole arrays of
    small integers a node, no indexing by row."""
    feature, cut, left, _ = tree
    kind = np.min_scalar_type(len(feature))
    node = np.zeros(codes.shape[1], kind)
    for i in np.flatnonzero(feature >= 0).tolist():
        here = np.negative((node == i).view(np.uint8).astype(kind, copy=False))     # all bits or none
        step = (codes[feature[i]] > int(cut[i])).view(np.uint8).astype(kind, copy=False) + kind.type(left[i] - i)
        step &= here
        node += step
    return node


def patience_best(curve: Sequence[float], patience: int | None) -> int:
    """0-based best round under early stopping: training stops once ``patience`` rounds
    pass without a new minimum of the validation error; None -> plain argmin."""
    best = 0
    for i, v in enumerate(curve):
        if v < curve[best]:
            best = i
        elif patience is not None and i - best >= patience:
            break
    return best


# ---------------------------------------------------------------- bins

#: bits of a value's key that tell its first cell, how many more cut a heavy cell again, and up to which
#: (values that agree in sign, exponent and 28 bits are not told apart)
FIRST_BITS, MORE_BITS, LAST_BITS = 16, 4, 40
#: a cell is heavy if it holds more rows than 1 / (FINE * bins) of all
FINE = 8


def _keys(x: np.ndarray) -> np.ndarray:
    """64-bit integers in the order of the doubles."""
    x = np.ascontiguousarray(x) + 0.0      # one zero
    bits = x.view(np.int64)
    return np.where(bits < 0, np.int64(-2**63) - bits, bits)


def _together(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """(cell, rows, least, greatest) of parts that may have the same cells."""
    cell, n, low, high = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(cell, kind="stable")
    cells, first = np.unique(cell[order], return_index=True)
    return cells, np.add.reduceat(n[order], first), np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first)


def _cells(batches: Iterator[pa.RecordBatch], heavy: dict[int, np.ndarray] | None, bits: int, more: int, width: int) -> Iterator[pa.RecordBatch]:
    """(feature, cell, rows, least, greatest) of the cells by the first ``bits`` bits of the keys, of
    those heavy ``more`` bits before (None: of all). Missing values do not count."""
    found: dict[int, list[tuple[np.ndarray, ...]]] = {}
    for b in batches:
        values = _matrix(b.column(0), width)
        for f in range(width) if heavy is None else heavy:
            x = np.sort(values[:, f] + 0.0)      # keys are in the order of the values; one zero
            x = x[:np.searchsorted(x, np.nan)]
            if not len(x):
                continue
            first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
            x, n = x[first], np.diff(first, append=len(x))      # each value once
            k = _keys(x)
            if heavy is not None:
                use = np.isin(k >> (64 - bits + more), heavy[f])
                x, n, k = x[use], n[use], k[use]
            if len(k):
                parts = found.setdefault(f, [])
                parts.append(_together([(k >> (64 - bits), n, x, x)]))
                if len(parts) >= 64:
                    parts[:] = [_together(parts)]
    for f, parts in found.items():
        cells = _together(parts)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cells[0]), f, np.int32)), *map(pa.array, cells)], names=["f", "cell", "n", "low", "high"])


def _counted(values: DataFrame, heavy: dict[int, np.ndarray] | None, bits: int, more: int, width: int) -> list[dict]:
    return (values.mapInArrow(partial(_cells, heavy=heavy, bits=bits, more=more, width=width), "f int, cell long, n long, low double, high double")
            .groupBy("f", "cell").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).toArrow().to_pylist())


#: how many more bits tell the cells of a wanted rank apart in each pass
RANK_BITS = 8


def exact_edges(rows: DataFrame, features: Column, n_features: int, bins: int) -> list[np.ndarray]:
    """Upper bounds of the bins of every feature: the values at ranks floor((n - 1) * i / (bins - 1)),
    each once, without the greatest value. ``features`` is an array column.

    Radix selection as in ``quantiles``, of all features at once and without a row a value: tasks count
    cells of whole columns. Only cells that hold a wanted rank and more than one value are cut again,
    so a pass has at most ``bins`` * 2**RANK_BITS lines a feature after the first."""
    values = rows.select(features.alias("x"))
    found: list[set[float]] = [set() for _ in range(n_features)]
    heavy: dict[int, np.ndarray] | None = None
    wanted: dict[tuple[int, int], list[int]] = {}      # (feature, cell) -> ranks in it, from 0
    bits, more = FIRST_BITS, RANK_BITS
    while True:
        lines: dict[tuple[int, int], list[tuple]] = {}
        for r in _counted(values, heavy, bits, more, n_features):
            up = 0 if heavy is None else r["cell"] >> more
            lines.setdefault((r["f"], up), []).append((r["cell"], r["n"], r["low"], r["high"]))
        if heavy is None:
            total = {f: sum(c[1] for c in cells) for (f, _), cells in lines.items()}
            wanted = {(f, 0): sorted({math.floor((n - 1) * (i / (bins - 1))) for i in range(bins)}) for f, n in total.items()}
        cut: dict[tuple[int, int], list[int]] = {}
        for (f, up), cells in lines.items():
            ranks, done = iter(wanted[f, up]), 0
            rank = next(ranks, None)
            for cell, n, low, high in sorted(cells):
                while rank is not None and rank < done + n:
                    if low < high:
                        cut.setdefault((f, cell), []).append(rank - done)
                    else:
                        found[f].add(low)
                    rank = next(ranks, None)
                done += n
        if not cut:
            break
        wanted, heavy = cut, {}
        for f, cell in sorted(cut):
            heavy.setdefault(f, []).append(cell)
        heavy = {f: np.array(c, np.int64) for f, c in heavy.items()}
        bits += more
    return [np.array(sorted(v)[:-1], float) for v in found]


def bin_edges(rows: DataFrame, features: Column, n_features: int, bins: int) -> list[np.ndarray]:
    """Upper bounds of the bins of every feature, at values near the ranks that part the rows
    into ``bins`` equal shares. ``features`` is an array column.

    Mergeable histograms: rows are counted by the first bits of the value's key; cells that
    hold more than 1 / (FINE * bins) of the rows, and more than one value, are cut again
    until none is left. Counts are exact sums, so the edges do not depend on partitions.
    A bin ends at the greatest value of the cell in which its share is reached; a value
    with more rows than that has an edge of its own. The least value always has one.
    """
    values = rows.select(features.alias("x"))
    cells: list[dict[tuple[int, int], tuple]] = [{} for _ in range(n_features)]     # (bits, cell) -> n, low, high
    heavy: dict[int, np.ndarray] | None = None
    for bits in range(FIRST_BITS, LAST_BITS + 1, MORE_BITS):
        for r in _counted(values, heavy, bits, MORE_BITS, n_features):
            cells[r["f"]][bits, r["cell"]] = (r["n"], r["low"], r["high"])
        if heavy is None:
            total = [sum(c[0] for c in cs.values()) for cs in cells]
        heavy = {}
        for f, cs in enumerate(cells):
            big = [c for (at, c), (n, low, high) in cs.items() if at == bits and low < high and n * FINE * bins > total[f]]
            if big and bits < LAST_BITS:
                heavy[f] = np.array(sorted(big), np.int64)
                for c in big:
                    del cs[bits, c]
        if not heavy:
            break
    edges = []
    for f, cs in enumerate(cells):
        done, share, mine = 0, 1, []
        for n, low, high in sorted(cs.values(), key=lambda c: c[1]):
            if not mine and low < high:
                mine.append(low)
            done += n
            if not mine or done * (bins - 1) >= share * total[f]:
                mine.append(high)
                share = done * (bins - 1) // total[f] + 1
        edges.append(np.array(sorted(set(mine))[:-1][:bins - 1], float) if cs else np.zeros(0))
    return edges


def _coded(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """(features, rows) bin codes of (rows, features) values: the number of edges below."""
    out = np.empty(values.shape[::-1], np.uint8)
    for f, e in enumerate(edges):
        out[f] = np.searchsorted(e, values[:, f], "left")
    return out


def _matrix(col: pa.Array, width: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


# ---------------------------------------------------------------- blocks

BLOCKS = "n int, codes binary, views binary, fold binary, y binary, key binary, margins binary"


def _made(batches: Iterator[pa.RecordBatch], held, models: int) -> Iterator[pa.RecordBatch]:
    """Blocks of bin codes; ``held`` has the edges of the common features and of each view's."""
    edges, views = held.value
    for b in batches:
        for at in range(0, b.num_rows, BLOCK):
            part = b.slice(at, BLOCK)
            n = part.num_rows
            codes = _coded(_matrix(part.column(3), len(edges)), edges) if edges else np.empty((0, n), np.uint8)
            wide = len(views[0]) if views else 0
            seen = _matrix(part.column(4), len(views) * wide).reshape(n, len(views), wide) if wide else None
            own = b"".join(_coded(seen[:, v], e).tobytes() for v, e in enumerate(views)) if wide else b""
            flat = [part.column(i).to_numpy(zero_copy_only=False).astype(t) for i, t in ((0, np.int64), (1, np.int32), (2, np.float64))]
            yield _block_row(n, codes.tobytes(), own, flat[1].tobytes(), flat[2].tobytes(), flat[0].tobytes(), np.zeros((models, n)).tobytes())


def _block_row(n: int, *parts: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), *[pa.array([p], pa.binary()) for p in parts]],
                                      names=["n", "codes", "views", "fold", "y", "key", "margins"])


@dataclass
class _Job:
    """What the tasks of a job need of one model."""

    slot: int                         # its line in the margins
    view: int
    base: float
    rate: float
    fit: tuple[str, int]              # which rows it learns from: ("all", 0), ("not", fold)
    val: int | None                   # fold of its validation rows
    trees: list                       # those that the stored margins lack
    draw: tuple[int, int]             # (salt, threshold): rows whose mixed key is below it
    tree: tuple | None                # the tree so far
    wanted: dict[int, int]            # node -> place in the answer
    features: np.ndarray              # the columns drawn
    sizes: list[int]                  # bins of every column
    scale: float
    first: int                        # first slot of the answer
    errors: bool


def _mixed(key: np.ndarray, salt: int) -> np.ndarray:
    x = key.view(np.uint64) ^ np.uint64(salt)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Rows:
    """The rows of some blocks."""

    def __init__(self, blocks: Sequence[dict], common: int, own: int, models: int):
        def joined(name: str, kind, *lead: int) -> np.ndarray:
            parts = [np.frombuffer(b[name], kind).reshape(*lead, b["n"]) for b in blocks]
            return parts[0] if len(parts) == 1 else np.concatenate(parts, axis=-1)
        self._seen: dict[int, np.ndarray] = {}
        self._drawn: dict[tuple[int, int], np.ndarray] = {}
        self._joint: dict[tuple, list[np.ndarray]] = {}
        self.codes = joined("codes", np.uint8, common)
        self.views = joined("views", np.uint8, -1, own) if own else None
        self.fold, self.y, self.key = joined("fold", np.int32), joined("y", np.float64), joined("key", np.int64)
        self.margins = joined("margins", np.float64, models)

    def seen(self, view: int) -> np.ndarray:
        """(features, rows): the common features, then the view's."""
        if self.views is None:
            return self.codes
        if view not in self._seen:
            self._seen[view] = np.concatenate([self.codes, self.views[view]])
        return self._seen[view]

    def drawn(self, draw: tuple[int, int]) -> np.ndarray:
        """The rows of a sample; models of one seed share it."""
        if draw not in self._drawn:
            self._drawn[draw] = (_mixed(self.key, draw[0]) >> np.uint64(32)) < draw[1]
        return self._drawn[draw]

    def joint(self, view: int, groups: Sequence[Sequence[int]], sizes: Sequence[int]) -> list[np.ndarray]:
        """One code a row for each group of features: their bin codes as digits of a number."""
        key = (view, tuple(map(tuple, groups)))
        if key not in self._joint:
            codes = self.seen(view)
            out = []
            for group in groups:
                code = codes[group[0]].astype(np.int64)
                for f in group[1:]:
                    code *= sizes[f]
                    code += codes[f]
                out.append(code)
            self._joint[key] = out
        return self._joint[key]

    def margin(self, job: _Job, codes: np.ndarray) -> np.ndarray:
        m = self.margins[job.slot]
        for t in job.trees:
            m = m + t[3][_leaves(t, codes).astype(np.intp)]
        return m


#: cells that the joint counts of a group of features have at most, all leaves together (a single feature may have more)
JOINT_CELLS = 1 << 13


def _grouped(features: Sequence[int], sizes: Sequence[int], leaves: int) -> list[list[int]]:
    """Features whose bins are counted together, as long as their combinations stay few. Sorted by size,
    so that features of few bins share a group."""
    groups: list[list[int]] = []
    cells = 0
    for f in sorted(features, key=lambda f: (sizes[f], f)):
        if groups and cells * sizes[f] * leaves <= JOINT_CELLS:
            groups[-1].append(f)
            cells *= sizes[f]
        else:
            groups.append([f])
            cells = sizes[f]
    return groups


def _some(batch: pa.RecordBatch) -> Iterator[list[dict]]:
    """The blocks of a batch, some at a time: about AT_ONCE rows together."""
    some, rows = [], 0
    for i in range(batch.num_rows):
        some += batch.slice(i, 1).to_pylist()
        rows += some[-1]["n"]
        if rows >= AT_ONCE or i + 1 == batch.num_rows:
            yield some
            some, rows = [], 0


def _sums(batches: Iterator[pa.RecordBatch], jobs, shape: tuple[int, int, int], bins: int) -> Iterator[pa.RecordBatch]:
    """Gradient sums and row counts by slot: (place of the leaf * features + feature) * bins + bin,
    and before a model's own slots its squared error and number of validation rows."""
    common, own, models = shape
    width = common + own
    errors = {j.slot: [0.0, 0] for j in jobs}
    groups = {j.slot: _grouped(j.features.tolist(), j.sizes, len(j.wanted)) for j in jobs if j.wanted}
    # sums and counts of the combinations of a group's bins, by leaf
    joint = {j.slot: [np.zeros((2, len(j.wanted) * math.prod(j.sizes[f] for f in group))) for group in groups[j.slot]] for j in jobs if j.wanted}
    for b in batches:
        for blocks in _some(b):
            rows = _Rows(blocks, common, own, models)
            for j in jobs:
                codes = rows.seen(j.view)
                g = rows.margin(j, codes) + j.base - rows.y
                if j.errors and j.val is not None:
                    mine = g[rows.fold == j.val]
                    errors[j.slot][0] += np.rint(mine * mine * j.scale).sum()
                    errors[j.slot][1] += len(mine)
                if not j.wanted:
                    continue
                use = np.ones(len(g), bool) if j.fit[0] == "all" else rows.fold != j.fit[1]
                if j.draw[1] < 1 << 32:
                    use &= rows.drawn(j.draw)
                place = np.full(len(j.tree[0]), -1, np.int64)
                for node, at in j.wanted.items():
                    place[node] = at
                place = place[_leaves(j.tree, codes).astype(np.intp)]
                at = np.flatnonzero(use & (place >= 0))
                place, weights = place[at], np.rint(g[at] * j.scale)
                for acc, code in zip(joint[j.slot], rows.joint(j.view, groups[j.slot], j.sizes), strict=True):
                    size = acc.shape[1]
                    cell = code[at] if len(j.wanted) == 1 else place * (size // len(j.wanted)) + code[at]
                    acc[0] += np.bincount(cell, weights, minlength=size)
                    acc[1] += np.bincount(cell, minlength=size)
    for j in jobs:
        leaves = len(j.wanted)
        acc = np.zeros((2, 1 + leaves * width * bins))
        acc[:, 0] = errors[j.slot]
        sums = acc[:, 1:].reshape(2, leaves, width, bins)      # a view of the slots
        for group, cells in zip(groups.get(j.slot, ()), joint.get(j.slot, ()), strict=True):
            cells = cells.reshape(2, leaves, *[j.sizes[f] for f in group])
            for i, f in enumerate(group):
                sums[:, :, f, :j.sizes[f]] = cells.sum(axis=tuple(2 + k for k in range(len(group)) if k != i))
        at = np.flatnonzero(acc[1])
        yield pa.RecordBatch.from_arrays([pa.array(at + j.first), pa.array(acc[0, at].astype(np.int64)), pa.array(acc[1, at].astype(np.int64))],
                                         names=["slot", "g", "n"])


def _advanced(batches: Iterator[pa.RecordBatch], jobs, shape: tuple[int, int, int]) -> Iterator[pa.RecordBatch]:
    """The blocks with the margins brought up to date."""
    for b in batches:
        for row in b.to_pylist():
            rows = _Rows([row], *shape)
            margins = rows.margins.copy()
            for j in jobs:
                margins[j.slot] = rows.margin(j, rows.seen(j.view))
            yield _block_row(row["n"], *[row[c] for c in ("codes", "views", "fold", "y", "key")], margins.tobytes())


# ---------------------------------------------------------------- growing a tree

def shrunk(g: np.ndarray | float, alpha: float):
    """The gradient sum drawn towards 0 by alpha."""
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


@dataclass
class _Leaf:
    g: np.ndarray            # (features, bins) gradient sums
    n: np.ndarray            # row counts
    depth: int
    gain: float = -1.0
    feature: int = -1
    bin: int = -1
    left: int = -1           # node numbers of measured children: left, left + 1

    def totals(self, f: int = 0) -> tuple[float, float]:
        return float(self.g[f].sum()), float(self.n[f].sum())


def _split(leaf: _Leaf, p: GBTParams, drawn: np.ndarray, cuts: np.ndarray) -> None:
    """The best cut of a leaf: greatest gain, then least feature, then least bin. ``cuts`` is the
    number of edges of every feature."""
    if p.max_depth and leaf.depth >= p.max_depth:
        return
    g, n = np.cumsum(leaf.g[drawn], axis=1), np.cumsum(leaf.n[drawn], axis=1)
    gl, nl, gr, nr = g[:, :-1], n[:, :-1], g[:, -1:] - g[:, :-1], n[:, -1:] - n[:, :-1]

    def worth(a, b):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(b > 0, shrunk(a, p.reg_alpha) ** 2 / (b + p.reg_lambda), 0.0)
    gain = worth(gl, nl) + worth(gr, nr) - worth(g[:, -1:], n[:, -1:])
    least = max(1, p.min_instances_per_node)
    ok = (nl >= least) & (nr >= least) & (np.arange(gain.shape[1])[None] < cuts[drawn][:, None])
    gain = np.where(ok, gain, -1.0)
    at = int(np.argmax(gain))
    f, b = divmod(at, gain.shape[1])
    if gain[f, b] > max(p.min_info_gain, 0.0):
        leaf.gain, leaf.feature, leaf.bin = float(gain[f, b]), int(drawn[f]), b


class _Grower:
    """One tree of one model on the driver."""

    def __init__(self, p: GBTParams, drawn: np.ndarray, cuts: np.ndarray, unit: float):
        self.p, self.drawn, self.cuts, self.unit = p, drawn, cuts, unit
        self.leaves: dict[int, _Leaf] = {}
        self.tree = Tree()

    def chosen(self) -> list[int]:
        """Nodes that best-first growth splits, as far as gains are known, in order."""
        out: list[int] = []
        heap = [(-self.leaves[0].gain, 0)] if 0 in self.leaves and self.leaves[0].feature >= 0 else []
        while heap and len(out) < self.p.max_leaves - 1:
            _, node = heapq.heappop(heap)
            out.append(node)
            for child in (self.leaves[node].left, self.leaves[node].left + 1):
                if self.leaves[node].left >= 0 and child in self.leaves and self.leaves[child].feature >= 0:
                    heapq.heappush(heap, (-self.leaves[child].gain, child))
        return out

    def opened(self) -> dict[int, int]:
        """Makes children of the chosen nodes that lack them; child to measure -> its parent.
        Children at the depth limit are known from the parent's sums and need no job."""
        out = {}
        for node in self.chosen():
            leaf = self.leaves[node]
            if leaf.left >= 0:
                continue
            t = self.tree
            leaf.left = len(t.feature)
            for x in (t.feature, t.left):
                x += [-1, -1]
            t.bin += [0, 0]
            t.value += [0.0, 0.0]
            t.feature[node], t.bin[node], t.left[node] = leaf.feature, leaf.bin, leaf.left
            if self.p.max_depth and leaf.depth + 1 >= self.p.max_depth:
                continue
            few = leaf.n[leaf.feature, :leaf.bin + 1].sum() * 2 <= leaf.n[leaf.feature].sum()
            out[leaf.left + (0 if few else 1)] = node
        return out

    def measured(self, child: int, parent: int, g: np.ndarray, n: np.ndarray) -> None:
        """Sums of one child arrive; the other's are the parent's less these."""
        up = self.leaves[parent]
        other = up.left + (child == up.left)
        for node, a, b in ((child, g, n), (other, up.g - g, up.n - n)):
            self.leaves[node] = _Leaf(a, b, up.depth + 1)
            _split(self.leaves[node], self.p, self.drawn, self.cuts)

    def root(self, g: np.ndarray, n: np.ndarray) -> None:
        self.leaves[0] = _Leaf(g, n, 0)
        _split(self.leaves[0], self.p, self.drawn, self.cuts)

    def finished(self) -> Tree:
        """The tree of the chosen splits alone, with leaf values."""
        t = Tree()
        chosen = set(self.chosen())
        first = int(self.drawn[0])

        def value(g: float, n: float) -> float:
            return float(-self.p.step_size * shrunk(g, self.p.reg_alpha) / (n + self.p.reg_lambda)) if n else 0.0
        todo = [(0, 0, *(self.leaves[0].totals(first) if 0 in self.leaves else (0.0, 0.0)))]
        for node, at, g, n in todo:      # grows while it is walked
            if node not in chosen:
                t.value[at] = value(g, n)
                continue
            leaf = self.leaves[node]
            gl, nl = leaf.g[leaf.feature, :leaf.bin + 1].sum(), leaf.n[leaf.feature, :leaf.bin + 1].sum()
            t.feature[at], t.bin[at], t.left[at] = leaf.feature, leaf.bin, len(t.feature)
            todo += [(leaf.left, t.left[at], float(gl), float(nl)), (leaf.left + 1, t.left[at] + 1, g - float(gl), n - float(nl))]
            for x in (t.feature, t.left):
                x += [-1, -1]
            t.bin += [0, 0]
            t.value += [0.0, 0.0]
        return t


# ---------------------------------------------------------------- fitting

@dataclass(frozen=True)
class Plan:
    """One model of a run: learns from the rows outside ``not_fold`` (None: all), watches
    those of ``val_fold``, sees the common features and view ``view``'s own. It ends when
    model ``stops_with`` does."""

    params: GBTParams
    view: int = 0
    not_fold: int | None = None
    val_fold: int | None = None
    stops_with: int | None = None


@dataclass
class Model:
    base: float
    trees: list[Tree]
    edges: list[np.ndarray]
    curve: list[float]       # validation error after every round fitted
    fitted: int              # rounds fitted, those dropped at the end included

    def truncated(self, n: int) -> Model:
        return replace(self, trees=self.trees[:n])

    def predict(self, values: np.ndarray) -> np.ndarray:
        """Scores of (rows, features) values."""
        codes = _coded(np.nan_to_num(values, nan=0.0), self.edges)
        out = np.full(len(values), self.base)
        for t in self.trees:
            a = t.arrays()
            out += a[3][_leaves(a, codes)]
        return out


class _Fit:
    """A model in the making."""

    def __init__(self, plan: Plan, slot: int, base: float, edges: list[np.ndarray], unit: float):
        self.plan, self.slot, self.base, self.edges, self.unit = plan, slot, base, edges, unit
        self.trees: list[Tree] = []
        self.stored = 0          # trees that are in the stored margins
        self.curve: list[float] = []
        self.open = plan.params.max_iter > 0
        self.grower: _Grower | None = None

    def job(self, wanted: dict[int, int], first: int, errors: bool) -> _Job:
        p, g = self.plan.params, self.grower
        salt = int(_mixed(np.array([p.seed * 1_000_003 + len(self.trees)], np.int64), 0x5EED)[0])
        return _Job(self.slot, self.plan.view, self.base, p.step_size,
                    ("all", 0) if self.plan.not_fold is None else ("not", self.plan.not_fold), self.plan.val_fold,
                    [t.arrays() for t in self.trees[self.stored:]], (salt, int(min(1.0, p.subsampling_rate) * (1 << 32))),
                    g.tree.arrays() if g else None, wanted, g.drawn if g else np.zeros(0, np.int64), [len(e) + 1 for e in self.edges], 1 / self.unit, first, errors)

    def start(self) -> None:
        p, n = self.plan.params, len(self.edges)
        keep = max(1, math.ceil(p.column_sample * n)) if p.column_sample < 1 else n
        order = np.argsort(_mixed(np.arange(n, dtype=np.int64), (p.seed << 20) + 7 * len(self.trees) + 1), kind="stable")
        self.grower = _Grower(p, np.sort(order[:keep]), np.array([len(e) for e in self.edges]), self.unit)

    def stopped(self) -> bool:
        p = self.plan.params
        if self.plan.val_fold is not None and p.patience is not None and self.curve:
            best = int(np.argmin(self.curve))
            if len(self.curve) - 1 - best >= p.patience:
                return True
        return len(self.trees) >= p.max_iter

    def model(self) -> Model:
        trees = self.trees
        if self.curve and self.plan.params.patience is not None:
            trees = trees[:patience_best(self.curve, self.plan.params.patience) + 1]
        return Model(self.base, trees, self.edges, self.curve, len(self.trees))


def fit(rows: DataFrame, plans: Sequence[Plan], common: Sequence[str], views: Sequence[Sequence[str | Column]] = (),
        label: str = "y", fold: str | None = None, key: Sequence[str] = ("user_session",),
        find_edges: Callable[..., list[np.ndarray]] = bin_edges) -> list[Model]:
    """[M2-M6] Fits all ``plans`` together. ``common`` names the features that all models see;
    ``views[v]`` those that only models of view v see (as many in each). Rows without a label are left out;
    missing features count as 0."""
    plans = list(plans)
    bins = max(2, min(256, max(p.params.max_bins for p in plans)))
    own = len(views[0]) if views else 0
    n_common = len(common)
    zero = F.lit(0.0)

    def filled(cols) -> list[Column]:
        return [F.nanvl(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("double"), zero), zero) for c in cols]
    flat = [c for v in views for c in v]
    empty = F.array().cast("array<double>")
    rows = rows.where(F.col(label).isNotNull()).select(
        F.xxhash64(*key).alias("key"), (F.col(fold) if fold else F.lit(0)).cast("int").alias("fold"), F.col(label).cast("double").alias("y"),
        F.array(*filled(common)).alias("common") if common else empty.alias("common"), F.array(*filled(flat)).alias("own") if flat else empty.alias("own"))
    path = scratch_path(rows.sparkSession, "boost-rows")
    rows.write.parquet(path)
    spark = rows.sparkSession
    rows = spark.read.parquet(path)
    # one line a fold; exact sums, so that the base does not depend on the order of rows
    folds = rows.groupBy("fold").agg(F.count("*").alias("n"), F.sum(F.col("y").cast("decimal(38,12)")).alias("s"),
                                     F.min("y").alias("low"), F.max("y").alias("high")).collect()
    if not folds:
        raise ValueError("no rows to learn from")
    n = sum(r.n for r in folds)
    reach = max(max(r.high for r in folds) - min(r.low for r in folds), 1e-9)
    # the squared errors' sum is the largest: it and every gradient sum stay below 2**52 units
    unit = 2.0 ** -min(40, math.floor(52 - math.log2(2 * n * max(reach, reach * reach, 1.0))))
    found = find_edges(rows, F.concat("common", "own"), n_common + len(flat), bins)
    edges = (found[:n_common], [found[n_common + v * own:n_common + (v + 1) * own] for v in range(len(views))])
    shape = (n_common, own, len(plans))
    held = spark.sparkContext.broadcast((edges[0], edges[1]))
    tasks = -(-n * (n_common + own) * len(plans) // TASK_WORK)      # depends on the data alone

    def kept(frame: DataFrame) -> DataFrame:
        path = scratch_path(spark, "boost-blocks")
        frame.write.parquet(path)
        read = spark.read.schema(BLOCKS).parquet(path)
        return read.coalesce(tasks) if tasks < spark.sparkContext.defaultParallelism else read
    blocks = kept(rows.mapInArrow(partial(_made, held=held, models=len(plans)), BLOCKS))

    fits = []
    for i, p in enumerate(plans):
        mine = [r for r in folds if p.not_fold is None or r.fold != p.not_fold]
        seen = sum(r.n for r in mine)
        base = float(sum(r.s for r in mine) / seen) if seen else 0.0
        fits.append(_Fit(p, i, base, [*edges[0], *(edges[1][p.view] if own else [])], unit))
    width = n_common + own

    def run(wanted: list[tuple[_Fit, dict[int, int]]], errors: bool) -> dict[int, tuple[np.ndarray, np.ndarray, float, int]]:
        """slot -> (g, n) of the wanted leaves, squared error, validation rows."""
        jobs, first = [], 0
        for f, w in wanted:
            jobs.append(f.job(w, first, errors))
            first += 1 + len(w) * width * bins
        got = blocks.mapInArrow(partial(_sums, jobs=jobs, shape=shape, bins=bins), "slot long, g long, n long")
        if tasks > 1:      # a single task's lines are the sums
            got = got.groupBy("slot").agg(F.sum("g").alias("g"), F.sum("n").alias("n"))
        got = got.toArrow()
        g, c = np.zeros(first), np.zeros(first)
        at = got.column("slot").to_numpy()
        g[at], c[at] = got.column("g").to_numpy() * unit, got.column("n").to_numpy()
        out = {}
        for j in jobs:
            size = len(j.wanted) * width * bins
            body = slice(j.first + 1, j.first + 1 + size)
            out[j.slot] = (g[body].reshape(-1, width, bins), c[body].reshape(-1, width, bins), g[j.first], int(c[j.first]))
        return out

    while True:
        going = [f for f in fits if f.open]
        if not going:
            break
        for f in going:
            f.start()
        last = [f for f in going if len(f.trees) >= f.plan.params.max_iter]
        got = run([(f, {} if f in last else {0: 0}) for f in going], errors=True)
        for f in going:
            g, c, error, watched = got[f.slot]
            if f.plan.val_fold is not None and f.trees:
                f.curve.append(error / watched if watched else float("inf"))
            f.open = not f.stopped()
        for f in going:
            if f.plan.stops_with is not None:
                f.open &= fits[f.plan.stops_with].open
            if f.open:
                f.grower.root(*(x[0] for x in got[f.slot][:2]))
        going = [f for f in going if f.open]
        while True:
            wanted = [(f, f.grower.opened()) for f in going]
            wanted = [(f, w) for f, w in wanted if w]
            if not wanted:
                break
            got = run([(f, {child: i for i, child in enumerate(w)}) for f, w in wanted], errors=False)
            for f, w in wanted:
                g, c, _, _ = got[f.slot]
                for i, (child, parent) in enumerate(w.items()):
                    f.grower.measured(child, parent, g[i], c[i])
        for f in going:
            f.trees.append(f.grower.finished())
            if f.plan.val_fold is None and len(f.trees) >= f.plan.params.max_iter:
                f.open = False
        if going and max(len(f.trees) - f.stored for f in going) >= STORE_EVERY:
            blocks = kept(blocks.mapInArrow(partial(_advanced, jobs=[f.job({}, 0, False) for f in going], shape=shape), BLOCKS))
            for f in going:
                f.stored = len(f.trees)
    return [f.model() for f in fits]


# ---------------------------------------------------------------- scoring

def scored(features: Column, model: Model) -> Column:
    """Score of an array of features, in Arrow batches."""
    held = model

    @F.pandas_udf("double")
    def score(values: pd.Series) -> pd.Series:
        if not len(values):
            return pd.Series([], dtype=float)
        return pd.Series(held.predict(np.stack(values.to_numpy()).astype(float)))
    return score(features)


def scored_by_all(common: Column, own: Column, wanted: Column, models: Sequence[Model], views: Sequence[int]) -> Column:
    """Array of every model's score of a row; missing where ``wanted`` (an array, one item a
    model) says no. ``own`` has an array of features for each view."""
    models, views = list(models), list(views)

    @F.pandas_udf("array<double>")
    def score(common: pd.Series, own: pd.Series, wanted: pd.Series) -> pd.Series:
        if not len(common):
            return pd.Series([], dtype=object)
        shared = np.stack(common.to_numpy()).astype(float)
        seen = [np.stack([r[v] for r in own]).astype(float) for v in range(len(own.iloc[0]))]
        use = np.stack(wanted.to_numpy()).astype(bool)
        out = np.full(use.shape, np.nan)
        for m, (model, v) in enumerate(zip(models, views, strict=True)):
            at = np.flatnonzero(use[:, m])
            if len(at):
                out[at, m] = model.predict(np.concatenate([shared[at], seen[v][at]], axis=1))
        return pd.Series([[None if x != x else x for x in r] for r in out.tolist()])
    return score(common, own, wanted)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
