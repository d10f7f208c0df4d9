"""Leaf-wise boosting against a plain version: splits, penalties, stopping, repeatability."""

import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickroll.operators import boosting as B


def plain_tree(codes, g, p, edges):
    """Best-first growth over all rows, one split at a time: {node: (feature, bin)} and {leaf: value}."""
    def worth(a, n):
        t = np.sign(a) * max(abs(a) - p.reg_alpha, 0.0)
        return t * t / (n + p.reg_lambda) if n else 0.0

    def best(rows):
        out = (0.0, -1, -1)
        for f in range(codes.shape[0]):
            for b in range(len(edges[f])):
                left = codes[f, rows] <= b
                nl, nr = left.sum(), (~left).sum()
                if min(nl, nr) < max(1, p.min_instances_per_node):
                    continue
                gl, gr = g[rows][left].sum(), g[rows][~left].sum()
                gain = worth(gl, nl) + worth(gr, nr) - worth(gl + gr, nl + nr)
                if gain > out[0] + 1e-9:
                    out = (gain, f, b)
        return out
    leaves = {1: (np.arange(codes.shape[1]), 0)}
    splits = {}
    while len(leaves) < p.max_leaves:
        found = [(best(rows), node) for node, (rows, depth) in leaves.items() if not p.max_depth or depth < p.max_depth]
        found = [x for x in found if x[0][1] >= 0]
        if not found:
            break
        (_, f, b), node = max(found, key=lambda x: (x[0][0], -x[1]))
        rows, depth = leaves.pop(node)
        left = codes[f, rows] <= b
        splits[node] = (f, b)
        leaves[2 * node], leaves[2 * node + 1] = (rows[left], depth + 1), (rows[~left], depth + 1)
    shrink = lambda a: np.sign(a) * max(abs(a) - p.reg_alpha, 0.0)     # noqa: E731
    return splits, {k: -p.step_size * shrink(g[r].sum()) / (len(r) + p.reg_lambda) for k, (r, _) in leaves.items()}


def as_nodes(tree):
    splits, values, todo = {}, {}, [(0, 1)]
    for at, name in todo:
        if tree.feature[at] >= 0:
            splits[name] = (tree.feature[at], tree.bin[at])
            todo += [(tree.left[at], 2 * name), (tree.left[at] + 1, 2 * name + 1)]
        else:
            values[name] = tree.value[at]
    return splits, values


COLS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=700), rng.integers(0, 4, 700), rng.gamma(2, 3, 700), np.zeros(700)])
    y = np.round(3 * (x[:, 0] > 0.3) + x[:, 1] * (x[:, 2] > 5) + rng.normal(0, .5, 700), 2)
    return x, y


@pytest.fixture(scope="module")
def frame(spark, data):
    x, y = data
    rows = [(f"s{i}", i % 5, float(t), *map(float, v)) for i, (v, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "user_session string, fold int, y double, a double, b double, c double, d double").repartition(3).persist()


def codes_of(model, x):
    return B._coded(x, model.edges)


@pytest.mark.parametrize("p", [
    B.GBTParams(max_iter=3, max_depth=0, max_leaves=7, subsampling_rate=1, column_sample=1, step_size=.3, max_bins=16),
    B.GBTParams(max_iter=2, max_depth=3, max_leaves=99, subsampling_rate=1, column_sample=1, reg_lambda=2.5, reg_alpha=6.0, step_size=1, max_bins=16),
    B.GBTParams(max_iter=2, max_depth=2, max_leaves=3, subsampling_rate=1, column_sample=1, min_instances_per_node=60, max_bins=8)])
def test_trees_equal_plain_growth(frame, data, p):
    x, y = data
    (m,) = B.fit(frame, [B.Plan(p)], COLS)
    codes, score = codes_of(m, x), np.full(len(y), m.base)
    assert m.base == pytest.approx(y.mean())
    for t in m.trees:
        splits, values = plain_tree(codes, score - y, p, m.edges)
        got_splits, got_values = as_nodes(t)
        assert got_splits == splits
        assert got_values == pytest.approx(values, abs=1e-6)
        score += t.arrays()[3][B._leaves(t.arrays(), codes)]
    assert m.predict(x) == pytest.approx(score)


def test_edges_part_the_rows(spark, frame, data):
    x, _ = data
    for find in (B.bin_edges, B.exact_edges):
        edges = find(frame, F.array(*COLS), 4, 16)
        assert list(edges[1]) == [0.0, 1.0, 2.0] and len(edges[3]) == 0
        for f in (0, 2):
            share = np.diff(np.concatenate([[0], np.searchsorted(np.sort(x[:, f]), edges[f], "right"), [700]])) / 700
            assert 12 <= len(edges[f]) <= 15 and share.max() < 0.11
            assert set(edges[f]) <= set(x[:, f])


def test_stops_at_patience_and_keeps_the_best_prefix(frame):
    p = B.GBTParams(max_iter=60, step_size=.5, max_depth=4, patience=3, max_bins=16)
    (m,) = B.fit(frame, [B.Plan(p, not_fold=0, val_fold=0)], COLS, fold="fold")
    best = B.patience_best(m.curve, 3)
    assert len(m.trees) == best + 1 and m.fitted <= best + 1 + 3 < 60
    # as many rounds as wanted give the same trees and the same errors
    (full,) = B.fit(frame, [B.Plan(B.GBTParams(**{**p.__dict__, "max_iter": m.fitted, "patience": None}), not_fold=0, val_fold=0)], COLS, fold="fold")
    assert [as_nodes(t) for t in full.trees[:best + 1]] == [as_nodes(t) for t in m.trees]
    assert full.curve[:len(m.curve)] == m.curve


def test_validation_curve_is_the_error_of_the_prefixes(frame, data):
    x, y = data
    p = B.GBTParams(max_iter=11, step_size=.3, max_depth=3, max_bins=16)     # margins are stored on the way
    (m,) = B.fit(frame, [B.Plan(p, not_fold=2, val_fold=2)], COLS, fold="fold")
    mine = np.arange(700) % 5 == 2
    want = [((m.truncated(i + 1).predict(x[mine]) - y[mine]) ** 2).mean() for i in range(11)]
    assert m.curve == pytest.approx(want, abs=1e-6)


def test_models_fitted_together_equal_models_fitted_alone(frame):
    p = B.GBTParams(max_iter=4, max_depth=3, max_bins=16, patience=2)
    plans = [B.Plan(p, not_fold=f, val_fold=f) for f in range(3)] + [B.Plan(B.GBTParams(max_iter=3, seed=7, max_bins=16))]
    together = B.fit(frame, plans, COLS, fold="fold")
    for plan, m in zip(plans, together, strict=True):
        (alone,) = B.fit(frame.repartition(7), [plan], COLS, fold="fold")
        assert [as_nodes(t) for t in alone.trees] == [as_nodes(t) for t in m.trees]


def test_a_follower_ends_with_its_leader(frame):
    p = B.GBTParams(max_iter=60, step_size=.5, max_depth=4, patience=3, max_bins=16)
    lead, follow = B.fit(frame, [B.Plan(p, not_fold=0, val_fold=0), B.Plan(p, stops_with=0)], COLS, fold="fold")
    assert follow.fitted == lead.fitted < 60


def test_views_are_seen_by_their_models_only(frame, data):
    p = B.GBTParams(max_iter=2, max_depth=3, subsampling_rate=1, column_sample=1, max_bins=16)
    two = B.fit(frame, [B.Plan(p, view=0), B.Plan(p, view=1)], ["b", "d"], [["a"], ["c"]])
    for m, own in zip(two, ("a", "c"), strict=True):
        (alone,) = B.fit(frame, [B.Plan(p)], ["b", "d", own])
        assert [as_nodes(t) for t in m.trees] == [as_nodes(t) for t in alone.trees]


def test_odd_rows(spark):
    rows = [("a", None, 1.0), ("b", float("nan"), 2.0), ("c", 5.0, None), ("d", 5.0, 3.0)]
    frame = spark.createDataFrame(rows, "user_session string, x double, y double")
    p = B.GBTParams(max_iter=2, min_instances_per_node=1, subsampling_rate=1, column_sample=1, step_size=1)
    (m,) = B.fit(frame, [B.Plan(p)], ["x"])
    assert m.base == 2.0 and m.predict(np.array([[np.nan], [5.0]])) == pytest.approx([1.5, 3.0])
    with pytest.raises(ValueError, match="no rows"):
        B.fit(frame.where("y IS NULL"), [B.Plan(p)], ["x"])


def walked(tree, codes):
    """Rows moved down a level at a time."""
    feature, cut, left, _ = tree
    node, rows = np.zeros(codes.shape[1], np.int32), np.arange(codes.shape[1])
    while len(rows):
        f = feature[node[rows]]
        rows, f = rows[f >= 0], f[f >= 0]
        at = node[rows]
        node[rows] = left[at] + (codes[f, rows] > cut[at])
    return node


def grown(rng, splits, features):
    t, leaves = B.Tree(), [0]
    for _ in range(splits):
        at = leaves.pop(int(rng.integers(len(leaves))))
        t.feature[at], t.bin[at], t.left[at] = int(rng.integers(features)), int(rng.integers(64)), len(t.feature)
        leaves += [len(t.feature), len(t.feature) + 1]
        for x in (t.feature, t.left):
            x += [-1, -1]
        t.bin += [0, 0]
        t.value += rng.normal(size=2).tolist()
    return t.arrays()


def test_rows_move_down_a_tree_by_whole_arrays():
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 64, (30, 1 << 15)).astype(np.uint8)
    for splits in (0, 1, 30, 127, 128, 200):      # numbers of nodes on both sides of a byte
        tree = grown(rng, splits, 30)
        assert (B._leaves(tree, codes) == walked(tree, codes)).all()
    tree = grown(rng, 30, 30)

    def least(f):
        times = []
        for _ in range(7):
            began = time.perf_counter()
            f(tree, codes)
            times.append(time.perf_counter() - began)
        return min(times)
    assert least(B._leaves) < 0.7 * least(walked)


def test_features_of_few_bins_are_counted_together(monkeypatch):
    rng = np.random.default_rng(6)
    sizes = [64, 3, 64, 1, 5, 4, 2, 64, 7, 3, 2, 5]
    n, p = 5000, B.GBTParams(subsampling_rate=1, column_sample=1)
    codes = np.stack([rng.integers(0, s, n) for s in sizes]).astype(np.uint8)
    y = np.round(rng.normal(size=n), 3)
    fit = B._Fit(B.Plan(p), 0, 0.25, [np.arange(s - 1.0) for s in sizes], 2.0 ** -20)
    fit.start()
    block = B._block_row(n, codes.tobytes(), b"", np.zeros(n, np.int32).tobytes(), y.tobytes(), np.arange(n).tobytes(), np.zeros((1, n)).tobytes())
    seen, plain = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda x, *a, **k: seen.append(len(x)) or plain(x, *a, **k))
    twice = pa.Table.from_batches([block, block]).combine_chunks().to_batches()[0]
    (got,) = B._sums(iter([twice]), [fit.job({0: 0}, 0, False)], (len(sizes), 0, 1), 64)
    assert sum(seen) <= 2 * 2 * n * 5      # five groups at most, not twelve features
    g = np.rint((0.25 - y) * 2 ** 20)
    want = {1 + f * 64 + b: (2 * int(g[codes[f] == b].sum()), 2 * int((codes[f] == b).sum())) for f, s in enumerate(sizes) for b in range(s)}
    assert {r["slot"]: (r["g"], r["n"]) for r in got.to_pylist()} == want


def test_exact_edges_of_whole_columns(spark, monkeypatch):
    def spread(*_):
        raise AssertionError("a row for every value")
    monkeypatch.setattr(B.F, "posexplode", spread)
    near = np.nextafter(1.0, 2.0)
    rng = np.random.default_rng(8)
    columns = [[float(v) for v in (1, near, np.nextafter(near, 2.0), -1, -near)] * 40,          # values that agree in all but the last bits
               [0.0, -0.0, 5e-324, -5e-324, float("inf")] * 40,
               [float(v) for v in np.concatenate([rng.normal(size=100), 1e6 + rng.integers(0, 3, 100)])],
               [None, float("nan"), 2.0, 3.0, None] * 40,                       # missing values do not count
               [None] * 200]
    rows = spark.createDataFrame(list(zip(*columns, strict=True)), "a double, b double, c double, d double, e double").repartition(3)
    for bins in (2, 7, 64):
        got = B.exact_edges(rows, F.array("a", "b", "c", "d", "e"), 5, bins)
        for column, edges in zip(columns, got, strict=True):
            x = sorted(v for v in column if v is not None and v == v)
            want = sorted({x[int((len(x) - 1) * (i / (bins - 1)))] for i in range(bins)}) if x else []
            assert list(edges) == want[:-1]
