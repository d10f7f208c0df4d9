import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickroll.operators import folds


def _groups(spark, n_groups, per_group=2):
    rows = [(f"s{g}-{i}", g, float(g)) for g in range(n_groups) for i in range(per_group)]
    return spark.createDataFrame(rows, "user_session string, user_id long, session_value double")


def _fold_sizes(df, group="user_id"):
    per = {r[group]: r["fold"] for r in df.select(group, "fold").distinct().collect()}
    return per, Counter(per.values())


def test_thirteen_groups_five_folds(spark):
    per, sizes = _fold_sizes(folds.group_folds(_groups(spark, 13), k=5, seed=42))
    assert len(per) == 13
    assert sorted(sizes.values(), reverse=True) == [3, 3, 3, 2, 2]
    assert [sizes[f] for f in range(1, 6)] == [3, 3, 3, 2, 2]


def test_each_group_in_one_fold(spark):
    df = folds.group_folds(_groups(spark, 200, 3), k=7, seed=1)
    assert df.groupBy("user_id").agg(F.count_distinct("fold").alias("n")).where("n <> 1").count() == 0
    _, sizes = _fold_sizes(df)
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_multi_seed_matches_single_seed(spark):
    g = _groups(spark, 50)
    multi = folds.group_folds_by_seed(g, "user_id", 5, (3, 4))
    for s in (3, 4):
        single = {r["user_session"]: r["fold"] for r in folds.group_folds(g, "user_id", 5, s).collect()}
        got = {r["user_session"]: r[f"fold_{s}"] for r in multi.collect()}
        assert got == single


def test_hash_method_in_range(spark):
    df = folds.group_folds(_groups(spark, 100), k=5, method="hash")
    assert {r["fold"] for r in df.collect()} <= set(range(1, 6))


def test_balanced_folds_spread_large_groups(spark):
    rows = [(f"s{g}-{i}", g, 1.0) for g in range(20) for i in range(g + 1)]
    df = spark.createDataFrame(rows, "user_session string, user_id long, session_value double")
    out = folds.balanced_group_folds(df, k=4)
    load = Counter(r["fold"] for r in out.collect())
    assert set(load) == {1, 2, 3, 4}
    assert max(load.values()) - min(load.values()) <= 20     # within one largest group
    assert out.groupBy("user_id").agg(F.count_distinct("fold").alias("n")).where("n <> 1").count() == 0


def _sized_groups(spark, sizes):
    rows = [(f"s{g}-{i}", g, 1.0) for g, n in enumerate(sizes) for i in range(n)]
    return spark.createDataFrame(rows, "user_session string, user_id long, session_value double")


def _greedy(sizes, k):
    """Loads and folds of a plain deal, one group at a time."""
    loads, folds_ = [0] * k, []
    for n in sizes:
        f = loads.index(min(loads))
        loads[f] += n
        folds_.append(f + 1)
    return loads, folds_


def test_deal_by_classes_equals_a_plain_deal():
    rnd = random.Random(1)
    for _ in range(1500):
        k = rnd.randint(1, 7)
        sizes = sorted((rnd.choice([1, 1, 1, 2, 3, 7, rnd.randint(1, 300)]) for _ in range(rnd.randint(0, 60))), reverse=True)
        classes = sorted(Counter(sizes).items(), reverse=True)
        got = []
        for (size, count), (same, starts, members) in zip(classes, folds.deal_classes(classes, k), strict=True):
            assert same == size
            for rank in range(count):
                piece = sum(x <= rank for x in starts) - 1
                got.append(members[piece][(rank - starts[piece]) % len(members[piece])])
        assert got == _greedy(sizes, k)[1]


@pytest.mark.parametrize("sizes, k", [([1000, 400, 390, 380] + [1] * 3000, 10), ([13, 11, 9, 7, 6, 5, 3, 2, 1], 3), ([], 4), ([5], 4), ([2, 2, 2], 2),
                                      ([1] * 1500 + [2] * 700 + [40, 90], 4), ([100] + [3] * 90 + [2] * 50, 7)])
def test_balanced_folds_equal_a_plain_deal(spark, sizes, k, monkeypatch):
    monkeypatch.setattr(folds, "RANK_ROWS", 100)     # several ranges a size
    rows = _sized_groups(spark, sizes) if sizes else _sized_groups(spark, [1]).limit(0)
    got = folds.balanced_group_folds(rows, k=k).collect()
    per = {}
    for r in got:
        per.setdefault(r["user_id"], set()).add(r["fold"])
    assert len(per) == len(sizes) and all(len(f) == 1 for f in per.values())
    load = Counter(r["fold"] for r in got)
    want, _ = _greedy(sorted(sizes, reverse=True), k)
    assert [load[f + 1] for f in range(k)] == want


def test_balanced_folds_join_many_size_classes(spark, monkeypatch):
    monkeypatch.setattr(folds, "BROADCAST_CLASSES", 0)
    sizes = list(range(1, 40)) + [1] * 50
    load = Counter(r["fold"] for r in folds.balanced_group_folds(_sized_groups(spark, sizes), k=5).collect())
    assert [load[f + 1] for f in range(5)] == _greedy(sorted(sizes, reverse=True), 5)[0]


def test_balanced_folds_null_group(spark):
    rows = _sized_groups(spark, [3, 2]).withColumn("user_id", F.when(F.col("user_id") == 1, F.col("user_id")))
    out = folds.balanced_group_folds(rows, k=2).collect()
    assert len(out) == 5 and {(r["user_id"], r["fold"]) for r in out} == {(None, 1), (1, 2)}


def test_holdout_size(spark):
    out = folds.group_holdout(_groups(spark, 31), test_size=0.1, seed=2025)
    held = {r["user_id"] for r in out.where("is_holdout").collect()}
    assert len(held) == 4        # ceil(3.1)


def test_baseline_cv_matches_manual(spark):
    df = folds.group_folds(_groups(spark, 10, 2), k=5, seed=42)
    got = {r["fold"]: r for r in folds.baseline_cv(df).collect()}
    pdf = df.toPandas()
    for f, r in got.items():
        tr, va = pdf[pdf.fold != f], pdf[pdf.fold == f]
        mu = tr.session_value.mean()
        assert r["train_mean"] == pytest.approx(mu)
        assert r["val_mse"] == pytest.approx(((va.session_value - mu) ** 2).mean())
        assert (r["n_tr"], r["n_va"]) == (len(tr), len(va))
