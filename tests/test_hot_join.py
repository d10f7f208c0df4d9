"""Frequent-items summary and the join that salts hot keys only."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickroll.operators import encode, hot_join


def test_merged_summaries_lose_little():
    rng = np.random.default_rng(1)
    for counters in (5, 20):
        keys, counts, seen = np.zeros(0, np.int64), np.zeros(0, np.int64), []
        for _ in range(40):
            batch = np.where(rng.random(300) < .3, 7, rng.integers(0, 400, 300))
            seen.append(batch)
            keys, counts = hot_join.merged(keys, counts, *np.unique(batch, return_counts=True), counters)
            assert len(keys) <= counters
        exact = dict(zip(*np.unique(np.concatenate(seen), return_counts=True), strict=True))
        for k, c in zip(keys.tolist(), counts.tolist(), strict=True):
            assert exact[k] - 12_000 / (counters + 1) <= c <= exact[k]
        assert 7 in keys


@pytest.fixture
def plain_shuffle(spark):
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _rows(spark, n=60_000):
    """Every third row has key 7, every twentieth none; the others are spread over 5,000 keys."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 20 == 1, F.lit(None)).otherwise(1000 + F.col("id") % 5000)
    return spark.range(0, n, 1, 6).select("id", key.cast("long").alias("k"))


def test_only_hot_keys_are_salted(spark, plain_shuffle):
    got = hot_join.hot_keys(_rows(spark), ["k"], 16).collect()
    want = spark.range(1).select(F.xxhash64(F.lit(7).cast("long")).alias("h")).first().h
    assert [r.h for r in got] == [want] and got[0].salts > 50


def test_no_task_gets_the_hot_key(spark, plain_shuffle):
    rows = _rows(spark)
    right = spark.range(900, 6100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).unionByName(spark.createDataFrame([(7, 77)], "k long, v long"))
    out = hot_join.spread_join(rows, right, ["k"], ["id"])
    assert out.columns == ["id", "k", "v"]
    sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect())
    assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    a = sorted(map(tuple, out.select("id", F.coalesce("k", F.lit(-1)), F.coalesce("v", F.lit(-1))).collect()))
    b = sorted(map(tuple, rows.join(right, "k", "left").select("id", F.coalesce("k", F.lit(-1)), F.coalesce("v", F.lit(-1))).collect()))
    assert a == b


def test_two_keys_several_lines_and_empty_sides(spark, plain_shuffle):
    left = spark.range(300).selectExpr("id", "'s' AS a", "id % 2 AS b")
    right = spark.createDataFrame([("s", 0, "x"), ("s", 0, "y"), ("t", 1, "z")], "a string, b long, v string")
    got = hot_join.spread_join(left, right, ["a", "b"], ["id"])
    assert got.count() == 150 * 2 + 150 and got.where("v IS NULL").count() == 150
    assert hot_join.spread_join(left.limit(0), right, ["a", "b"], ["id"]).count() == 0
    assert hot_join.spread_join(left, right.limit(0), ["a", "b"], ["id"]).where("v IS NULL").count() == 300


def test_encoding_of_a_hot_key(spark, plain_shuffle):
    rows = _rows(spark, 6_000).withColumn("y", (F.col("id") % 10).cast("double"))
    means = encode.mean_by_key(rows, "k", "y")
    a = encode.apply_encoding(rows, means, "k", "m", 0.5, spread=["id"])
    b = encode.apply_encoding(rows, means, "k", "m", 0.5)
    assert sorted((r.id, r.m) for r in a.collect()) == sorted((r.id, r.m) for r in b.collect())
