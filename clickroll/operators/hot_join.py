"""Left join that finds its own hot keys and deals their rows over many tasks.

Adaptive execution splits a skewed join only where a plain shuffle sits under both sides.
This join needs no such plan. A mergeable summary of frequent items (Misra-Gries: as many
counters a task as asked for, the smallest taken off when there are more) proposes keys,
an exact recount of the few proposed decides, and only the hot ones are salted: their rows
are dealt over salts, and their lines on the other side are copied once a salt.

With P shuffle partitions a key is hot from a 1 / (SHARE * P) share of the rows on. So at
most SHARE * P keys are hot and at most 2 * SHARE * P copies are made, whatever the data.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickroll.session import materialize

SHARE = 16


def merged(keys: np.ndarray, counts: np.ndarray, more_keys: np.ndarray, more_counts: np.ndarray, counters: int) -> tuple[np.ndarray, np.ndarray]:
    """Two summaries as one of at most ``counters`` keys. What is taken off a key is at most the
    rows taken in, divided by ``counters`` + 1."""
    found, at = np.unique(np.concatenate([keys, more_keys]), return_inverse=True)
    total = np.bincount(at, np.concatenate([counts, more_counts]), len(found)).astype(np.int64)
    if len(found) > counters:
        total = total - np.partition(total, len(total) - counters - 1)[len(total) - counters - 1]
        found, total = found[total > 0], total[total > 0]
    return found, total


def _summary(batches: Iterator[pa.RecordBatch], counters: int) -> Iterator[pa.RecordBatch]:
    keys, counts, n = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    for b in batches:
        new, c = np.unique(b.column(0).to_numpy(zero_copy_only=False), return_counts=True)
        keys, counts = merged(keys, counts, new, c, counters)
        n += b.num_rows
    yield pa.RecordBatch.from_arrays([pa.array([*keys.tolist(), None], pa.int64()), pa.array([*counts.tolist(), n], pa.int64())], names=["h", "n"])


def _hash(on: Sequence[str]) -> Column:
    return F.xxhash64(*on)


def hot_keys(rows: DataFrame, on: Sequence[str], partitions: int) -> DataFrame:
    """(h, salts): hashes of the keys with more than 1 / (SHARE * partitions) of the rows, and
    over how many salts to deal them. Rows with a missing key are not counted."""
    full = rows.select(*on).dropna().select(_hash(on).alias("h"))
    counters = 2 * SHARE * partitions
    lines = materialize(full.mapInArrow(partial(_summary, counters=counters), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")))
    total = lines.where("h IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bar = max(1, total // (SHARE * partitions))
    # a key over the bar shows at least half of it, so at most ``counters`` keys are proposed
    proposed = lines.where(F.col("h").isNotNull() & (2 * F.col("n") >= bar)).select("h")
    exact = full.join(F.broadcast(proposed), "h").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    return materialize(exact.where(F.col("n") > bar).select("h", F.ceil(F.col("n") / bar).cast("int").alias("salts")))


def spread_join(left: DataFrame, right: DataFrame, on: Sequence[str], spread: Sequence[str]) -> DataFrame:
    """[J3-J5 J7] Left join on the columns ``on``. Rows of a hot key are dealt by a hash of
    the columns ``spread``, which should differ between them. Rows with a missing key match
    nothing and are dealt over all partitions."""
    on = list(on)
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(left, on, partitions)
    names = [*left.columns, *[c for c in right.columns if c not in on]]
    missing = F.lit(False)
    for c in on:
        missing = missing | F.col(c).isNull()

    def marked(df: DataFrame) -> DataFrame:
        return (df.withColumn("_h", _hash(on)).join(F.broadcast(hot.withColumnRenamed("h", "_hot")), F.col("_h") == F.col("_hot"), "left")
                .drop("_h", "_hot"))
    salt = F.pmod(F.xxhash64(*spread), F.when(missing, F.lit(partitions)).otherwise(F.coalesce("salts", F.lit(1))))
    a = marked(left).withColumn("_salt", salt.cast("int")).drop("salts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))
    b = marked(right).withColumn("_salt", copies).drop("salts")
    return a.join(b, [*on, "_salt"], "left").select(*names)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
