"""Helpers shared by the corpus operators.

Operators take any DataFrame that has the columns they name and select just those, so
extra columns of whatever name can never clash with working columns. Functions that
return whole rows carry the row in one struct (``pack`` / ``unpack``).
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def ship(module_name: str) -> None:
    """Send this module's functions to executors by value, so that workers need no copy
    of the package on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def table(sf_dir: str, name: str, spark: SparkSession) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later stages share one result,
    prune its columns, and a lost executor costs a reread instead of a recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` computed once. A column used inside a lambda is otherwise
    recomputed for every element, as projections are merged."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_of(col: str) -> Column:
    """The whole text; a missing text counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def split_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def pack(df: DataFrame) -> DataFrame:
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def unpack(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col("row").getField(c).alias(c) for c in columns])


#: Keys with more rows than ``max(HOT_FLOOR, rows / HOT_KEYS)`` are salted; there can be
#: at most HOT_KEYS such keys, so the table of them is safe to broadcast.
HOT_KEYS, HOT_FLOOR = 1000, 64


def salted_lookup(rows: DataFrame, stats: DataFrame, key: str, count: str, total: int,
                  spread: Column) -> DataFrame:
    """Left join of ``rows`` with ``stats`` (one row a key; ``count`` says how many rows
    the key has) in which a frequent key is dealt over many tasks.

    A key above the bar gets ceil(count / bar) salts. The rows pick one by ``spread``, a
    hash of something that differs between rows; the key's line in ``stats`` is copied
    once a salt, at most 2 * HOT_KEYS copies in all.
    """
    bar = max(HOT_FLOOR, total // HOT_KEYS)
    salts = F.ceil(F.col(count) / bar).cast("int")
    hot = stats.where(F.col(count) > bar).select(F.col(key).alias("_hot_key"), salts.alias("_salts"))
    left = (rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
            .withColumn("_salt", F.when(F.col("_salts").isNull(), F.lit(0))
                        .otherwise(F.pmod(spread, F.col("_salts")).cast("int")))
            .drop("_hot_key", "_salts"))
    right = stats.withColumn("_salt", F.explode(F.when(
        F.col(count) > bar, F.sequence(F.lit(0), salts - 1)).otherwise(F.array(F.lit(0)))))
    return left.join(right, [key, "_salt"], "left").drop("_salt")


ship(__name__)
