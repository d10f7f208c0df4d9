"""Mixing sources to target weights by weighted fair queueing.

Each source queues its documents in a shuffled order (md5 of seed and id), round after
round up to ``max_repeats``; a copy's virtual finish time is the source's cumulative
words, this copy included, divided by the source's target. All copies are range-sorted
by finish time, and the mix is the longest run from the front within the total budget.

Targets: sources in code-point order, a missing one last, take ``weights`` in turn and
share ``share`` times all words; a target stops at ``max_repeats`` times its source's
words and the excess goes to the others by weight.

At scale: a source's cumulative sums run over buckets of its shuffled order (a source
holding a third of all rows is dealt over all of them), finish times are dealt by range
with the ties broken by the shuffle, and only the one range that the budget ends in is
summed row by row. What meets in one task is a line a source, a line a bucket of one
source, or a line a range.

Edge cases: missing or empty texts have size 0 and take 0. A source without words has
target 0. Several rows of one id, equal or not, are documents of their own and queue one by
one. A missing id is a document like others. Empty input: empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACES, pack, ship, stored, text_of, unpack

WEIGHTS, SHARE, MAX_REPEATS, SEED = (3.0, 1.0, 2.0), 1.5, 2, "mix-1"
#: rows of all sources to a bucket of the shuffled order, and the most buckets
BUCKET_ROWS, MAX_BUCKETS = 2048, 1 << 16


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs: white space first set to single blanks."""
    flat = F.trim(F.regexp_replace(text, SPACES, " "))
    return F.when(flat == "", F.lit(0)).otherwise(
        F.length(flat) - F.length(F.replace(flat, F.lit(" "))) + 1).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
            max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target) from (source, size): one line a source.

    A capped source is one whose cap per weight is under the water level; with sources
    sorted by cap per weight the level follows from running sums."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").isNull(), F.col("source"))
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    per = per.select("*", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1).alias("weight"))
    per = per.select("*", (F.col("source_size") * float(max_repeats)).alias("cap"))
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    per = per.select(
        "*",
        ((F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))).alias("level"))
    # the level at a source says what a unit of weight gets if all before it are capped
    per = per.select("*", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(
        F.row_number().over(by_ratio).alias("at"), F.col("level").alias("level")))).over(everything).alias("fit"))
    return per.select("source", "source_size", F.least(
        F.col("cap"), F.coalesce(F.col("weight") * F.col("fit.level"), F.col("cap"))).alias("target"))


def _taken(rows: DataFrame, weights: Sequence[float], share: float, max_repeats: int, seed: str) -> DataFrame:
    """The rows with source_size, target, copies and taken, of every row of
    (row_id, doc_id, row_key, source, size)."""
    spark = rows.sparkSession
    rows = stored(rows.withColumn("h", F.md5(F.concat_ws(":", F.lit(seed), F.col("row_id").cast("string")))), "mix-rows")
    n = rows.count()
    digits = max(0, min(int(math.log2(MAX_BUCKETS)), math.ceil(math.log2(max(1, n / BUCKET_ROWS)))))
    bucket = F.shiftright(F.conv(F.substring("h", 1, 8), 16, 10).cast("long"), 32 - digits)
    rows = rows.withColumn("bucket", bucket)
    goals = stored(targets(rows, weights, share, max_repeats), "mix-targets")
    per_bucket = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    start = F.coalesce(F.sum("words").over(W.partitionBy("source").orderBy("bucket").rowsBetween(
        W.unboundedPreceding, -1)), F.lit(0)).alias("start")
    per_bucket = (per_bucket.select(F.col("source").alias("s"), F.col("bucket").alias("b"), start)
                  .join(goals, F.col("s").eqNullSafe(F.col("source"))).drop("source"))
    inside = F.sum("size").over(W.partitionBy("source", "bucket").orderBy("h", "row_id"))
    queued = rows.withColumn("inside", inside).join(
        per_bucket, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    queued = queued.select("row_id", "doc_id", "row_key", "source", "size", "source_size", "target", "h",
                           (F.col("start") + F.col("inside")).alias("done"))
    copies = queued.select("*", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("copy"))
    finish = F.coalesce((F.col("copy") * F.col("source_size") + F.col("done")) / F.nullif(F.col("target"), F.lit(0.0)),
                        F.lit(0.0))
    copies = copies.select("*", finish.alias("finish"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(copies.repartitionByRange(ranges, "finish", "h", "row_id", "copy")
                   .withColumn("part", F.spark_partition_id()), "mix-queue")
    budget = goals.agg(F.round(F.coalesce(F.sum("target"), F.lit(0.0)), 3).alias("budget")).scalar()
    per_part = dealt.groupBy("part").agg(F.sum("size").alias("words"))
    ahead = F.coalesce(F.sum("words").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    per_part = stored(per_part.select("part", "words", ahead.alias("ahead")), "mix-ranges")
    whole = per_part.where(F.col("ahead") + F.col("words") <= budget)
    cut = per_part.where((F.col("ahead") <= budget) & (F.col("ahead") + F.col("words") > budget))
    last = (dealt.join(F.broadcast(cut.select("part", "ahead")), "part")  # the one range the budget ends in
            .withColumn("sum", F.col("ahead") + F.sum("size").over(
                W.partitionBy("part").orderBy("finish", "h", "row_id", "copy")))
            .where(F.col("sum") <= budget).select("row_id"))
    last_part = F.coalesce(whole.agg(F.max("part")).scalar(), F.lit(-1))
    used = (dealt.where(F.col("part") <= last_part).select("row_id").unionByName(last)
            .groupBy("row_id").agg(F.count("*").alias("copies")))
    base = dealt.where("copy = 0").select("row_id", "doc_id", "row_key", "size", "source", "source_size", "target")
    return base.join(used, "row_id", "left").select(
        "*", F.coalesce("copies", F.lit(0)).alias("_c")).drop("copies").withColumnRenamed("_c", "copies").withColumn(
        "taken", F.col("size") * F.col("copies"))


def _numbered(docs: DataFrame) -> DataFrame:
    """A name for each row: its id, and, where an id is missing or repeats, a number too."""
    key = W.partitionBy("doc_id", "_salt").orderBy("source", "size", "row_key")
    spread = docs.withColumn("_salt", F.when(F.col("doc_id").isNull(), F.pmod("row_key", F.lit(4096))))
    number = F.row_number().over(key)
    return spread.select(
        F.concat_ws("#", F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("none"), F.col("_salt").cast("string"))),
                    F.when((number > 1) | F.col("doc_id").isNull(), number)).alias("row_id"),
        *[c for c in docs.columns])


def _sized(docs: DataFrame, row: str = "") -> list[Column]:
    source, text = F.col(row + "source").cast("string"), F.coalesce(F.col(row + "text").cast("string"), F.lit(""))
    return [F.col(row + "doc_id").cast("long").alias("doc_id"), source.alias("source"),
            word_count(text).alias("size"), F.xxhash64(source, text).alias("row_key")]


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
        max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """(doc_id, row_key, source, size, source_size, target, copies, taken) of every row;
    row_key is a hash of source and text."""
    return _taken(_numbered(docs.select(*_sized(docs))), weights, share, max_repeats, seed).drop("row_id")


def mixed_rows(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
               max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """The mix itself: whole rows, as often as they are taken. Rows equal in id, source and
    text are one row here, which comes as often as all of them are taken."""
    plan = mix(docs, weights, share, max_repeats, seed)
    often = plan.groupBy("doc_id", "row_key").agg(F.sum("copies").alias("copies")).where("copies > 0")
    rows = pack(docs)
    rows = rows.select("row", *_sized(rows, "row.")).alias("l")
    chosen = (rows.join(often.alias("r"), F.col("l.doc_id").eqNullSafe(F.col("r.doc_id"))
                        & (F.col("l.row_key") == F.col("r.row_key")))
              .select("l.row", "l.doc_id", "l.row_key", "copies").dropDuplicates(["doc_id", "row_key"]))
    return unpack(chosen.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row"),
                  docs.columns)


ship(__name__)
