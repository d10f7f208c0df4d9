"""Incremental session features from a stream of event files.

The reference works in batch only; this is the same feature operator kept fresh as
event files arrive. Each micro-batch (``foreachBatch``):

1. appends its contract rows to an event store partitioned by
   (``_bucket`` = hash(session) mod B, ``_epoch``), overwriting only that epoch's
   partitions, so a replayed epoch after a failure writes the same files again;
2. recomputes features for the buckets the batch touched, from the store (the bucket
   filter prunes partitions), and overwrites exactly those bucket partitions of the
   feature table (dynamic partition overwrite).

A session's events always land in one bucket, so a bucket's features are complete.
Progress and exactly-once replay come from the stream checkpoint; work per batch
grows with the touched buckets, not with the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickroll.operators import features as feat

DEFAULT_BUCKETS = 64


def session_bucket(buckets: int):
    return F.pmod(F.xxhash64(F.col("user_session")), F.lit(buckets)).cast("int")


def _overwrite_partitions(df: DataFrame, path: str, partition_by) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).parquet(path))


def refresh_session_features(batch: DataFrame, epoch_id: int, store: str, table: str,
                             types, codes=None, version: str = "v1",
                             buckets: int = DEFAULT_BUCKETS) -> None:
    """One micro-batch: persist its events, then rebuild the touched buckets."""
    spark = batch.sparkSession
    rows = (batch.where(F.col("user_session").isNotNull())
            .withColumn("_bucket", session_bucket(buckets))
            .withColumn("_epoch", F.lit(int(epoch_id))))
    _overwrite_partitions(rows, store, ["_bucket", "_epoch"])
    touched = [r["_bucket"] for r in rows.select("_bucket").distinct().collect()]  # <= buckets values
    if not touched:
        return
    ev = spark.read.parquet(store).where(F.col("_bucket").isin(touched))
    if version == "v2":
        f = feat.session_features_v2(ev, types=types, codes=codes)
    else:
        f = feat.session_features_v1(ev, types=types)
    _overwrite_partitions(f.withColumn("_bucket", session_bucket(buckets)), table, ["_bucket"])


def start_session_feature_stream(spark: SparkSession, events: DataFrame, store: str, table: str,
                                 checkpoint: str, types, codes=None, version: str = "v1",
                                 buckets: int = DEFAULT_BUCKETS, available_now: bool = True):
    """Start the refresh stream over a streaming contract frame ``events``.

    ``types`` (and ``codes`` for v2) fix the feature schema up front: a stream cannot
    widen its output table batch by batch.
    """
    w = (events.writeStream
         .foreachBatch(lambda df, e: refresh_session_features(df, e, store, table, types, codes,
                                                               version, buckets))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
