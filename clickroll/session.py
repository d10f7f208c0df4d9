"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: adaptive execution (runtime coalescing, skew-join
# splitting, broadcast conversion from measured sizes), UTC session time and no UI.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a long-lived session runs many distinct plans; keep their compiled code
    # (the default cache of 100 generated classes thrashes and recompiles)
    "spark.sql.codegen.cache.maxEntries": "2000",
}


def build_session(master: str | None = None, app_name: str = "clickroll",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, executors_cores: int, target_partition_bytes: int = 256 << 20,
               shuffle_fraction: float = 0.2) -> dict:
    """Partition sizing for a given input volume (e.g. 100 TB on 1,000 executors).

    Scan splits and shuffle partitions aim at ``target_partition_bytes`` so a task's
    share fits in executor memory. Shuffles carry projected, partially aggregated rows,
    about ``shuffle_fraction`` of the scanned bytes; the initial shuffle partition count
    is sized from that, and adaptive execution coalesces small partitions at run time
    and splits skewed ones.
    """
    parts = max(executors_cores * 2, int(input_bytes * shuffle_fraction) // target_partition_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 2),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it; without it a job fails here, before it writes
    anything. Only a single local process (tests) gets a private folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="clickroll-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written hand-over tables."""
    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df):
    """Write a frame that several later stages read to the shared checkpoint folder
    (reliable ``checkpoint``) and cut its lineage: consumers read it back instead of
    recomputing its whole plan, and a lost executor does not trigger a recompute
    from the raw tables."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stable_layout(df, keys, partitions: int | None = None):
    """Deterministic partitioning and in-partition order on a unique row key.

    Shuffle output order depends on map-output arrival; order-sensitive consumers
    (seeded subsampling in boosted trees, sampled split candidates) then differ between
    runs. An explicit partition count (adaptive execution does not coalesce it) and a
    sort on the key fix both. Apply before ``materialize`` so the written layout is
    the stable one. The default count is ``spark.sql.shuffle.partitions``, a setting of
    the job: the layout, and a model trained on it, do not depend on the cores at hand."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys).sortWithinPartitions(*keys)
