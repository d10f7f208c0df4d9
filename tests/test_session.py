from pyspark.sql import functions as F

from clickroll.session import materialize, scale_conf, stable_layout


def test_scale_conf_sizes_partitions():
    c = scale_conf(100 * 2**40, 8000)
    parts = int(c["spark.sql.shuffle.partitions"])
    assert 8000 * 2 <= parts <= 100 * 2**40 // (256 << 20)
    assert int(c["spark.sql.files.maxPartitionBytes"]) == 256 << 20
    assert int(scale_conf(10 << 20, 16)["spark.sql.shuffle.partitions"]) == 32


def test_stable_layout_is_repeatable(spark):
    df = spark.range(5000).withColumn("k", (F.col("id") * 7919) % 5000).repartition(13)
    def layout():
        out = stable_layout(df, ["k"], partitions=4).withColumn("p", F.spark_partition_id())
        return [(r["p"], r["k"]) for r in out.collect()]
    assert layout() == layout()


def test_materialize_cuts_lineage(spark):
    df = materialize(spark.range(100).withColumn("x", F.col("id") * 2))
    plan = df._jdf.queryExecution().analyzed().toString()
    assert "Range" not in plan and df.count() == 100
