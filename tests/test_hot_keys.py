"""One session or user with half of all rows: the joins back to it are split."""

import pytest
from pyspark.sql import functions as F

from clickroll.operators import encode, labels
from clickroll.sources.adapters import clickstream_source

LOW_BARS = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000"}


@pytest.fixture
def low_bars(spark):
    before = {k: spark.conf.get(k, None) for k in LOW_BARS}
    for k, v in LOW_BARS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _events(spark, n=40_000):
    """User 7 has every second event, all on one day; the others are spread over 250 users."""
    hot = F.col("id") % 2 == 0
    return spark.range(0, n, 1, 8).select(
        F.col("id").alias("event_id"),
        F.when(hot, F.lit(7)).otherwise(100 + F.col("id") % 500).cast("long").alias("user_id"),
        F.lit("view").alias("event_type"),
        F.format_string('{"k": %d}', F.col("id") % 50).alias("props"),
        (F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id") % 3600)).alias("ts"),
        F.lit(0.25).alias("value"))


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_event_level_labels_split_a_hot_session(spark, low_bars, tmp_path):
    _events(spark).write.parquet(f"{tmp_path}/events.parquet")
    src = clickstream_source(spark, str(tmp_path))
    assert "skew=true" in _final_plan(src.labeled)
    hot = src.labeled.where(F.col("user_id") == 7).agg(F.count("*").alias("n"), F.max("session_value").alias("v")).first()
    assert (hot.n, hot.v) == (20_000, 5_000.0)


def test_labels_read_one_row_per_user_and_session(spark, tmp_path):
    _events(spark).write.parquet(f"{tmp_path}/events.parquet")
    src = clickstream_source(spark, str(tmp_path))
    assert src.label_rows.count() == 251
    for make in (labels.labels_first_per_session, labels.labels_first_per_user_session):
        short = {tuple(r) for r in make(src.label_rows).select("user_id", "user_session", "session_value").collect()}
        full = {tuple(r) for r in make(src.labeled).select("user_id", "user_session", "session_value").collect()}
        assert short == full and len(full) == 251


def test_user_means_split_a_hot_user(spark, low_bars):
    rows = _events(spark).select("user_id", F.sha2(F.col("event_id").cast("string"), 256).alias("user_session"),
                                 (F.col("event_id") % 10).cast("double").alias("y"))
    means = encode.mean_by_key(rows, "user_id", "y")
    out = encode.apply_encoding(rows, means, "user_id", "u", 0.0)
    assert "skew=true" in _final_plan(out)
    assert out.count() == 40_000
