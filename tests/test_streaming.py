"""Incremental features: a session split over two arriving files ends up complete."""

import tempfile

from pyspark.sql import functions as F

from clickroll.operators import features as feat
from clickroll.streaming import start_session_feature_stream

from conftest import EVENT_SCHEMA, rows_by


def test_session_spanning_batches(spark, events):
    base = tempfile.mkdtemp(prefix="clickroll-stream-")
    inbox = f"{base}/in"
    first = events([{"user_session": "a", "event_type": "VIEW", "row_no": 0},
                    {"user_session": "b", "event_type": "BUY", "row_no": 1}])
    second = events([{"user_session": "a", "event_type": "BUY", "row_no": 2, "product_id": 9},
                     {"user_session": "c", "event_type": "CART", "row_no": 3}])
    contract = [c for c in EVENT_SCHEMA.fieldNames() if c != "session_value"]
    types = ["BUY", "CART", "VIEW"]

    def run():
        stream = spark.readStream.schema(first.select(*contract).schema).parquet(inbox)
        q = start_session_feature_stream(spark, stream, f"{base}/store", f"{base}/features",
                                         f"{base}/ck", types, version="v1", buckets=4)
        q.awaitTermination()
        return rows_by(spark.read.parquet(f"{base}/features").drop("_bucket"), "user_session")

    first.select(*contract).write.mode("append").parquet(inbox)
    got = run()
    assert set(got) == {"a", "b"} and got["a"]["session_event_count"] == 1
    second.select(*contract).write.mode("append").parquet(inbox)
    got = run()
    batch = rows_by(feat.session_features_v1(first.unionByName(second).drop("session_value"), types=types),
                    "user_session")
    assert got == batch
    assert got["a"]["session_event_count"] == 2 and got["a"]["unique_product_count"] == 2
    # replaying the same input adds nothing
    assert run() == batch
    assert spark.read.parquet(f"{base}/store").where(F.col("user_session") == "a").count() == 2


def test_v2_stream_matches_batch(spark, events):
    base = tempfile.mkdtemp(prefix="clickroll-stream-")
    df = events([{"user_session": "a", "event_type": "VIEW", "t": 3}, {"user_session": "a", "event_type": "BUY", "t": 1},
                 {"user_session": "b", "event_type": "CART", "t": None}])
    contract = [c for c in EVENT_SCHEMA.fieldNames() if c != "session_value"]
    df.select(*contract).write.parquet(f"{base}/in")
    types, codes = ["BUY", "CART", "VIEW"], ["BUY", "CART", "VIEW"]
    stream = spark.readStream.schema(df.select(*contract).schema).parquet(f"{base}/in")
    start_session_feature_stream(spark, stream, f"{base}/store", f"{base}/features", f"{base}/ck",
                                 types, codes, version="v2", buckets=2).awaitTermination()
    got = rows_by(spark.read.parquet(f"{base}/features").drop("_bucket"), "user_session")
    want = rows_by(feat.session_features_v2(df.select(*contract), types=types, codes=codes), "user_session")
    assert got == want
