import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from clickroll.session import BASE_CONF, checkpoint_dir  # noqa: E402

EVENT_SCHEMA = T.StructType([
    T.StructField("row_no", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("user_session", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("category_id", T.LongType()),
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("split", T.StringType()),
    T.StructField("session_value", T.DoubleType()),
])

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def at(seconds):
    return None if seconds is None else T0 + dt.timedelta(seconds=seconds)


@pytest.fixture(scope="session")
def spark():
    b = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s


@pytest.fixture
def events(spark):
    """Build an event frame from dicts; missing fields default sensibly."""
    def make(rows):
        out = []
        for i, r in enumerate(rows):
            out.append((
                r.get("row_no", i), r.get("user_id", 1), r.get("user_session", "s1"),
                r.get("event_type", "VIEW"), r.get("product_id", 1), r.get("category_id", 1),
                at(r["t"]) if "t" in r else at(i), r.get("split", "train"), r.get("session_value", 1.0)))
        return spark.createDataFrame(out, EVENT_SCHEMA)
    return make


def rows_by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}
