import tempfile

from pyspark.sql import types as T

from clickroll.functions.schema import detect_time_column, feature_columns, numeric_only, require_columns
from clickroll.sources import files

import pytest


def test_csv_null_tokens_and_types(spark):
    d = tempfile.mkdtemp(prefix="clickroll-test-")
    with open(f"{d}/e.csv", "w") as fh:
        fh.write("user_id,event_type,session_value\n1,NA,1.5\nnull,VIEW,nan\n3,,x\n")
    schema = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                           T.StructField("session_value", T.DoubleType())])
    rows = files.read_events_csv(spark, d, schema).orderBy("row_no").collect()
    assert [r["user_id"] for r in rows] == [1, None, 3]
    assert [r["event_type"] for r in rows] == [None, "VIEW", None]
    assert [r["session_value"] for r in rows] == [1.5, None, None]


def test_numeric_only_bool_and_strings(spark):
    df = spark.createDataFrame([(True, "a", 1.0)], "flag boolean, name string, x double")
    out, kept, dropped = numeric_only(df, ["flag", "name", "x"])
    assert kept == ["flag", "x"] and dropped == ["name"]
    assert out.first()["flag"] == 1


def test_schema_helpers(spark):
    df = spark.createDataFrame([(1, 2)], "a int, ts int")
    with pytest.raises(ValueError, match="missing columns"):
        require_columns(df, ["a", "b"])
    assert detect_time_column(["x", "ts", "time"]) == "time"
    assert feature_columns(["a", "b", "c", "a"], ["b"], ["d", "a"]) == ["a", "c", "d"]


def test_feature_table_parquet_then_csv(spark):
    d = tempfile.mkdtemp(prefix="clickroll-test-")
    spark.range(3).write.option("header", True).csv(f"{d}/session_features_v1_train.csv")
    spark.range(2).write.option("header", True).csv(f"{d}/session_features_v1_test.csv")
    spark.range(5).write.parquet(f"{d}/session_features_v1_train.parquet")
    assert files.read_feature_table(spark, f"{d}/session_features_v1_train").count() == 5
    ver, tr, te = files.read_features_versioned(spark, d)
    assert ver == "v1" and te.count() == 2
    with pytest.raises(FileNotFoundError):
        files.read_feature_table(spark, f"{d}/nothing")
