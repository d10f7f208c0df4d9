"""Plan checks: no Python evaluation in feature plans, bounded exchanges."""

import re

from clickroll.operators import features as feat
from clickroll.sources.adapters import clickstream_source

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_plans_stay_in_the_jvm(spark):
    ev = clickstream_source(spark, SF).events
    for df in (feat.session_features_v1(ev), feat.session_features_v2(ev)):
        p = _plan(df)
        assert "PythonUDF" not in p and "EvalPython" not in p and "ArrowEval" not in p


def test_v2_exchanges_bounded_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ev = clickstream_source(spark, SF).events
        df = feat.session_features_v2(ev, types=["BUY", "CART", "ERROR", "SIGNUP", "VIEW"],
                                      codes=["BUY", "CART", "ERROR", "SIGNUP", "VIEW"])
        p = df._jdf.queryExecution().sparkPlan().toString()
        from pyspark.sql import SparkSession  # noqa: F401
        full = df._jdf.queryExecution().executedPlan().toString()
        n_exchange = len(re.findall(r"Exchange hashpartitioning", full))
        # base aggregate: 1, grouping-sets pre-aggregate: 2; the join reuses session partitioning
        assert n_exchange == 3, full
        assert "SortMergeJoin" in full or "SortMergeJoin" in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scan_prunes_columns(spark):
    ev = clickstream_source(spark, SF).events
    p = _plan(feat.session_features_v1(ev))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert schemas and all("value" not in s for s in schemas)


def test_v1_single_aggregate_two_exchanges(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ev = clickstream_source(spark, SF).events
        df = feat.session_features_v1(ev, types=["BUY", "CART", "ERROR", "SIGNUP", "VIEW"])
        full = df._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning", full)) == 2, full
        assert "Join" not in full and "SortAggregate" not in full
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
