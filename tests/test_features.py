import math

import pytest
from pyspark.sql import functions as F

from clickroll.operators import features as feat

from conftest import rows_by


def v2(df, **kw):
    return rows_by(feat.session_features_v2(df, **kw), "user_session")


def test_null_event_type_counts_and_entropy(events):
    df = events([{"event_type": "VIEW"}, {"event_type": None}, {"event_type": "BUY"}])
    r = v2(df)["s1"]
    assert r["session_event_count"] == 3
    assert r["event_type_count_VIEW"] + r["event_type_count_BUY"] == 2
    assert r["event_type_ratio_VIEW"] + r["event_type_ratio_BUY"] == pytest.approx(2 / 3)
    assert r["event_type_entropy"] == pytest.approx(-2 * (1 / 3) * math.log(1 / 3))
    # first VIEW, last BUY; codes BUY=0, VIEW=1, 'nan'=2 (the missing type is its own category)
    assert r["last_event_type_code"] == 0 and r["first_event_type_code"] == 1


def test_null_session_key_dropped(events):
    df = events([{"user_session": None}, {"user_session": "s2"}])
    assert set(v2(df)) == {"s2"}


def test_null_time_sorted_last(events):
    df = events([{"t": 2, "event_type": "VIEW"}, {"t": None, "event_type": "BUY"},
                 {"t": 1, "event_type": "CART"}])
    r = v2(df)["s1"]
    assert r["session_duration_seconds"] == pytest.approx(1.0)
    assert r["events_per_minute"] == pytest.approx(180.0)
    codes = ["BUY", "CART", "VIEW"]
    assert r["first_event_type_code"] == codes.index("CART")
    assert r["last_event_type_code"] == codes.index("BUY")


def test_all_times_null(events):
    r = v2(events([{"t": None}, {"t": None}]))["s1"]
    assert r["session_duration_seconds"] == 0.0
    assert r["events_per_minute"] == pytest.approx(2 / 60)


def test_time_ties_keep_input_order(events):
    df = events([{"t": 5, "event_type": "BUY", "row_no": 1}, {"t": 5, "event_type": "VIEW", "row_no": 2}])
    r = v2(df)["s1"]
    assert r["first_event_type_code"] == 0 and r["last_event_type_code"] == 1


def test_zero_duration_and_rate(events):
    assert v2(events([{"t": 0}]))["s1"]["events_per_minute"] == pytest.approx(1 / 60)
    r = v2(events([{"t": 0}, {"t": 40}, {"t": 80}, {"t": 120}]))["s1"]
    assert r["session_duration_seconds"] == pytest.approx(120.0)
    assert r["events_per_minute"] == pytest.approx(2.0)


def test_no_view_and_no_buy(events):
    r = v2(events([{"event_type": "BUY"}] * 3))["s1"]
    assert r["buy_to_view_ratio"] == pytest.approx(3.0)
    r = v2(events([{"event_type": "VIEW"}, {"event_type": "CART"}]))["s1"]
    assert r["is_buyer"] == 0 and r["buy_to_view_ratio"] == 0.0 and r["buy_to_cart_ratio"] == 0.0
    assert r["cart_to_view_ratio"] == pytest.approx(1.0)


def test_all_products_null(events):
    r = v2(events([{"product_id": None}, {"product_id": None}]))["s1"]
    assert r["unique_product_count"] == 0 and r["product_repeat_max"] == 0
    assert r["revisit_ratio"] == 1.0


def test_repeats_and_uniques(events):
    df = events([{"product_id": 1, "category_id": 1}, {"product_id": 1, "category_id": 2},
                 {"product_id": 2, "category_id": 2}, {"product_id": None, "category_id": 2}])
    r = v2(df)["s1"]
    assert (r["unique_product_count"], r["product_repeat_max"]) == (2, 2)
    assert (r["unique_category_count"], r["category_repeat_max"]) == (2, 3)
    assert r["revisit_ratio"] == pytest.approx(1 - 2 / 4)


def test_session_with_two_users_takes_first(events):
    df = events([{"user_id": 2, "t": 5}, {"user_id": 1, "t": 1}])
    assert v2(df)["s1"]["user_id"] == 1                     # time order
    v1 = rows_by(feat.session_features_v1(df), "user_session")
    assert v1["s1"]["user_id"] == 2                         # input order


def test_first_user_skips_nulls(events):
    df = events([{"user_id": None, "t": 0}, {"user_id": 7, "t": 1}])
    assert v2(df)["s1"]["user_id"] == 7


def test_session_in_both_splits(events):
    df = events([{"split": "train"}, {"split": "test"}])
    tr, te = feat.split_features(feat.session_features_v2(df, with_split_flags=True))
    assert tr.count() == 1 and te.count() == 1
    assert tr.first()["session_event_count"] == 2


def test_counts_and_entropy_invariants(spark):
    from clickroll.sources.adapters import clickstream_source
    ev = clickstream_source(spark, "/root/testdata/sf0.001").events
    types, _ = feat.event_type_domain(ev)
    f = feat.session_features_v2(ev)
    cnt = sum(F.col(f"event_type_count_{t}") for t in types)
    bad = f.where((cnt != F.col("session_event_count")) | (F.col("event_type_entropy") < 0)
                  | (F.col("event_type_entropy") > math.log(len(types)) + 1e-12))
    assert bad.count() == 0


def test_features_do_not_depend_on_target(events):
    a = events([{"session_value": 1.0}, {"session_value": 1.0, "event_type": "BUY"}])
    b = events([{"session_value": 99.0}, {"session_value": 99.0, "event_type": "BUY"}])
    assert v2(a) == v2(b)


def test_event_type_codes_lexical(events):
    df = events([{"event_type": "VIEW"}, {"event_type": "BUY"}, {"event_type": None}])
    codes = {r["event_type"]: r["code"] for r in feat.event_type_codes(df).collect()}
    assert codes == {"BUY": 0, "VIEW": 1, "nan": 2}
