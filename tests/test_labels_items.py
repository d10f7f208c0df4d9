from clickroll.operators import items, labels

from conftest import rows_by


def test_last_product_null_variants(events):
    df = events([{"product_id": 7, "t": 0}, {"product_id": None, "t": 1}])
    assert rows_by(items.last_items_nonnull(df), "user_session")["s1"]["last_product_id"] == 7
    assert rows_by(items.last_items_row(df), "user_session")["s1"]["last_product_id"] == -1
    assert rows_by(items.last_items_row(df, sentinel=False), "user_session")["s1"]["last_product_id"] is None


def test_last_row_null_time_is_last(events):
    df = events([{"product_id": 1, "t": None}, {"product_id": 2, "t": 5}])
    assert rows_by(items.last_items_row(df), "user_session")["s1"]["last_product_id"] == 1


def test_label_null_on_first_row(events):
    df = events([{"session_value": None, "row_no": 0}, {"session_value": 5.0, "row_no": 1}])
    assert rows_by(labels.labels_first_per_session(df), "user_session")["s1"]["session_value"] == 5.0
    b = labels.labels_first_per_user_session(df).collect()
    assert len(b) == 1 and b[0]["session_value"] is None


def test_conflicting_labels_keep_first(events):
    df = events([{"session_value": 5.0, "row_no": 3}, {"session_value": 6.0, "row_no": 4}])
    assert rows_by(labels.labels_first_per_session(df), "user_session")["s1"]["session_value"] == 5.0


def test_session_with_two_users(events):
    df = events([{"user_id": 1, "session_value": 3.0}, {"user_id": 2, "session_value": 4.0}])
    a = labels.labels_first_per_session(df).collect()
    assert len(a) == 1 and a[0]["user_id"] == 1
    assert labels.labels_first_per_user_session(df).count() == 2


def test_null_user_kept_as_key_in_variant_b(events):
    df = events([{"user_id": None, "session_value": 2.0}, {"user_id": None, "session_value": 3.0}])
    assert labels.labels_first_per_session(df).count() == 0
    b = labels.labels_first_per_user_session(df).collect()
    assert len(b) == 1 and b[0]["user_id"] is None and b[0]["session_value"] == 2.0
