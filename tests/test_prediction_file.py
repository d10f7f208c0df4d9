"""One ordered prediction file, byte for byte what a single process writes."""

import os

import pandas as pd
import pytest

from clickroll.sources import files

ROWS = [(3, "s,3", 0.1), (1, 's"1', 1e-7), (2, None, 12345678901234567890.0), (0, "é\nx", None), (4, "", 2.0)]


def test_equals_a_single_process_writer(spark, tmp_path):
    frame = spark.createDataFrame(ROWS, "row_no long, user_session string, session_value double").repartition(4)
    path = files.write_prediction_file(frame, f"{tmp_path}/sub/out.csv")
    want = pd.DataFrame(sorted(ROWS), columns=["row_no", "user_session", "session_value"])[["user_session", "session_value"]]
    want.to_csv(tmp_path / "want.csv", index=False)
    with open(path, "rb") as a, open(tmp_path / "want.csv", "rb") as b:
        assert a.read() == b.read()
    assert os.listdir(tmp_path / "sub") == ["out.csv"]


def test_many_parts_keep_their_order(spark, tmp_path):
    frame = spark.range(20_000).selectExpr("id AS row_no", "concat('s', id) AS user_session", "id / 4 AS session_value").repartition(7)
    path = files.write_prediction_file(frame, f"{tmp_path}/out.csv")
    assert pd.read_csv(path).user_session.tolist() == [f"s{i}" for i in range(20_000)]
    back = files.read_predictions_csv(spark, path)
    assert sorted((r.row_no, r.user_session) for r in back.collect())[:3] == [(0, "s0"), (1, "s1"), (2, "s2")]


def test_a_failed_attempt_leaves_nothing_and_an_old_file_stays(spark, tmp_path, monkeypatch):
    (tmp_path / "out.csv").write_text("old")
    frame = spark.createDataFrame(ROWS, "row_no long, user_session string, session_value double")

    def killed(*a):
        raise KeyboardInterrupt
    monkeypatch.setattr(files.os, "replace", killed)
    with pytest.raises(KeyboardInterrupt):
        files.write_prediction_file(frame, f"{tmp_path}/out.csv")
    assert (tmp_path / "out.csv").read_text() == "old"


def test_no_rows_give_the_header(spark, tmp_path):
    frame = spark.createDataFrame([], "row_no long, user_session string, session_value double")
    with open(files.write_prediction_file(frame, f"{tmp_path}/out.csv")) as f:
        assert f.read() == "user_session,session_value\n"
