"""The reference's CSV layout end to end: written from the driver's events, read back
through ``csv_source``, features equal the parquet path's."""

import tempfile

import pytest
from pyspark.sql import functions as F

from clickroll.operators import features as feat
from clickroll.operators import labels
from clickroll.plans import jobs
from clickroll.sources.adapters import clickstream_source, csv_source

SF = "/root/testdata/sf0.001"


def _write_csv(df, path):
    # one ordered file, as the reference's files are
    (df.coalesce(1).write.mode("overwrite").option("header", True)
       .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path))


def test_csv_layout_matches_parquet_path(spark):
    src = clickstream_source(spark, SF)
    d = tempfile.mkdtemp(prefix="clickroll-csv-")
    cols = ["event_type", "product_id", "category_id", "user_id", "user_session", "event_time"]
    _write_csv(src.labeled.orderBy("row_no").select(*cols, "session_value"), f"{d}/train.csv")
    _write_csv(src.test.orderBy("row_no").select(*cols), f"{d}/test.csv")
    _write_csv(src.template.orderBy("row_no").select("user_session", "session_value"), f"{d}/sample_submission.csv")
    csv = csv_source(spark, f"{d}/train.csv", f"{d}/test.csv", f"{d}/sample_submission.csv", id_type="long")
    a = {r["user_session"]: r.asDict() for r in feat.session_features_v2(src.events).collect()}
    b = {r["user_session"]: r.asDict() for r in feat.session_features_v2(csv.events).collect()}
    assert a == b
    la = {r["user_session"]: r["session_value"] for r in labels.labels_first_per_session(src.labeled).collect()}
    lb = {r["user_session"]: r["session_value"] for r in labels.labels_first_per_session(csv.labeled).collect()}
    assert la == lb
    # template order survives: the baseline submission lists sessions in template order
    out = f"{d}/sub"
    jobs.run_baseline(csv, out)
    import pandas as pd
    written = pd.read_csv(f"{out}/baseline_mean.csv", dtype=str).user_session.tolist()
    expected = [r["user_session"] for r in src.template.orderBy("row_no").collect()]
    assert written == expected


def test_csv_missing_columns(spark):
    d = tempfile.mkdtemp(prefix="clickroll-csv-")
    spark.range(2).withColumn("user_session", F.lit("s")).write.option("header", True).csv(f"{d}/t.csv")
    import pytest
    with pytest.raises(ValueError, match="missing columns"):
        csv_source(spark, f"{d}/t.csv", f"{d}/t.csv", f"{d}/t.csv").events


def test_cli_features_and_baseline(spark, capsys):
    import glob
    import shutil

    from clickroll import cli
    src = clickstream_source(spark, SF)
    d = tempfile.mkdtemp(prefix="clickroll-cli-")
    cols = ["event_type", "product_id", "category_id", "user_id", "user_session", "event_time"]
    raw = f"{d}/raw"
    import os
    os.makedirs(raw)
    for name, df in [("train.csv", src.labeled.orderBy("row_no").select(*cols, "session_value")),
                     ("test.csv", src.test.orderBy("row_no").select(*cols)),
                     ("sample_submission.csv", src.template.orderBy("row_no").select("user_session", "session_value"))]:
        _write_csv(df, f"{d}/tmp_{name}")
        shutil.copyfile(glob.glob(f"{d}/tmp_{name}/part-*.csv")[0], f"{raw}/{name}")
    cli.main(["features", "--raw", raw, "--out", f"{d}/processed", "--version", "v1"])
    assert "session_features_v1" in capsys.readouterr().out
    assert spark.read.parquet(f"{d}/processed/session_features_v1").where("split = 'test'").count() == \
        src.template.count()
    cli.main(["baseline", "--raw", raw, "--out", f"{d}/sub"])
    assert os.path.isfile(f"{d}/sub/baseline_mean.csv")
    cli.main(["fulltrain", "--raw", raw, "--out", f"{d}/sub", "--trees", "2", "--leaves", "4", "--l2", "1.2", "--l1", "0.1", "--patience", "1"])
    with open(f"{d}/sub/final_fulltrain_gbt.csv") as f:
        assert len(f.readlines()) == 1 + src.template.count()


def test_profile_report_rows(spark):
    src = clickstream_source(spark, SF)
    rep = {r["name"]: r["value"] for r in jobs.profile_report(src).collect()}
    lab = labels.labels_first_per_session(src.labeled)
    assert rep["n_sessions"] == lab.count()
    assert rep["q000"] <= rep["q050"] <= rep["q0995"] <= rep["q100"] == rep["max"]
    assert set(rep) >= {"mean", "std", "n_users", "n_above_p99", "n_above_p995", "users_heavy_mu_gt_p95"}


def test_files_without_time_give_no_time_features(spark, tmp_path):
    src = clickstream_source(spark, SF)
    cols = ["event_type", "product_id", "category_id", "user_id", "user_session"]
    _write_csv(src.labeled.orderBy("row_no").select(*cols, "session_value"), f"{tmp_path}/train.csv")
    _write_csv(src.test.orderBy("row_no").select(*cols), f"{tmp_path}/test.csv")
    _write_csv(src.template.orderBy("row_no").select("user_session", "session_value"), f"{tmp_path}/template.csv")
    csv = csv_source(spark, f"{tmp_path}/train.csv", f"{tmp_path}/test.csv", f"{tmp_path}/template.csv", id_type="long")
    assert csv.time_col is None and csv.row_time_col is None
    jobs.build_features(csv, f"{tmp_path}/out", "v2")
    _, train, _ = jobs.read_features(spark, f"{tmp_path}/out")
    assert "session_event_count" in train.columns
    assert not {"session_duration_seconds", "events_per_minute"} & set(train.columns)


def test_blend_needs_its_columns(spark, tmp_path):
    frame = spark.createDataFrame([("s", 1.0)], "user_session string, session_value double")
    _write_csv(frame, f"{tmp_path}/a.csv")
    _write_csv(frame.withColumnRenamed("session_value", "other"), f"{tmp_path}/b.csv")
    with pytest.raises(ValueError, match="session_value"):
        jobs.blend_files(spark, f"{tmp_path}/a.csv", f"{tmp_path}/b.csv", f"{tmp_path}/out.csv")


def test_ids_take_the_type_of_both_files(spark, tmp_path):
    head = "event_type,product_id,category_id,user_id,user_session"
    (tmp_path / "train.csv").write_text(f"{head},session_value\nVIEW,007,a1,5,s1,2.5\nBUY,,3,,s2,\n")
    (tmp_path / "test.csv").write_text(f"{head}\nVIEW,8,4,6,s3\n")
    (tmp_path / "t.csv").write_text("user_session,session_value\ns3,0\n")
    src = csv_source(spark, *[str(tmp_path / f"{x}.csv") for x in ("train", "test", "t")])
    assert {k: t for k, t in src.events.dtypes if k.endswith("_id")} == {"user_id": "bigint", "product_id": "bigint", "category_id": "string"}
    got = sorted((r.user_session, r.product_id, r.category_id, r.user_id, r.row_no) for r in src.events.collect())
    assert got == [("s1", 7, "a1", 5, 0), ("s2", None, "3", None, 1), ("s3", 8, "4", 6, 0)]
