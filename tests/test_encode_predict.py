import pytest
from pyspark.sql import functions as F

from clickroll.operators import encode, folds, predict

from conftest import rows_by


def _frame(spark):
    rows = [("a", 1, 10, 1.0), ("b", 1, 10, 3.0), ("c", 2, 20, 5.0), ("d", 3, None, 7.0)]
    return spark.createDataFrame(rows, "user_session string, user_id long, last_product_id long, y double")


def test_unseen_and_null_keys(spark):
    tr = _frame(spark)
    te = spark.createDataFrame([("t1", 9, 99), ("t2", 1, None)],
                               "user_session string, user_id long, last_product_id long")
    specs = [encode.EncodingSpec("user_id", "u", "y"), encode.EncodingSpec("last_product_id", "p", "y")]
    trd, ted = encode.full_train_encodings(tr, te, specs, "y")
    t = rows_by(ted, "user_session")
    assert t["t1"]["u"] == pytest.approx(4.0) and t["t1"]["p"] == pytest.approx(4.0)   # unseen -> mean
    assert t["t2"]["u"] == pytest.approx(2.0) and t["t2"]["p"] == pytest.approx(4.0)   # null -> mean
    assert rows_by(trd, "user_session")["d"]["p"] == pytest.approx(4.0)


def test_sentinel_key_is_a_group(spark):
    tr = _frame(spark).withColumn("last_product_id", F.coalesce("last_product_id", F.lit(-1)))
    enc = encode.mean_by_key(tr, "last_product_id", "y", "sentinel")
    assert rows_by(enc, "last_product_id")[-1]["_mean"] == 7.0


def test_fold_encodings_validation_user_backoff_is_complement_mean(spark):
    rows = [(f"s{u}-{i}", u, u * 10 + i, float(u * 3 + i)) for u in range(12) for i in range(3)]
    tr = spark.createDataFrame(rows, "user_session string, user_id long, last_product_id long, y double")
    tr = folds.group_folds(tr, "user_id", 4, 7)
    te = spark.createDataFrame([("t", 1, 10)], "user_session string, user_id long, last_product_id long")
    specs = [encode.EncodingSpec("user_id", "ub", "y")]
    out = encode.fold_encodings(tr, te, specs, 4, "y", "fold").toPandas()
    pdf = tr.toPandas()
    for f in range(1, 5):
        comp = pdf[pdf.fold != f]
        val = out[(out.fold == f) & (out.role == "val")]
        assert len(val) == (pdf.fold == f).sum()
        assert val.ub.to_numpy() == pytest.approx([comp.y.mean()] * len(val))
        fit = out[(out.fold == f) & (out.role == "fit")].merge(pdf[["user_session", "user_id"]])
        means = comp.groupby("user_id").y.mean()
        assert fit.ub.to_numpy() == pytest.approx(fit.user_id.map(means).to_numpy())
        test = out[(out.fold == f) & (out.role == "test")]
        assert test.ub.iloc[0] == pytest.approx(means.get(1, comp.y.mean()))


def test_template_fill_order_and_default(spark):
    tmpl = spark.createDataFrame([("x", 2), ("y", 0), ("z", 1)], "user_session string, row_no long")
    pred = spark.createDataFrame([("x", 1.0, 0), ("x", 2.0, 1), ("q", 5.0, 2)],
                                 "user_session string, session_value double, row_no long")
    dedup = predict.dedupe_predictions(pred)
    out = predict.fill_template(tmpl, dedup, 9.5).orderBy("row_no").collect()
    assert [r["user_session"] for r in out] == ["y", "z", "x"]
    assert [r["session_value"] for r in out] == [9.5, 9.5, 2.0]


def test_blend_drops_one_sided(spark):
    a = spark.createDataFrame([("s1", 1.0), ("s2", 3.0)], "user_session string, session_value double")
    b = spark.createDataFrame([("s1", 3.0)], "user_session string, session_value double")
    out = predict.blend([a, b]).collect()
    assert len(out) == 1 and out[0]["session_value"] == 2.0
