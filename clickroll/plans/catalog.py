"""The query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables through an adapter and runs over all rows.
Report columns: doubles are rounded to 6 decimals so results compare exactly with
the SQL oracle (sums in different orders differ in the last bits).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickroll.operators import boosting, encode, ensemble, folds, hot_join, items, labels, predict, profile, quantiles, target
from clickroll.operators import features as feat
from clickroll.session import materialize, scratch_path
from clickroll.sources import files
from clickroll.sources.adapters import (EventSource, clickstream_contract, clickstream_source, csv_source, lineitem_source,
                                        read_table, test_template)


def report(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), digits).alias(f.name)
        cols.append(c)
    return df.select(*cols)


# ---------------------------------------------------------------- shared pieces

def _src(spark, sf_dir):
    return clickstream_source(spark, sf_dir)


def _edge_source(spark, sf_dir) -> EventSource:
    """All events with what the given table lacks, by event number: missing users, sessions,
    types, ids, times and targets, two users in a session, sessions in both splits, and a
    type that only rows without a session have."""
    n = F.col("row_no")
    base = clickstream_contract(read_table(spark, sf_dir, "events"))
    other = F.when(F.col("split") == "train", F.lit("test")).otherwise(F.lit("train"))
    ev = base.select(
        "row_no",
        F.when(n % 17 == 1, F.lit(None)).when(n % 23 == 6, F.col("user_id") + 1)
        .otherwise(F.col("user_id")).alias("user_id"),
        F.when(n % 97 != 0, F.col("user_session")).alias("user_session"),
        F.when((n % 97 == 0) & (n % 2 == 0), F.lit("PROMO")).when(n % 11 != 3, F.col("event_type")).alias("event_type"),
        F.when(n % 7 != 2, F.col("product_id")).alias("product_id"),
        F.when(n % 19 != 4, F.col("category_id")).alias("category_id"),
        F.when(n % 13 != 5, F.col("event_time")).alias("event_time"),
        F.when(n % 29 != 0, F.col("split")).otherwise(other).alias("split"))
    train, test = ev.where(F.col("split") == "train"), ev.where(F.col("split") == "test")
    return EventSource(events=ev, train=train, test=test, template=test_template(test), name="edge",
                       make_labeled=lambda: train.withColumn("session_value", F.when(n % 5 != 1, (n % 1000) / 100)))


def _shared(src, key, build):
    """A frame several stages of one query read: built once, checkpointed, reused."""
    if key not in src.extras:
        src.extras[key] = materialize(build())
    return src.extras[key]


def _features_split(src, version="v2"):
    fn = feat.session_features_v2 if version == "v2" else feat.session_features_v1
    f_all = _shared(src, f"features_{version}", lambda: fn(src.events, with_split_flags=True))
    return feat.split_features(f_all)


def _test_sessions(src):
    """(user_session, user_id) of the test sessions: all that encodings and blends need,
    so no other feature is computed for them."""
    flagged = feat.session_users(src.events)
    return flagged.where(F.col("_in_test")).select("user_session", "user_id")


def _labels_a(src):
    return _shared(src, "labels_a", lambda: labels.labels_first_per_session(src.label_rows))


def _labels_b(src, shared: bool = True):
    build = lambda: labels.labels_first_per_user_session(src.label_rows)
    return _shared(src, "labels_b", build) if shared else build()


def _money(df, col="session_value"):
    """The raw target is money with two decimals: averaged exactly as DECIMAL(18,2)."""
    return df.withColumn(col, F.col(col).cast("decimal(18,2)"))


def _frame_session_key(src):
    """Labels (variant A) + last non-null items on the session + train features on
    (session, user): the 5-fold trainer's frame."""
    tr_feat, _ = _features_split(src)
    last = items.last_items_nonnull(src.train)
    return (_labels_a(src).join(last, "user_session", "left")
            .join(tr_feat, ["user_session", "user_id"], "left"))


def _frame_user_session_key(src):
    """Labels (variant B) + train features + last row items on (user, session), with
    the -1 sentinel for missing ids: the CV-ensemble and full-train frame."""
    def build():
        tr_feat, _ = _features_split(src)
        return _with_last_row(_labels_b(src, shared=False).join(tr_feat, ["user_id", "user_session"], "left"), src.train)
    return _shared(src, "frame_uk", build)


def _with_last_row(frame, events):
    fr = frame.join(items.last_items_row(events), ["user_id", "user_session"], "left")
    return items.fill_sentinel(fr, ["last_product_id", "last_category_id"])


# ---------------------------------------------------------------- queries

def q_events_union_split(spark, sf_dir):
    src = _src(spark, sf_dir)
    allrows = src.labeled.unionByName(src.test, allowMissingColumns=True)
    return (allrows.where(F.col("user_session").isNotNull())
            .groupBy("split", "user_session")
            .agg(F.count(F.lit(1)).alias("n_events"), F.count("session_value").alias("n_labeled")))


def q_scan_csv_roundtrip(spark, sf_dir):
    src = _src(spark, sf_dir)
    path = scratch_path(spark, "events-csv")
    cols = ["event_id", "user_id", "user_session", "event_type", "product_id", "category_id",
            "event_time", "session_value"]
    files.write_events_csv(src.labeled.withColumnRenamed("row_no", "event_id").select(*cols), path)
    schema = T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
        T.StructField("user_session", T.StringType()), T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.LongType()), T.StructField("category_id", T.LongType()),
        T.StructField("event_time", T.TimestampNTZType()), T.StructField("session_value", T.DoubleType())])
    return report(files.read_events_csv(spark, path, schema).drop("row_no"))


def _csv_files(spark, sf_dir, time_col):
    """The clickstream events as the reference's three CSV files, in input order."""
    src = _src(spark, sf_dir)
    base = scratch_path(spark, "csv-files")
    cols = ["event_type", "product_id", "category_id", "user_id", "user_session", time_col]
    files.write_events_csv(src.labeled.orderBy("row_no").select(*cols, "session_value"), f"{base}/train")
    files.write_events_csv(src.test.orderBy("row_no").select(*cols), f"{base}/test")
    files.write_predictions_csv(src.template, f"{base}/template")
    return csv_source(spark, f"{base}/train", f"{base}/test", f"{base}/template", id_type="long")


def q_last_items_row_text_time(spark, sf_dir):
    """Last whole row of the CSV files by the text of a day-first time column, as the
    trainers order: '31/...' comes after '01/...' of a later month."""
    text = F.date_format("event_time", "dd/MM/yyyy HH:mm:ss.SSSSSS").alias("event_time")
    src = _csv_files(spark, sf_dir, text)
    return items.last_items_row(src.train, src.row_time_col)


def q_scan_csv_dirty(spark, sf_dir):
    """Cells with quotes, commas, blanks and missing-value tokens, written and read back."""
    n = F.col("event_id") % 8
    cell = F.array(*[F.lit(v) for v in DIRTY_CELLS])[n.cast("int")]
    raw = read_table(spark, sf_dir, "events").select(
        "event_id", F.concat(cell, F.when(n < 3, F.col("event_type")).otherwise(F.lit(""))).alias("cell"))
    path = scratch_path(spark, "dirty-csv")
    files.write_events_csv(raw, path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("cell", T.StringType())])
    return files.read_events_csv(spark, path, schema).drop("row_no")


#: the first three go before the event type, the others stand alone
DIRTY_CELLS = ('a "quoted" ', "x,y ", " ", "n/a", " NA ", "<NA>", "1.#IND", '"')


def _multiline_rows(spark, sf_dir):
    n = F.col("event_id") % 8
    cell = F.element_at(F.array(*[F.lit(v) for v in MULTILINE_CELLS]), n.cast("int") + 1)
    return read_table(spark, sf_dir, "events").select(
        "event_id", F.concat(cell, F.col("event_type")).alias("cell"), F.when(n != 5, F.col("user_id")).alias("maybe_id"))


#: each goes before the event type
MULTILINE_CELLS = ("two\nlines ", "crlf\r\nin it ", 'says "\n" ', ",\n,", "\n\n", "plain ", '""', "\r")


def q_scan_csv_multiline(spark, sf_dir):
    """One file with line breaks, quotes and commas in cells, read back with its positions and
    inferred types (integers with a missing cell are doubles)."""
    path = f"{scratch_path(spark, 'multiline')}/events.csv"
    files.write_prediction_file(_multiline_rows(spark, sf_dir), path, "event_id", ("event_id", "cell", "maybe_id"))
    return files.read_csv_inferred(spark, path)


def q_csv_inferred_types(spark, sf_dir):
    """The types that the columns of a written file get."""
    n = F.col("event_id")
    cols = {"whole": n, "leading_zeros": F.lpad(n.cast("string"), 9, "0"), "missing_some": F.when(n % 3 > 0, n), "mixed": F.when(n % 50 == 0, F.lit("x7")).otherwise(n.cast("string")),
            "fraction": n / 4, "exponent": F.concat(n.cast("string"), F.lit("e-3")), "truth": F.when(n % 2 == 0, F.lit("True")).otherwise(F.lit("False")),
            "truth_missing": F.when(n % 3 == 0, F.lit("true")).when(n % 3 == 1, F.lit("false")), "nothing": F.lit(None).cast("string"),
            "unsigned": F.concat(F.lit("1800000000000000"), F.lpad((n % 10000).cast("string"), 4, "0")), "huge": F.concat(F.lit("9" * 25), (n % 10).cast("string")),
            "time": F.col("ts").cast("string"), "text": F.col("event_type"), "infinite": F.when(n % 9 == 0, F.lit("-inf")).otherwise(n.cast("string"))}
    path = f"{scratch_path(spark, 'types')}/events.csv"
    rows = read_table(spark, sf_dir, "events").select("event_id", *[c.alias(k) for k, c in cols.items()])
    files.write_prediction_file(rows, path, "event_id", tuple(cols))
    got = files.read_csv_inferred(spark, path).drop("row_no").dtypes
    return spark.createDataFrame(got, "name string, type string")


def q_csv_bad_times(spark, sf_dir):
    """A time column of the longer name list with values that are no time: parsed where possible."""
    base = scratch_path(spark, "bad-times")
    src = _src(spark, sf_dir)
    text = F.when(F.col("row_no") % 7 == 0, F.lit("no time")).when(F.col("row_no") % 7 == 1, F.lit("2024-13-45 00:00:00"))
    for name, rows in (("train", src.labeled), ("test", src.test)):
        rows = rows.withColumn("event_timestamp", text.otherwise(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")))
        files.write_prediction_file(rows, f"{base}/{name}.csv", "row_no", (
            "event_type", "product_id", "category_id", "user_id", "user_session", "event_timestamp", *(["session_value"] if name == "train" else [])))
    files.write_prediction_file(src.template, f"{base}/template.csv")
    return csv_source(spark, f"{base}/train.csv", f"{base}/test.csv", f"{base}/template.csv").events.select(
        "split", "row_no", "user_id", "user_session", "product_id", "event_time")


def q_prediction_file(spark, sf_dir):
    """Filled template as one file in template order, read back with its positions."""
    src = _src(spark, sf_dir)
    _, te = _user_backoff_raw(src)
    pred = te.select("user_session", F.col("user_backoff").alias("session_value"))
    filled = report(predict.fill_template(src.template, pred, encode.global_mean(_money(_labels_a(src)), "session_value")))
    path = f"{scratch_path(spark, 'predictions')}/out.csv"
    return files.read_predictions_csv(spark, files.write_prediction_file(filled, path))


def q_feature_csv_versions(spark, sf_dir):
    """v1 features as CSV files, one a split, found by the versioned reader as no v2 is there."""
    base = scratch_path(spark, "feature-csv")
    rows = materialize(report(feat.tag_splits(feat.session_features_v1(_src(spark, sf_dir).events, with_split_flags=True))))
    cols = tuple(c for c in rows.columns if c != "split")
    for split in ("train", "test"):
        files.write_prediction_file(rows.where(F.col("split") == split), f"{base}/session_features_v1_{split}.csv", "user_session", cols)
    _, tr, te = files.read_features_versioned(spark, base)
    return tr.withColumn("split", F.lit("train")).unionByName(te.withColumn("split", F.lit("test")))


def q_feature_parquet_roundtrip(spark, sf_dir):
    src = _src(spark, sf_dir)
    path = scratch_path(spark, "features-v1")
    files.write_feature_table(feat.tag_splits(feat.session_features_v1(src.events, with_split_flags=True)),
                              path, partition_by="split")
    return report(spark.read.parquet(path))


def q_session_features_v1(spark, sf_dir):
    return report(feat.session_features_v1(_src(spark, sf_dir).events))


def q_session_features_v2(spark, sf_dir):
    return report(feat.session_features_v2(_src(spark, sf_dir).events))


def q_labels_first_per_user_session_orders(spark, sf_dir):
    """Label variant B on order lines: first line (struct input position) per (customer, order)."""
    return report(labels.labels_first_per_user_session(lineitem_source(spark, sf_dir).labeled))


def q_last_items_row_orders(spark, sf_dir):
    """Last whole line per (customer, order) in ship-date order, ties by line position."""
    return items.last_items_row(lineitem_source(spark, sf_dir).train)


def q_streaming_session_features_v1(spark, sf_dir):
    """v1 features maintained by the file stream (available-now trigger), read back."""
    from clickroll.streaming import start_session_feature_stream
    src = _src(spark, sf_dir)
    types, _ = feat.event_type_domain(src.events)
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    stream = clickstream_contract(
        spark.readStream.schema(raw.schema).parquet(f"{sf_dir.rstrip('/')}/events*.parquet")).drop("value")
    base = scratch_path(spark, "stream")
    q = start_session_feature_stream(spark, stream, f"{base}/store", f"{base}/features",
                                     f"{base}/checkpoint", types, version="v1")
    q.awaitTermination()
    return report(spark.read.parquet(f"{base}/features").drop("_bucket"))


def q_session_features_v2_orders(spark, sf_dir):
    """Order lines as events; the order's customer is attached per session after the
    aggregation (see ``session_features_v2(session_attrs=...)``)."""
    src = lineitem_source(spark, sf_dir)
    return report(feat.session_features_v2(src.extras["line_events"],
                                           session_attrs=src.extras["session_attrs"]))


def q_event_type_codes(spark, sf_dir):
    return feat.event_type_codes(_src(spark, sf_dir).events)


def q_session_repeats(spark, sf_dir):
    ev = _src(spark, sf_dir).events.where(F.col("user_session").isNotNull())
    return feat.session_id_profiles(ev)


def q_session_first_last(spark, sf_dir):
    f = feat.session_features_v2(_src(spark, sf_dir).events)
    return f.select("user_session", "first_event_type_code", "last_event_type_code")


def q_session_time(spark, sf_dir):
    f = feat.session_features_v2(_src(spark, sf_dir).events)
    return report(f.select("user_session", "session_duration_seconds", "events_per_minute"))


def q_event_entropy(spark, sf_dir):
    f = feat.session_features_v2(_src(spark, sf_dir).events)
    return report(f.select("user_session", "event_type_entropy"))


def q_features_train(spark, sf_dir):
    return report(_features_split(_src(spark, sf_dir))[0])


def q_features_test(spark, sf_dir):
    return report(_features_split(_src(spark, sf_dir))[1])


def q_labels_first_per_session(spark, sf_dir):
    return report(_labels_a(_src(spark, sf_dir)))


def q_labels_first_per_user_session(spark, sf_dir):
    return report(_labels_b(_src(spark, sf_dir)))


def q_last_items_nonnull(spark, sf_dir):
    return items.last_items_nonnull(_src(spark, sf_dir).train)


def q_last_items_row(spark, sf_dir):
    return items.last_items_row(_src(spark, sf_dir).train)


def q_training_frame_session_key(spark, sf_dir):
    return report(_frame_session_key(_src(spark, sf_dir)))


def q_training_frame_user_session_key(spark, sf_dir):
    return report(_frame_user_session_key(_src(spark, sf_dir)))


def q_target_log_clip(spark, sf_dir):
    lab = _labels_a(_src(spark, sf_dir))
    return report(target.log_target(lab, "session_value", "y", clip_negative=True)
                  .select("user_session", "y"))


def q_target_log(spark, sf_dir):
    lab = _labels_b(_src(spark, sf_dir))
    return report(target.log_target(lab, "session_value", "y", clip_negative=False)
                  .select("user_id", "user_session", "y"))


def q_target_inverse(spark, sf_dir):
    lab = target.log_target(_labels_a(_src(spark, sf_dir)), "session_value", "y")
    return report(target.inverse_target(lab, "y", "session_value_back")
                  .select("user_session", "y", "session_value_back"))


def q_winsorize_upper(spark, sf_dir):
    lab = _labels_a(_src(spark, sf_dir))
    return report(target.winsorize_upper(lab, "session_value", 0.995, out="session_value_w")
                  .select("user_session", "session_value_w"))


def q_winsorize_two_sided(spark, sf_dir):
    lab = _labels_b(_src(spark, sf_dir))
    return report(target.winsorize_two_sided(lab, "session_value", 0.995, out="session_value_w")
                  .select("user_id", "user_session", "session_value_w"))


def q_tail_stats(spark, sf_dir):
    return report(profile.tail_stats(_labels_a(_src(spark, sf_dir))))


def q_tail_counts(spark, sf_dir):
    return report(profile.tail_counts(_labels_a(_src(spark, sf_dir))))


def q_user_quantiles(spark, sf_dir):
    """Quartiles and 95 % quantile of the session values of every user."""
    got = quantiles.quantiles_by(_labels_a(_src(spark, sf_dir)), "session_value", (0.25, 0.5, 0.75, 0.95), ["user_id"])
    return report(got.select("user_id", F.col("n").alias("n_sessions"), *[F.col("q")[i].alias(f"q{p}") for i, p in enumerate(("25", "50", "75", "95"))]))


def q_hot_key_join(spark, sf_dir):
    """Every event with its product's mean value; a third of all events have one product, some none."""
    raw = read_table(spark, sf_dir, "events")
    n = F.col("event_id")
    key = F.when(n % 3 == 0, F.lit(1)).when(n % 20 != 1, F.get_json_object("props", "$.k").cast("bigint")).cast("bigint")
    rows = raw.select("event_id", key.alias("product"), F.col("value").cast("decimal(18,2)").alias("value"))
    means = materialize(rows.where("product IS NOT NULL").groupBy("product").agg(F.avg("value").cast("double").alias("product_mean")))
    return report(hot_join.spread_join(rows.select("event_id", "product"), means, ["product"], ["event_id"]))


def q_heavy_users(spark, sf_dir):
    return profile.heavy_users(_labels_a(_src(spark, sf_dir)))


def q_session_user_counts(spark, sf_dir):
    return profile.session_user_counts(_labels_a(_src(spark, sf_dir)))


def q_group_folds(spark, sf_dir):
    return folds.group_folds(_labels_a(_src(spark, sf_dir)), "user_id", 5, 42) \
        .select("user_session", "user_id", "fold")


def q_balanced_group_folds(spark, sf_dir):
    out = folds.balanced_group_folds(_labels_b(_src(spark, sf_dir)), "user_id", 10)
    load = out.groupBy("fold").agg(F.count(F.lit(1)).alias("fold_rows"))
    return out.join(F.broadcast(load), "fold").select("user_id", "user_session", "fold", "fold_rows")   # 10 lines


def q_group_holdout(spark, sf_dir):
    return folds.group_holdout(_labels_b(_src(spark, sf_dir)), "user_id", 0.1, 2025) \
        .select("user_id", "user_session", "is_holdout")


def q_baseline_cv(spark, sf_dir):
    f = materialize(folds.group_folds(_money(_labels_a(_src(spark, sf_dir))), "user_id", 5, 42))
    return report(folds.baseline_cv(f))


def q_baseline_report(spark, sf_dir):
    from clickroll.plans import jobs
    rep, _ = jobs.baseline_metrics(_labels_a(_src(spark, sf_dir)), 5, 42)
    return report(rep)


def q_baseline_submission(spark, sf_dir):
    src = _src(spark, sf_dir)
    mean = encode.global_mean(_money(_labels_a(src)), "session_value")
    return report(predict.constant_prediction(src.template, mean))


def _user_backoff_raw(src):
    lab = _money(_labels_a(src))
    te = _test_sessions(src)
    spec = [encode.EncodingSpec("user_id", "user_backoff", "session_value")]
    tr, te = encode.full_train_encodings(lab, te, spec, "session_value")
    return tr.withColumn("session_value", F.col("session_value").cast("double")), te


def q_user_backoff_raw(spark, sf_dir):
    tr, te = _user_backoff_raw(_src(spark, sf_dir))
    out = (tr.select("user_session", F.lit("train").alias("role"), "user_backoff")
           .unionByName(te.select("user_session", F.lit("test").alias("role"), "user_backoff")))
    return report(out)


def q_user_backoff_log(spark, sf_dir):
    src = _src(spark, sf_dir)
    lab = target.log_target(_labels_b(src), "session_value", "y", clip_negative=False)
    te = _test_sessions(src)
    enc = encode.mean_by_key(lab, "user_id", "y", "default")
    tr = encode.apply_encoding(lab, enc, "user_id", "user_backoff_y", None)
    te = encode.apply_encoding(te, enc, "user_id", "user_backoff_y", encode.global_mean(lab, "y"))
    out = (tr.select("user_id", "user_session", F.lit("train").alias("role"), "user_backoff_y")
           .unionByName(te.select("user_id", "user_session", F.lit("test").alias("role"), "user_backoff_y")))
    return report(out)


def _item_encoding_raw(src):
    fr = _money(_labels_a(src)).join(items.last_items_nonnull(src.train), "user_session", "left")
    te = _test_sessions(src).join(items.last_items_nonnull(src.test), "user_session", "left")
    specs = [encode.EncodingSpec("last_product_id", "te_prod", "session_value"),
             encode.EncodingSpec("last_category_id", "te_cat", "session_value")]
    return encode.full_train_encodings(fr, te, specs, "session_value")


def q_item_encoding_raw(spark, sf_dir):
    tr, te = _item_encoding_raw(_src(spark, sf_dir))
    cols = ["user_session", "te_prod", "te_cat"]
    return report(tr.select(*cols, F.lit("train").alias("role"))
                  .unionByName(te.select(*cols, F.lit("test").alias("role"))))


def _log_frames(src, winsorize_p: float = 0.0):
    fr = _shared(src, "frame_uk_items", lambda: _with_last_row(_labels_b(src, shared=False), src.train))
    fr = target.winsorize_two_sided(fr, "session_value", winsorize_p, out="y_w")
    fr = target.log_target(fr, "y_w", "y", clip_negative=False).drop("y_w")
    return fr, _with_last_row(_test_sessions(src), src.test)


def q_item_encoding_log(spark, sf_dir):
    fr, te = _log_frames(_src(spark, sf_dir))
    specs = [encode.EncodingSpec("last_product_id", "te_last_prod_y", "y", "sentinel"),
             encode.EncodingSpec("last_category_id", "te_last_cat_y", "y", "sentinel")]
    tr, te = encode.full_train_encodings(fr, te, specs, "y")
    cols = ["user_id", "user_session", "te_last_prod_y", "te_last_cat_y"]
    return report(tr.select(*cols, F.lit("train").alias("role"))
                  .unionByName(te.select(*cols, F.lit("test").alias("role"))))


LOG_SPECS = [encode.EncodingSpec("user_id", "user_backoff_y", "y", "default"),
             encode.EncodingSpec("last_product_id", "te_last_prod_y", "y", "sentinel"),
             encode.EncodingSpec("last_category_id", "te_last_cat_y", "y", "sentinel")]


def q_fold_encodings(spark, sf_dir):
    fr, te = _log_frames(_src(spark, sf_dir))
    fr = materialize(folds.group_folds(fr, "user_id", 5, 42))
    out = encode.fold_encodings(fr, te, LOG_SPECS, 5, "y", "fold", keep=("user_id", "user_session"))
    return report(out)


def q_fill_template(spark, sf_dir):
    src = _src(spark, sf_dir)
    _, te = _user_backoff_raw(src)
    pred = te.select("user_session", F.col("user_backoff").alias("session_value"))
    mean = encode.global_mean(_money(_labels_a(src)), "session_value")
    return report(predict.fill_template(src.template, pred, mean))


def q_blend_two(spark, sf_dir):
    src = _src(spark, sf_dir)
    _, te_user = _user_backoff_raw(src)
    _, te_item = _item_encoding_raw(src)
    a = te_user.select("user_session", F.col("user_backoff").alias("session_value"))
    b = te_item.select("user_session", F.col("te_prod").alias("session_value"))
    return report(predict.blend([a, b], [0.5, 0.5]))


# Booster seeds of the reference's CV ensemble.
ENSEMBLE_SEEDS = (2025, 2027, 2031)


def _standin_scores(src, seeds, roles, k: int = 5) -> DataFrame:
    """Deterministic stand-in model: a row's score for fold f is its last product's
    fold-f encoding. Lets the OOF / test averaging be checked against SQL."""
    fr, te = _log_frames(src)
    f = materialize(folds.group_folds_by_seed(fr, "user_id", k, seeds))
    enc = encode.fold_encodings(f, te, LOG_SPECS, k, "y", {s: f"fold_{s}" for s in seeds},
                                keep=("user_id", "user_session"), roles=roles)
    return enc.select("user_id", "user_session", "seed", "fold", "role", "y",
                      F.col("te_last_prod_y").alias("pred"))


def q_oof_scores(spark, sf_dir):
    sc = _standin_scores(_src(spark, sf_dir), ENSEMBLE_SEEDS, ("val",))
    return report(ensemble.oof_average(sc, keys=("user_id", "user_session")))


def q_test_avg_log(spark, sf_dir):
    sc = _standin_scores(_src(spark, sf_dir), ENSEMBLE_SEEDS, ("test",))
    return report(ensemble.test_average(sc, keys=("user_id", "user_session"), space="log"))


def q_test_avg_linear(spark, sf_dir):
    sc = _standin_scores(_src(spark, sf_dir), (42,), ("test",))
    return report(ensemble.test_average(sc, keys=("user_id", "user_session"), space="linear"))


def q_fold_scores(spark, sf_dir):
    """MSE and RMSE per seed and fold of the stand-in scores, with the mean over folds."""
    return report(ensemble.fold_scores(_standin_scores(_src(spark, sf_dir), ENSEMBLE_SEEDS, ("val",))))


def q_pooled_score(spark, sf_dir):
    sc = _standin_scores(_src(spark, sf_dir), ENSEMBLE_SEEDS, ("val",))
    return report(ensemble.pooled_score(ensemble.oof_average(sc, keys=("user_id", "user_session"))))


def q_assembled_features(spark, sf_dir):
    """Sum, rows and zeros of every slot of the 5-fold trainer's assembled vectors."""
    from clickroll.plans import modeling
    frame, cols, _ = modeling.base_feature_columns(report(_frame_session_key(_src(spark, sf_dir))))
    vec = modeling.assemble(frame, cols).select(F.posexplode(vector_to_array("features")).alias("slot", "v"))
    per = vec.groupBy("slot").agg(F.sum("v").alias("total"), F.count(F.lit(1)).alias("n_rows"),
                                  F.count_if(F.col("v") == 0).alias("n_zero"))
    name = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("slot") + 1).alias("feature")
    return report(per.select(name, "total", "n_rows", "n_zero"))


def q_edge(spark, sf_dir, of):
    """An operator over the events with missing values (``_edge_source``)."""
    return report(EDGE_QUERIES[of](_edge_source(spark, sf_dir)))


def _train_and_test(frames, cols):
    tr, te = frames
    return (tr.select(*cols, F.lit("train").alias("role"))
            .unionByName(te.select(*cols, F.lit("test").alias("role"))))


EDGE_QUERIES: dict[str, Callable[[EventSource], DataFrame]] = {
    "session_features_v1": lambda s: feat.session_features_v1(s.events),
    "session_features_v2": lambda s: feat.session_features_v2(s.events),
    "event_type_codes": lambda s: feat.event_type_codes(s.events),
    "session_repeats": lambda s: feat.session_id_profiles(s.events.where(F.col("user_session").isNotNull())),
    "labels_first_per_session": _labels_a,
    "labels_first_per_user_session": _labels_b,
    "last_items_nonnull": lambda s: items.last_items_nonnull(s.train),
    "last_items_row": lambda s: items.last_items_row(s.train),
    "features_train": lambda s: _features_split(s)[0],
    "features_test": lambda s: _features_split(s)[1],
    "training_frame_user_session_key": _frame_user_session_key,
    "user_backoff_raw": lambda s: _train_and_test(_user_backoff_raw(s), ["user_session", "user_backoff"]),
    "item_encoding_raw": lambda s: _train_and_test(_item_encoding_raw(s), ["user_session", "te_prod", "te_cat"]),
}


#: rate 1 gives the leaf values themselves
FIRST_TREE = boosting.GBTParams(max_iter=1, step_size=1.0, max_depth=3, max_leaves=6, subsampling_rate=1.0, column_sample=1.0,
                                min_instances_per_node=6, reg_lambda=1.2, reg_alpha=40.0)


def q_gbt_first_tree(spark, sf_dir):
    """Nodes of the first tree of the session-keyed frame on the raw two-decimal target: six leaves
    at most, best first, both penalties. Node 1 is the root, 2i and 2i + 1 the children of i."""
    from clickroll.plans import modeling
    frame, cols, _ = modeling.base_feature_columns(report(_frame_session_key(_src(spark, sf_dir))))
    cols = sorted(cols)
    (model,) = boosting.fit(frame, [boosting.Plan(FIRST_TREE)], cols, label="session_value", find_edges=boosting.exact_edges)
    t, out, todo = model.trees[0], [], [(0, 1)]
    for at, name in todo:      # grows while it is walked
        f = t.feature[at]
        out.append((name, cols[f] if f >= 0 else None, float(model.edges[f][t.bin[at]]) if f >= 0 else None, t.value[at] if f < 0 else None))
        if f >= 0:
            todo += [(t.left[at], 2 * name), (t.left[at] + 1, 2 * name + 1)]
    return report(spark.createDataFrame(out, "node long, feature string, threshold double, value double"))


def _gbt_params(patience=None):
    from clickroll.plans.modeling import GBTParams
    return GBTParams(max_iter=20, max_depth=5, patience=patience)


def q_gbt_fulltrain(spark, sf_dir):
    from clickroll.plans import modeling
    out, _ = modeling.fulltrain(_src(spark, sf_dir), _gbt_params(patience=5), winsorize_p=0.995)
    return report(out)


def q_gbt_fulltrain_session_key(spark, sf_dir):
    """Full-train mode of the 5-fold trainer (fixed rounds, upper winsorize at 0.995)."""
    from clickroll.plans import modeling
    out, _ = modeling.fulltrain_session_key(_src(spark, sf_dir), _gbt_params(), winsorize_p=0.995)
    return report(out)


def q_gbt_group_cv(spark, sf_dir):
    """5-fold protocol: seeded group folds, raw-scale encodings, early stopping on each
    validation fold; out-of-fold scores back on the target scale."""
    from clickroll.plans import modeling
    sc = modeling.cv_scores(_src(spark, sf_dir), k=5, seeds=(42,), params=_gbt_params(patience=5),
                            fold_method="group", fold_seed=42, protocol="session_key")
    oof = ensemble.oof_average(sc, keys=("user_id", "user_session"))
    return report(oof.select("user_id", "user_session", F.expm1("oof").alias("oof"),
                             F.expm1("y").alias("session_value")))


def q_gbt_group_cv_test(spark, sf_dir):
    """5-fold protocol's test scores: mean of the folds' target-scale predictions."""
    from clickroll.plans import modeling
    src = _src(spark, sf_dir)
    sc = modeling.cv_scores(src, k=5, seeds=(42,), params=_gbt_params(patience=5),
                            fold_method="group", fold_seed=42, protocol="session_key")
    pred = ensemble.test_average(sc, keys=("user_session",), space="linear")
    default = encode.global_mean(_money(_labels_a(src)), "session_value")
    return report(predict.fill_template(src.template, pred, default))


def q_gbt_seed_ensemble(spark, sf_dir):
    from clickroll.plans import modeling
    src = _src(spark, sf_dir)
    sc = modeling.cv_scores(src, k=10, seeds=ENSEMBLE_SEEDS, params=_gbt_params(), fold_method="balanced")
    pred = ensemble.test_average(sc, keys=("user_session",), space="log")
    default = encode.global_mean(_labels_b(src), "session_value")
    return report(predict.fill_template(src.template, pred, default))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "events_union_split": q_events_union_split,
    "scan_csv_roundtrip": q_scan_csv_roundtrip,
    "scan_csv_dirty": q_scan_csv_dirty,
    "scan_csv_multiline": q_scan_csv_multiline,
    "csv_inferred_types": q_csv_inferred_types,
    "csv_bad_times": q_csv_bad_times,
    "prediction_file": q_prediction_file,
    "feature_csv_versions": q_feature_csv_versions,
    "last_items_row_text_time": q_last_items_row_text_time,
    "feature_parquet_roundtrip": q_feature_parquet_roundtrip,
    "session_features_v1": q_session_features_v1,
    "session_features_v2": q_session_features_v2,
    "session_features_v2_orders": q_session_features_v2_orders,
    "streaming_session_features_v1": q_streaming_session_features_v1,
    "labels_first_per_user_session_orders": q_labels_first_per_user_session_orders,
    "last_items_row_orders": q_last_items_row_orders,
    "event_type_codes": q_event_type_codes,
    "session_repeats": q_session_repeats,
    "session_first_last": q_session_first_last,
    "session_time": q_session_time,
    "event_entropy": q_event_entropy,
    "features_train": q_features_train,
    "features_test": q_features_test,
    "labels_first_per_session": q_labels_first_per_session,
    "labels_first_per_user_session": q_labels_first_per_user_session,
    "last_items_nonnull": q_last_items_nonnull,
    "last_items_row": q_last_items_row,
    "training_frame_session_key": q_training_frame_session_key,
    "training_frame_user_session_key": q_training_frame_user_session_key,
    "target_log_clip": q_target_log_clip,
    "target_log": q_target_log,
    "target_inverse": q_target_inverse,
    "winsorize_upper": q_winsorize_upper,
    "winsorize_two_sided": q_winsorize_two_sided,
    "tail_stats": q_tail_stats,
    "tail_counts": q_tail_counts,
    "heavy_users": q_heavy_users,
    "hot_key_join": q_hot_key_join,
    "user_quantiles": q_user_quantiles,
    "session_user_counts": q_session_user_counts,
    "group_folds": q_group_folds,
    "balanced_group_folds": q_balanced_group_folds,
    "group_holdout": q_group_holdout,
    "baseline_cv": q_baseline_cv,
    "baseline_report": q_baseline_report,
    "baseline_submission": q_baseline_submission,
    "user_backoff_raw": q_user_backoff_raw,
    "user_backoff_log": q_user_backoff_log,
    "item_encoding_raw": q_item_encoding_raw,
    "item_encoding_log": q_item_encoding_log,
    "fold_encodings": q_fold_encodings,
    "fill_template": q_fill_template,
    "blend_two": q_blend_two,
    "oof_scores": q_oof_scores,
    "test_avg_log": q_test_avg_log,
    "test_avg_linear": q_test_avg_linear,
    "fold_scores": q_fold_scores,
    "pooled_score": q_pooled_score,
    "assembled_features": q_assembled_features,
    **{f"edge_{name}": partial(q_edge, of=name) for name in EDGE_QUERIES},
    "gbt_first_tree": q_gbt_first_tree,
    "gbt_fulltrain": q_gbt_fulltrain,
    "gbt_fulltrain_session_key": q_gbt_fulltrain_session_key,
    "gbt_group_cv": q_gbt_group_cv,
    "gbt_group_cv_test": q_gbt_group_cv_test,
    "gbt_seed_ensemble": q_gbt_seed_ensemble,
}
