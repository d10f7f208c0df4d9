"""Boosted-tree regression on session features (``operators/boosting``).

Three protocols, as in the reference's trainers:

* ``fulltrain``: in-sample encodings, a 10% group hold-out for early stopping, all rows with
  the best number of trees, test scoring and template fill.
* ``group_cv``: K group folds; encodings for all folds come from one aggregation; one
  model per fold; OOF and fold-averaged test scores.
* ``seed_ensemble``: ``group_cv`` over several booster seeds, averaged in log space.

All models of a protocol are fitted together, round by round: one job measures the open
leaves of all of them. The compact frame (one row per session, encodings as per-fold
arrays) is written first, so lost executors start from it rather than from the raw events.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickroll.functions.schema import feature_columns, numeric_only
from clickroll.operators import boosting, encode, folds, items, labels, predict, target
from clickroll.operators import features as feat
from clickroll.operators.boosting import GBTParams, Plan, patience_best
from clickroll.session import materialize

KEY_COLUMNS = ("user_id", "user_session")
NON_FEATURES = ("user_id", "user_session", "session_value", "y", "last_product_id", "last_category_id",
                "fold", "row_fold", "role", "is_holdout", "row_no", "split")
ENCODED = ("user_backoff_y", "te_last_prod_y", "te_last_cat_y")


def assemble(df: DataFrame, cols) -> DataFrame:
    """[M1 P13] Missing feature values -> 0, then one vector column."""
    df = df.na.fill(0.0, subset=list(cols))
    return VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep").transform(df)


def _values(cols):
    """The features as one array, missing ones 0."""
    zero = F.lit(0.0)
    return F.array(*[F.nanvl(F.coalesce(F.col(c).cast("double"), zero), zero) for c in cols])


def _feature_tables(src, features):
    """(train, test) feature tables: given (read back from the feature job's output, the
    reference's file hand-over), or computed from the events."""
    if features is not None:
        return features
    return feat.split_features(materialize(feat.session_features_v2(src.events, time_col=src.time_col, with_split_flags=True)))


def model_frames(src, winsorize_p: float = 0.0, features=None):
    """(train frame, test frame) keyed by (user, session), the -1 id sentinel, ``y`` =
    log1p of the (optionally two-sided winsorized) target. ``features``: optional
    (train, test) feature tables, e.g. from ``jobs.read_features``."""
    tr_feat, te_feat = _feature_tables(src, features)
    lab = labels.require_non_empty(materialize(labels.labels_first_per_user_session(src.label_rows)))
    tr = (lab.join(tr_feat, list(KEY_COLUMNS), "left")
          .join(items.last_items_row(src.train, src.row_time_col, sentinel=False), list(KEY_COLUMNS), "left"))
    te = te_feat.join(items.last_items_row(src.test, src.row_time_col, sentinel=False), list(KEY_COLUMNS), "left")
    tr = items.fill_sentinel(tr, ["last_product_id", "last_category_id"])
    te = items.fill_sentinel(te, ["last_product_id", "last_category_id"])
    tr = materialize(tr)      # read by the quantiles, fold ranking, encodings and the fit
    tr = target.winsorize_two_sided(tr, "session_value", winsorize_p, out="_yw")
    tr = target.log_target(tr, "_yw", "y", clip_negative=False).drop("_yw")
    return tr, te


def session_key_frames(src, features=None):
    """(train frame, test frame) of the 5-fold protocol: labels variant A, last non-null
    items and features joined on the session, ``y = log1p(max(target, 0))``."""
    tr_feat, te_feat = _feature_tables(src, features)
    lab = labels.require_non_empty(materialize(labels.labels_first_per_session(src.label_rows)))
    tr = (lab.join(items.last_items_nonnull(src.train, src.time_col), "user_session", "left")
          .join(tr_feat, list(KEY_COLUMNS), "left"))
    te = te_feat.join(items.last_items_nonnull(src.test, src.time_col), "user_session", "left")
    tr = target.log_target(materialize(tr), "session_value", "y", clip_negative=True)
    return tr, te


RAW_ENCODED = ("user_backoff", "te_prod", "te_cat")


def _raw_encoding_specs():
    return [encode.EncodingSpec("user_id", "user_backoff", "session_value", "default"),
            encode.EncodingSpec("last_product_id", "te_prod", "session_value", "default"),
            encode.EncodingSpec("last_category_id", "te_cat", "session_value", "default")]


def base_feature_columns(frame: DataFrame):
    cols = feature_columns(frame.columns, NON_FEATURES)
    frame, kept, dropped = numeric_only(frame, cols)
    return frame, kept, dropped


def _encoding_specs():
    return [encode.EncodingSpec("user_id", "user_backoff_y", "y", "default"),
            encode.EncodingSpec("last_product_id", "te_last_prod_y", "y", "sentinel"),
            encode.EncodingSpec("last_category_id", "te_last_cat_y", "y", "sentinel")]


def fulltrain_session_key(src, params: GBTParams = GBTParams(), winsorize_p: float = 0.0, features=None):
    """[M3 V7 F10 F12] Full-train mode of the 5-fold trainer: session-keyed frame,
    raw-scale in-sample encodings (missing or unseen keys -> the global mean), fit
    target ``log1p(max(min(y, q_p), 0))`` with the upper-only winsorize, a fixed number
    of rounds, test scores back on the target scale, template fill.
    Returns (template predictions, info dict)."""
    tr, te = session_key_frames(src, features)
    tr = tr.withColumn("session_value", F.col("session_value").cast("double"))
    tr, te = encode.full_train_encodings(tr, te, _raw_encoding_specs(), "session_value")
    tr = target.winsorize_upper(tr, "session_value", winsorize_p, out="_yw")
    tr = target.log_target(tr, "_yw", "y", clip_negative=True).drop("_yw")
    tr, cols, dropped = base_feature_columns(tr)
    (model,) = boosting.fit(tr, [Plan(params)], cols, label="y", key=KEY_COLUMNS)
    pred = te.select("user_session", F.expm1(boosting.scored(_values(cols), model)).alias("session_value"))
    out = predict.fill_template(src.template, pred, encode.global_mean(tr, "session_value"))
    return out, {"n_trees": len(model.trees), "n_features": len(cols), "dropped": dropped}


def fulltrain(src, params: GBTParams = GBTParams(), winsorize_p: float = 0.0,
              holdout: float = 0.1, holdout_seed: int = 2025, features=None):
    """[M3 M5 M6 M7 V3 V7] In-sample encodings (user back-off on the un-winsorized log
    target, items on ``y``), a group hold-out for early stopping, all rows with the
    best number of trees, test scoring and template fill.
    Returns (template predictions [user_session, session_value, row_no], info dict)."""
    tr, te = model_frames(src, winsorize_p, features)
    # user back-off uses the un-winsorized log target; test default is the mean of ``y``
    raw_log = target.log_target(tr.select("user_id", "session_value"), "session_value", "_ylog",
                                clip_negative=False)
    um = encode.mean_by_key(raw_log, "user_id", "_ylog", "default")
    tr = encode.apply_encoding(tr, um, "user_id", "user_backoff_y", None)
    te = encode.apply_encoding(te, um, "user_id", "user_backoff_y", encode.global_mean(tr, "y"))
    item_specs = _encoding_specs()[1:]
    tr, te = encode.full_train_encodings(tr, te, item_specs, "y")
    tr, cols, dropped = base_feature_columns(tr)
    tr = folds.group_holdout(tr, "user_id", holdout, holdout_seed)
    tr = tr.withColumn("_held", F.coalesce(F.col("is_holdout").cast("int"), F.lit(0)))
    # the model of all rows grows beside the one that watches the hold-out, and is cut to the
    # best number of trees: a boosted model's first trees do not depend on later ones
    watched, final = boosting.fit(tr, [Plan(params, not_fold=1, val_fold=1), Plan(params, stops_with=0)],
                                  cols, label="y", fold="_held", key=KEY_COLUMNS)
    best = patience_best(watched.curve, params.patience) + 1
    final = final.truncated(best)
    pred = te.select("user_session", F.expm1(boosting.scored(_values(cols), final)).alias("session_value"))
    default = encode.global_mean(tr, "session_value")
    out = predict.fill_template(src.template, pred, default)
    return out, {"best_iteration": best, "fitted_rounds": watched.fitted, "n_features": len(cols), "dropped": dropped}


def cv_scores(src, k: int = 5, seeds=(2025,), params: GBTParams = GBTParams(),
              fold_method: str = "group", fold_seed: int = 42, winsorize_p: float = 0.0,
              protocol: str = "user_session_key", features=None) -> DataFrame:
    """[M2 M4 M7 V6] Long score frame over seeds x folds:
    (user_id, user_session, seed, fold, role, y, pred), scores on the log scale.

    ``protocol="user_session_key"`` (CV ensemble): labels variant B, last whole row,
    log-scale encodings. ``protocol="session_key"`` (5-fold trainer): labels variant A,
    last non-null items, raw-scale encodings, clipped log target.
    ``fold_method="group"``: seeded group K-fold; ``"balanced"``: size-balanced group
    K-fold (same folds for every seed; seeds vary the booster only).
    """
    if protocol == "session_key":
        tr, te = session_key_frames(src, features)
        specs, encoded, enc_target = _raw_encoding_specs(), RAW_ENCODED, "session_value"
    else:
        tr, te = model_frames(src, winsorize_p, features)
        specs, encoded, enc_target = _encoding_specs(), ENCODED, "y"
    tr, cols, _ = base_feature_columns(tr)
    if fold_method == "balanced":
        tr = folds.balanced_group_folds(tr, "user_id", k)
    else:
        tr = folds.group_folds(tr, "user_id", k, fold_seed)
    keep = (*KEY_COLUMNS, *cols) if enc_target == "y" else (*KEY_COLUMNS, *cols, "y")
    if enc_target != "y":
        te = te.withColumn("y", F.lit(None).cast("double"))
        tr = tr.withColumn(enc_target, F.col(enc_target).cast("double"))
    wide, layout = encode.fold_encodings_wide(tr, te, specs, k, enc_target, "fold", keep=keep)
    wide = materialize(wide)       # read by the fit and by the scoring
    seen = [[F.element_at(F.col(c), layout.index(None, f)) for c in encoded] for f in range(1, k + 1)]
    pairs = [(int(s), f) for s in seeds for f in range(1, k + 1)]
    watch = params.patience is not None     # early stopping on the fold's validation rows
    plans = [Plan(replace(params, seed=s), view=f - 1, not_fold=f, val_fold=f if watch else None) for s, f in pairs]
    models = boosting.fit(wide.where(~F.col("_is_test")), plans, cols, seen, label="y", fold="fold", key=KEY_COLUMNS)
    own = F.array(*[F.array(*[c.cast("double") for c in v]) for v in seen])
    wanted = [F.col("_is_test") | (F.col("fold") == f) for _, f in pairs]
    scores = boosting.scored_by_all(_values(cols), own, F.array(*wanted), models, [p.view for p in plans])
    out = wide.select(*KEY_COLUMNS, "y", "_is_test", F.posexplode(scores).alias("_m", "pred")).where("pred IS NOT NULL")

    def of_pair(i: int):
        return F.element_at(F.array(*[F.lit(p[i]) for p in pairs]), F.col("_m") + 1).cast("bigint")
    role = F.when(F.col("_is_test"), F.lit("test")).otherwise(F.lit("val"))
    out = out.select(*KEY_COLUMNS, of_pair(0).alias("seed"), of_pair(1).alias("fold"), role.alias("role"), "y", "pred")
    return materialize(out)      # every model scores its rows once, however often the scores are read
