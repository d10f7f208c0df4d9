"""End-to-end jobs matching the reference's entry points.

* ``build_features``   events -> v1/v2 session features, written once, partitioned by split
* ``run_baseline``     labels -> group folds -> global-mean CV -> constant submission
* ``profile_report``   label distribution summary as a metrics frame
* ``blend_files``      two prediction files -> weighted blend file
* ``run_fulltrain`` / ``run_cv_ensemble``  boosted trees -> submission file

Each returns plain metadata and writes its tables; nothing data-sized is collected.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickroll.operators import encode, ensemble, folds, labels, predict, profile
from clickroll.operators import features as feat
from clickroll.session import materialize
from clickroll.sources import files


def metrics_frame(df: DataFrame, value_cols, fold_col: str | None = None) -> DataFrame:
    """[S8] Long report frame (name, fold, value) from wide metric columns."""
    fold = F.col(fold_col).cast("bigint") if fold_col else F.lit(None).cast("bigint")
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value"))
                      for c in value_cols])
    return df.select(fold.alias("fold"), F.explode(pairs).alias("m")).select("m.name", "fold", "m.value")


def build_features(src, out_dir: str, version: str = "v2") -> dict:
    """[S6 U1] Session features over train+test events, one write partitioned by split; a
    session present in both splits is written to both partitions."""
    if version == "v2":
        rows = feat.session_features_v2(src.events, time_col=src.time_col, with_split_flags=True)
    else:
        rows = feat.session_features_v1(src.events, with_split_flags=True)
    path = f"{out_dir.rstrip('/')}/session_features_{version}"
    files.write_feature_table(feat.tag_splits(rows), path, partition_by="split")
    return {"version": version, "path": path}


def read_features(spark: SparkSession, out_dir: str, versions=("v2", "v1")):
    """(version, train, test): the partitioned table (split pruned at the scan) or
    per-split files, newest version first."""
    from clickroll.sources.files import read_features_versioned
    for v in versions:
        path = f"{out_dir.rstrip('/')}/session_features_{v}"
        try:
            t = spark.read.parquet(path)
        except AnalysisException as e:  # not written in this layout; any other fault is the caller's to see
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        return (v, t.where(F.col("split") == "train").drop("split"),
                t.where(F.col("split") == "test").drop("split"))
    return read_features_versioned(spark, out_dir, versions)


def baseline_metrics(lab: DataFrame, k: int = 5, seed: int = 42):
    """[V4 S8] Global-mean baseline on session labels: (metrics frame, global-mean frame)."""
    cv = folds.baseline_cv(materialize(folds.group_folds(lab, "user_id", k, seed)))
    mean = encode.global_mean(lab, "session_value")
    per_fold = metrics_frame(cv, ["train_mean", "val_mse", "n_tr", "n_va"], "fold")
    overall = metrics_frame(cv.agg(F.max("cv_mean_mse").alias("cv_mean_mse")).withColumn(
        "global_mean", mean.select(mean.columns[0]).scalar()),
                            ["cv_mean_mse", "global_mean"])
    return per_fold.unionByName(overall), mean


def run_baseline(src, out_dir: str, k: int = 5, seed: int = 42) -> DataFrame:
    """[V4 V5 S7 S8] Global-mean baseline: per-fold CV report and a constant submission file.
    Returns the metrics frame (name, fold, value)."""
    lab = materialize(labels.require_non_empty(labels.labels_first_per_session(src.label_rows)))
    report, mean = baseline_metrics(lab, k, seed)
    sub = predict.constant_prediction(src.template, mean)
    files.write_prediction_file(sub, f"{out_dir.rstrip('/')}/baseline_mean.csv")
    return report


def profile_report(src) -> DataFrame:
    """Label profile as (name, fold=NULL, value)."""
    lab = materialize(labels.labels_first_per_session(src.label_rows))
    stats = profile.tail_stats(lab)
    counts = profile.tail_counts(lab)
    heavy = profile.heavy_users(lab)
    ns = profile.session_user_counts(lab)
    wide = ns.select("*", *[f.select(c).scalar().alias(c) for f in (stats, counts, heavy) for c in f.columns])
    return metrics_frame(wide, wide.columns)


def blend_files(spark: SparkSession, path_a: str, path_b: str, out_path: str,
                weights=(0.5, 0.5)) -> str:
    """Blend of two prediction files, in the order of the first."""
    sets = [files.read_predictions_csv(spark, p) for p in (path_a, path_b)]
    files.write_prediction_file(predict.blend(sets, weights, order_col="row_no"), out_path)
    return out_path


def run_fulltrain(src, out_dir: str, params=None, winsorize_p: float = 0.0, features=None) -> dict:
    from clickroll.plans import modeling
    out, info = modeling.fulltrain(src, params or modeling.GBTParams(), winsorize_p, features=features)
    files.write_prediction_file(out, f"{out_dir.rstrip('/')}/final_fulltrain_gbt.csv")
    return info


def run_cv_ensemble(src, out_dir: str, params=None, k: int = 10, seeds=(2025, 2027, 2031),
                    features=None) -> DataFrame:
    """Balanced group folds x seeds; OOF report and log-space test average to a file.
    Returns the fold-score frame."""
    from clickroll.plans import modeling
    sc = modeling.cv_scores(src, k=k, seeds=seeds, params=params or modeling.GBTParams(),
                            fold_method="balanced", features=features)
    pred = ensemble.test_average(sc, keys=("user_session",), space="log")
    default = encode.global_mean(labels.labels_first_per_user_session(src.label_rows), "session_value")
    files.write_prediction_file(predict.fill_template(src.template, pred, default),
                                f"{out_dir.rstrip('/')}/gbt_cv{k}_seeds{len(seeds)}.csv")
    return ensemble.fold_scores(sc)
