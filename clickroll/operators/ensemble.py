"""Combining per-fold / per-seed scores: out-of-fold averages, test averages, fold scores.

Input is a long frame of scores, one row per (row key, seed, fold, role) with ``pred``
(and the target ``y`` on validation rows); every combination is a grouped aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def oof_average(scores: DataFrame, keys=("user_session",), pred: str = "pred",
                target: str | None = "y") -> DataFrame:
    """[V8] Each train row is validated once per seed; its OOF score is the mean over seeds."""
    v = scores.where(F.col("role") == "val")
    aggs = [F.avg(pred).alias("oof")]
    if target:
        aggs.append(F.first(target, ignorenulls=True).alias(target))
    return v.groupBy(*keys).agg(*aggs)


def test_average(scores: DataFrame, keys=("user_session",), pred: str = "pred",
                 space: str = "log") -> DataFrame:
    """[V9 V9b] Test rows scored by every (seed, fold) model.

    ``space="log"``: average the log-scale scores, then ``expm1``.
    ``space="linear"``: ``expm1`` each score, then average.
    """
    t = scores.where(F.col("role") == "test")
    if space == "log":
        v = F.expm1(F.avg(pred))
    elif space == "linear":
        v = F.avg(F.expm1(pred))
    else:
        raise ValueError(f"unknown space {space!r}")
    return t.groupBy(*keys).agg(v.alias("session_value"))


def fold_scores(scores: DataFrame, pred: str = "pred", target: str = "y") -> DataFrame:
    """[A15 A16] MSE and RMSE per (seed, fold) on validation rows, with the unweighted mean over folds."""
    from pyspark.sql import Window
    v = scores.where(F.col("role") == "val")
    per = v.groupBy("seed", "fold").agg(F.avg((F.col(target) - F.col(pred)) ** 2).alias("mse"),
                                        F.count(F.lit(1)).alias("n_va"))
    per = per.withColumn("rmse", F.sqrt("mse"))
    return per.withColumn("cv_mean_mse", F.avg("mse").over(Window.partitionBy("seed")))


def pooled_score(oof: DataFrame, pred: str = "oof", target: str = "y") -> DataFrame:
    """[A14 A15] Pooled out-of-fold MSE / RMSE (one row)."""
    return (oof.agg(F.avg((F.col(target) - F.col(pred)) ** 2).alias("oof_mse"))
            .withColumn("oof_rmse", F.sqrt("oof_mse")))
