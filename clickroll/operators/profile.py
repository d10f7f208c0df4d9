"""Label profile: distribution summary and tail counts of the session target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickroll.operators.target import exact_quantiles

# The quantile levels reported by the reference's profile.
PROFILE_PROBS = [0.0, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 0.995, 1.0]
PROFILE_NAMES = ["q000", "q025", "q050", "q075", "q090", "q095", "q099", "q0995", "q100"]


def tail_stats(labels: DataFrame, target: str = "session_value") -> DataFrame:
    """[A10 A11 F15] mean, sample std and the profile quantiles (one row)."""
    qs = exact_quantiles(labels, target, PROFILE_PROBS)
    y = F.col(target).cast("double")
    return labels.agg(F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"),
                      *[F.lit(q).cast("double").alias(n) for q, n in zip(qs, PROFILE_NAMES)])


def tail_counts(labels: DataFrame, target: str = "session_value") -> DataFrame:
    """[A12] Rows strictly above p99 and p99.5, and the maximum (one row)."""
    p99, p995 = exact_quantiles(labels, target, [0.99, 0.995])
    y = F.col(target).cast("double")
    return labels.agg(F.count_if(y > F.lit(p99)).alias("n_above_p99"),
                      F.count_if(y > F.lit(p995)).alias("n_above_p995"),
                      F.max(y).alias("max"))


def heavy_users(labels: DataFrame, target: str = "session_value", group_col: str = "user_id",
                min_sessions: int = 3) -> DataFrame:
    """[A13] Users with at least ``min_sessions`` sessions whose mean exceeds p95; 0 when p95 is 0."""
    (p95,) = exact_quantiles(labels, target, [0.95])
    per = labels.groupBy(group_col).agg(F.avg(F.col(target).cast("double")).alias("_mu"),
                                        F.count(F.lit(1)).alias("_n"))
    hit = (F.col("_n") >= min_sessions) & (F.col("_mu") > F.lit(p95)) & F.lit(bool(p95))
    return per.agg(F.count_if(hit).alias("users_heavy_mu_gt_p95"))


def session_user_counts(labels: DataFrame, group_col: str = "user_id") -> DataFrame:
    """[A9 A17] Number of sessions and of distinct users (one row)."""
    return labels.agg(F.count(F.lit(1)).alias("n_sessions"),
                      F.count_distinct(group_col).alias("n_users"))
