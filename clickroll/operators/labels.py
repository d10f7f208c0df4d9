"""One label per session from the labelled train events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labels_first_per_session(labeled: DataFrame, target: str = "session_value") -> DataFrame:
    """[W4 P3] Variant A: drop rows missing session, user or target; keep each session's first
    row in input order. ``min_by`` is partially aggregated, so a hot session costs one
    row per map task in the shuffle."""
    ev = labeled.where(F.col("user_session").isNotNull() & F.col("user_id").isNotNull()
                       & F.col(target).isNotNull())
    # row_no is a unique input position, so both picks come from the same (first) row;
    # scalar values and a scalar ordering keep the aggregate in the hash map
    return (ev.groupBy("user_session")
            .agg(F.min_by("user_id", "row_no").alias("user_id"), F.min_by(target, "row_no").alias(target)))


def labels_first_per_user_session(labeled: DataFrame, target: str = "session_value") -> DataFrame:
    """[W4b] Variant B: first row per (user, session) in input order; missing keys form their
    own group and a missing first target stays missing."""
    return (labeled.groupBy("user_id", "user_session")
            .agg(F.min_by(F.col(target), F.col("row_no")).alias(target))
            .select("user_id", "user_session", target))


def require_non_empty(df: DataFrame, what: str = "label set") -> DataFrame:
    """[P4] Fail on an empty label set (one-row probe, not a count)."""
    if df.isEmpty():
        raise ValueError(f"empty {what}")
    return df
