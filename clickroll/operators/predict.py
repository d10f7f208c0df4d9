"""Prediction sets: template fill, constant prediction, blends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_predictions(pred: DataFrame, key: str = "user_session", value: str = "session_value",
                       order_col: str | None = "row_no") -> DataFrame:
    """[J8] One prediction per key; with repeated keys the last one (input order) wins."""
    if order_col is None or order_col not in pred.columns:
        return pred.groupBy(key).agg(F.max(value).alias(value))
    return pred.groupBy(key).agg(F.max_by(F.col(value), F.col(order_col)).alias(value))


def fill_template(template: DataFrame, pred: DataFrame, default, key: str = "user_session",
                  value: str = "session_value") -> DataFrame:
    """[J8 J8b S7] Template rows in template order with the predicted value, else ``default``
    (a number or a one-row frame)."""
    p = dedupe_predictions(pred, key, value).select(key, F.col(value).alias("_pred"))
    t = template.select(key, "row_no")
    j = t.join(p, key, "left")
    if isinstance(default, DataFrame):
        v = F.coalesce(F.col("_pred"), default.select(default.columns[0]).scalar())
    else:
        v = F.coalesce(F.col("_pred"), F.lit(float(default)))
    return j.select(key, v.cast("double").alias(value), "row_no")


def constant_prediction(template: DataFrame, value_frame: DataFrame, value: str = "session_value") -> DataFrame:
    """[V5] Every template row gets the single value of ``value_frame`` (one row, read as a
    scalar subquery)."""
    d = value_frame.select(F.col(value_frame.columns[0]).cast("double")).scalar()
    return template.select("user_session", "row_no", d.alias(value))


def blend(sets, weights=None, key: str = "user_session", value: str = "session_value",
          order_col: str | None = None) -> DataFrame:
    """[J9 F14] Weighted blend of prediction sets on their common keys (inner joins);
    ``order_col`` of the first set is kept if asked for."""
    sets = list(sets)
    weights = list(weights) if weights is not None else [1.0 / len(sets)] * len(sets)
    out = None
    for i, s in enumerate(sets):
        kept = [order_col] if order_col and i == 0 else []
        part = s.select(key, F.col(value).alias(f"_v{i}"), *kept)
        out = part if out is None else out.join(part, key, "inner")
    total = sum((F.lit(float(w)) * F.col(f"_v{i}") for i, w in enumerate(weights)), F.lit(0.0))
    return out.select(key, total.alias(value), *([order_col] if order_col else []))
