"""Target transforms: log / inverse, one- and two-sided winsorizing at exact quantiles
(``operators/quantiles``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickroll.functions.exprs import clip, expm1, log1p_clipped, log1p_plain
from clickroll.operators.quantiles import exact_quantiles

def log_target(df: DataFrame, col: str = "session_value", out: str = "y",
               clip_negative: bool = True) -> DataFrame:
    """[F10 F10b P16] ``log1p(max(y,0))`` (clip variant) or ``log1p(y)`` (values <= -1 -> NULL)."""
    e = log1p_clipped(col) if clip_negative else log1p_plain(col)
    return df.withColumn(out, e)


def inverse_target(df: DataFrame, col: str = "pred", out: str = "session_value") -> DataFrame:
    return df.withColumn(out, expm1(col))


def winsorize_upper(df: DataFrame, col: str, p: float, out: str | None = None) -> DataFrame:
    """Cap at the p-quantile; active only for 0.5 < p < 1."""
    out = out or col
    if not (p and 0.5 < p < 1.0):
        return df.withColumn(out, F.col(col))
    (hi,) = exact_quantiles(df, col, [p])
    return df.withColumn(out, clip(col, hi=hi) if hi is not None else F.col(col))


def winsorize_two_sided(df: DataFrame, col: str, p: float, out: str | None = None) -> DataFrame:
    """Clip to [q(1-p), q(p)]; active for 0 < p < 1; missing values ignored."""
    out = out or col
    if not (0.0 < p < 1.0):
        return df.withColumn(out, F.col(col))
    lo, hi = exact_quantiles(df, col, [1.0 - p, p])
    if lo is None:
        return df.withColumn(out, F.col(col))
    return df.withColumn(out, clip(col, lo=lo, hi=hi))  # numpy order: max with lo, then min with hi
