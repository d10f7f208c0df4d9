"""Column expressions used by the feature, target and report operators.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
Spark runs with ANSI semantics: division by zero raises, so every quotient is
guarded explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def per_nonzero(num, den) -> Column:
    """[F1 F3 F5] ``num / den`` with a zero denominator giving NULL (pandas ``replace(0, nan)``)."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


def safe_ratio(num, den) -> Column:
    """``num / den`` where a denominator <= 0 is replaced by 1."""
    d = _c(den)
    return _c(num) / F.when(d <= 0, F.lit(1)).otherwise(d)


def entropy_term(count, total) -> Column:
    """``-p ln p`` for ``p = count / total``; zero terms contribute nothing."""
    p = per_nonzero(count, total)
    return F.when(p > 0, -p * F.ln(p)).otherwise(F.lit(0.0))


def clip(x, lo=None, hi=None) -> Column:
    """Clip keeping NULL as NULL (``least``/``greatest`` alone would skip it)."""
    v = _c(x)
    out = v
    if lo is not None:
        out = F.greatest(out, _c(lo) if not isinstance(lo, (int, float)) else F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, _c(hi) if not isinstance(hi, (int, float)) else F.lit(float(hi)))
    return F.when(v.isNull(), F.lit(None)).otherwise(out)


def log1p_clipped(y) -> Column:
    """``log1p(max(y, 0))``."""
    return F.log1p(clip(y, lo=0.0))


def log1p_plain(y) -> Column:
    """[F10b] ``log1p(y)``; values <= -1 give NULL."""
    v = _c(y)
    return F.when(v > -1, F.log1p(v))


def expm1(y) -> Column:
    return F.expm1(_c(y))


def finite_or_zero(x) -> Column:
    """NaN / +-inf / NULL -> 0.0."""
    v = _c(x)
    bad = F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    return F.coalesce(F.when(bad, F.lit(0.0)).otherwise(v), F.lit(0.0))


def round6(x) -> Column:
    """Report rounding."""
    return F.round(_c(x), 6)
