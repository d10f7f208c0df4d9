"""Driver-side schema helpers: required columns, time column lookup, feature lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names probed, in this order, for the event time column.
TIME_CANDIDATES = ("event_time", "timestamp", "event_timestamp", "time", "ts")
# The shorter list used by the boosted-tree trainers.
TIME_CANDIDATES_SHORT = ("event_time", "timestamp", "time")


def require_columns(df: DataFrame, cols) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def detect_time_column(columns, candidates=TIME_CANDIDATES) -> str | None:
    for c in candidates:
        if c in columns:
            return c
    return None


def feature_columns(columns, exclude, extra=()) -> list[str]:
    """[P2] All columns minus ``exclude`` plus ``extra``, de-duplicated in order."""
    out = [c for c in columns if c not in set(exclude)] + list(extra)
    return list(dict.fromkeys(out))


def numeric_only(df: DataFrame, cols) -> tuple[DataFrame, list[str], list[str]]:
    """[P12] Keep numeric feature columns, booleans become 0/1 ints; report the dropped ones."""
    types = {f.name: f.dataType for f in df.schema.fields}
    kept, dropped, out = [], [], df
    for c in cols:
        t = types.get(c)
        if isinstance(t, T.BooleanType):
            out = out.withColumn(c, F.col(c).cast("int"))
            kept.append(c)
        elif isinstance(t, T.NumericType):
            kept.append(c)
        else:
            dropped.append(c)
    return out, kept, dropped
