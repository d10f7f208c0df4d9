"""Last product / category of a session (inputs of the item target encodings)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickroll.operators.features import _parsed_time, last_non_null, order_key


def last_items_nonnull(events: DataFrame, time_col: str | None = "event_time") -> DataFrame:
    """[A5 W1] Per session, the last non-missing product and category in time order
    (missing times last, ties by input position)."""
    ev = _parsed_time(events.where(F.col("user_session").isNotNull()), time_col)
    order = order_key(time_col)
    return ev.groupBy("user_session").agg(
        last_non_null("product_id", order).alias("last_product_id"),
        last_non_null("category_id", order).alias("last_category_id"))


def last_items_row(events: DataFrame, time_col: str | None = "event_time",
                   sentinel: bool = True) -> DataFrame:
    """[W3 W1b P9] Per (user, session), product and category of the whole last row in time order;
    missing values stay missing unless ``sentinel`` turns them into -1."""
    ev = events.where(F.col("user_id").isNotNull() & F.col("user_session").isNotNull())
    order = order_key(time_col)
    last = F.max_by(F.struct(F.col("product_id").alias("p"), F.col("category_id").alias("c")), order)
    out = (ev.groupBy("user_id", "user_session").agg(last.alias("_l"))
           .select("user_id", "user_session", F.col("_l.p").alias("last_product_id"),
                   F.col("_l.c").alias("last_category_id")))
    if sentinel:
        out = fill_sentinel(out, ["last_product_id", "last_category_id"])
    return out


def fill_sentinel(df: DataFrame, cols, value: int = -1) -> DataFrame:
    """[P15] Missing id -> -1 (numeric ids) or '-1' (text ids)."""
    from pyspark.sql import types as T
    types = {f.name: f.dataType for f in df.schema.fields}
    for c in cols:
        lit = F.lit(value) if isinstance(types[c], T.NumericType) else F.lit(str(value))
        df = df.withColumn(c, F.coalesce(F.col(c), lit.cast(types[c])))
    return df
