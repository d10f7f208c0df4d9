"""Session features: one row per ``user_session`` from the event contract.

Plan shape (see ``explain``): a partially aggregated base aggregate keyed by session,
and a (session, id) pre-aggregate built with GROUPING SETS that yields distinct
counts and largest repeat counts of products and categories in two exchanges.
Both sides are hash-partitioned by session, so the join between them adds no
exchange. Hot sessions are absorbed by the map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickroll.functions.exprs import clip, entropy_term, finite_or_zero, per_nonzero, safe_ratio

NULL_TYPE_NAME = "nan"  # string form of a missing event type in the code table

COUNT_PREFIX = "event_type_count_"
RATIO_PREFIX = "event_type_ratio_"


def event_type_domain(events: DataFrame):
    """[A2 W6] (pivot values, code domain) of the event types.

    The pivot has a column for each type that some session has; codes count over all
    rows, those without a session included. Both become columns or literals of the
    plan, so the complete distinct set is what the driver needs.
    """
    t = F.col("event_type").cast("string").alias("t")
    rows = events.groupBy(t).agg(F.max(F.col("user_session").isNotNull()).alias("pivoted")).collect()
    values = sorted(r.t for r in rows if r.t is not None and r.pivoted)
    codes = sorted({(r.t if r.t is not None else NULL_TYPE_NAME) for r in rows})
    return values, codes


def event_type_codes(events: DataFrame) -> DataFrame:
    """[W6] Dense code per event type (string form, missing -> 'nan'), lexical order from 0.

    The window runs on the distinct type set only, which is tiny.
    """
    t = F.coalesce(F.col("event_type").cast("string"), F.lit(NULL_TYPE_NAME))
    from pyspark.sql import Window
    return (events.select(t.alias("event_type")).distinct()
            .withColumn("code", (F.dense_rank().over(Window.orderBy("event_type")) - 1).cast("bigint")))


def code_lookup(col: Column, domain) -> Column:
    """[J10] Event type -> code from a literal map of the (small) domain; unknown -> -1."""
    if not domain:
        return F.lit(-1).cast("bigint")
    m = F.create_map(*[x for i, t in enumerate(domain) for x in (F.lit(t), F.lit(i).cast("bigint"))])
    return F.coalesce(F.try_element_at(m, col), F.lit(-1).cast("bigint"))


def order_key(time_col: str | None) -> Column:
    """[W1 W1b] In-session order: parsed time ascending with missing times last, ties by input position."""
    if time_col is None:
        return F.col("row_no")
    return F.struct(F.col(time_col).isNull().alias("t_missing"), F.col(time_col).alias("t"),
                    F.col("row_no").alias("r"))


def first_non_null(col: str, order: Column) -> Column:
    """[A1 W1] pandas ``first``: the earliest non-null value (null orderings are skipped)."""
    return F.min_by(F.col(col), F.when(F.col(col).isNotNull(), order))


def last_non_null(col: str, order: Column) -> Column:
    return F.max_by(F.col(col), F.when(F.col(col).isNotNull(), order))


def _parsed_time(events: DataFrame, time_col: str | None) -> DataFrame:
    if time_col is None:
        return events
    dtype = events.schema[time_col].dataType
    if isinstance(dtype, T.StringType):
        return events.withColumn(time_col, F.try_to_timestamp(F.col(time_col)))
    if isinstance(dtype, T.DateType):
        return events.withColumn(time_col, F.col(time_col).cast("timestamp_ntz"))
    return events


def session_id_profiles(events: DataFrame, product_col: str = "product_id",
                        category_col: str = "category_id") -> DataFrame:
    """[A5] Per session: distinct products / categories and the largest repeat count of each.

    One GROUPING SETS aggregate over (session, product) and (session, category), then a
    session-level aggregate. Missing ids are neither distinct values nor repeats; a
    session whose ids are all missing gets 0.
    """
    g = (events.groupingSets([["user_session", product_col], ["user_session", category_col]],
                             "user_session", product_col, category_col)
         .agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_gid")))
    is_p = (F.col("_gid") == 1) & F.col(product_col).isNotNull()
    is_c = (F.col("_gid") == 2) & F.col(category_col).isNotNull()
    return g.groupBy("user_session").agg(
        F.count_if(is_p).alias("unique_product_count"),
        F.count_if(is_c).alias("unique_category_count"),
        F.coalesce(F.max(F.when(is_p, F.col("_n"))), F.lit(0)).cast("bigint").alias("product_repeat_max"),
        F.coalesce(F.max(F.when(is_c, F.col("_n"))), F.lit(0)).cast("bigint").alias("category_repeat_max"),
    )


def _split_flags() -> list[Column]:
    return [F.max(F.col("split") == "train").alias("_in_train"),
            F.max(F.col("split") == "test").alias("_in_test")]


def _count_cols(types):
    return [f"{COUNT_PREFIX}{t}" for t in types]


def _fill_numeric(df: DataFrame, skip=("user_session",)) -> DataFrame:
    """pandas ``replace([inf,-inf],0)`` + ``fillna(0.0)`` over the numeric columns."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in skip or not isinstance(f.dataType, T.NumericType):
            out.append(c)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(finite_or_zero(c).alias(f.name))
        else:
            out.append(F.coalesce(c, F.lit(0).cast(f.dataType)).alias(f.name))
    return df.select(*out)


def session_features_v1(events: DataFrame, types=None, with_split_flags: bool = False) -> DataFrame:
    """[A1 A2 J1 F1 F16 P10 P13] v1: first user (input order), event count, distinct
    products / categories, a count and a ratio per event type.

    One aggregate: Spark plans the two distinct counts as an expand with partial
    aggregation (two exchanges, no join, one read of the events); every aggregate here
    is hash-based, and a hot session is combined map-side at each stage.
    """
    ev = events.where(F.col("user_session").isNotNull())
    if types is None:
        types, _ = event_type_domain(events)
    aggs = [first_non_null("user_id", F.col("row_no")).alias("user_id"),
            F.count(F.lit(1)).alias("session_event_count"),
            F.count_distinct("product_id").alias("unique_product_count"),
            F.count_distinct("category_id").alias("unique_category_count")]
    aggs += [F.count_if(F.col("event_type") == t).alias(c) for t, c in zip(types, _count_cols(types))]
    if with_split_flags:
        aggs += _split_flags()
    j = ev.groupBy("user_session").agg(*aggs)
    n = F.col("session_event_count")
    cols = [F.col("user_session"), F.col("user_id"), n,
            F.col("unique_product_count"), F.col("unique_category_count")]
    cols += [F.col(f"`{c}`") for c in _count_cols(types)]
    cols += [per_nonzero(F.col(f"`{c}`"), n).alias(f"{RATIO_PREFIX}{t}")
             for t, c in zip(types, _count_cols(types))]
    if with_split_flags:
        cols += [F.col("_in_train"), F.col("_in_test")]
    return _fill_numeric(j.select(*cols), skip=("user_session", "_in_train", "_in_test"))


def session_features_v2(events: DataFrame, types=None, codes=None,
                        time_col: str | None = "event_time",
                        with_split_flags: bool = False,
                        session_attrs: DataFrame | None = None,
                        single_pass: bool = False) -> DataFrame:
    """[A1-A4 F1-F9 W1 W2 W6 J2 J10 P7 P13 P14] v2 = v1 + buyer flag, unique / revisit /
    repeat ratios, event-type entropy, guarded buy / cart / view ratios, first and last
    event-type codes and, with a time column, duration and events per minute.

    ``session_attrs`` (``user_session, user_id[, split]``) supplies attributes that are
    constant within a session from a session-level table; it is joined after the
    aggregation (one row per session on each side) instead of being joined to every
    event first. Sessions without attributes are dropped, as an inner join to the
    events would have dropped them.

    ``single_pass=True`` reads ``events`` once (see ``_single_pass_aggregate``): the
    better plan when the events are themselves a join, which would otherwise be
    computed once per consumer.
    """
    if session_attrs is not None:
        return _with_session_attrs(events, session_attrs, types, codes, time_col, with_split_flags,
                                   single_pass)
    ev = _parsed_time(events.where(F.col("user_session").isNotNull()), time_col)
    if types is None or codes is None:
        t_, c_ = event_type_domain(events)
        types = t_ if types is None else types
        codes = c_ if codes is None else codes
    order = order_key(time_col)
    type_str = F.coalesce(F.col("event_type").cast("string"), F.lit(NULL_TYPE_NAME))
    if single_pass:
        j = _single_pass_aggregate(ev, types, order, type_str, time_col, with_split_flags)
    else:
        aggs = [first_non_null("user_id", order).alias("user_id"),
                F.count(F.lit(1)).alias("session_event_count")]
        aggs += [F.count_if(F.col("event_type") == t).alias(c) for t, c in zip(types, _count_cols(types))]
        aggs += [F.min_by(type_str, order).alias("_first_type"), F.max_by(type_str, order).alias("_last_type")]
        if time_col is not None:
            aggs += [F.min(time_col).alias("_tmin"), F.max(time_col).alias("_tmax")]
        if with_split_flags:
            aggs += _split_flags()
        base = ev.groupBy("user_session").agg(*aggs)
        j = base.join(session_id_profiles(ev), "user_session", "left")

    n = F.col("session_event_count")
    cnt = {t: F.col(f"`{c}`") for t, c in zip(types, _count_cols(types))}
    zero = F.lit(0)
    buy, view, cart = cnt.get("BUY", zero), cnt.get("VIEW", zero), cnt.get("CART", zero)
    upr = per_nonzero("unique_product_count", n)
    cols = [F.col("user_session"), F.col("user_id"), n,
            F.col("unique_product_count"), F.col("unique_category_count")]
    cols += [cnt[t] for t in types]
    cols += [per_nonzero(cnt[t], n).alias(f"{RATIO_PREFIX}{t}") for t in types]
    cols += [
        ((buy > 0).cast("bigint") if "BUY" in cnt else F.lit(0).cast("bigint")).alias("is_buyer"),
        upr.alias("unique_product_ratio"),
        per_nonzero("unique_category_count", n).alias("unique_category_ratio"),
        (F.lit(1.0) - clip(upr, 0.0, 1.0)).alias("revisit_ratio"),
        F.col("product_repeat_max"), F.col("category_repeat_max"),
        per_nonzero("product_repeat_max", n).alias("product_repeat_max_ratio"),
        per_nonzero("category_repeat_max", n).alias("category_repeat_max_ratio"),
        (sum((entropy_term(cnt[t], n) for t in types), F.lit(0.0)) if types else F.lit(0.0))
        .alias("event_type_entropy"),
        safe_ratio(buy, view).cast("double").alias("buy_to_view_ratio"),
        safe_ratio(cart, view).cast("double").alias("cart_to_view_ratio"),
        safe_ratio(buy, cart).cast("double").alias("buy_to_cart_ratio"),
        code_lookup(F.col("_first_type"), codes).alias("first_event_type_code"),
        code_lookup(F.col("_last_type"), codes).alias("last_event_type_code"),
    ]
    if time_col is not None:
        dur = F.coalesce(F.timestamp_diff("MICROSECOND", F.col("_tmin"), F.col("_tmax")) / F.lit(1e6),
                         F.lit(0.0))
        cols += [dur.alias("session_duration_seconds"),
                 (n / F.when(dur <= 0, F.lit(60.0)).otherwise(dur / F.lit(60.0))).alias("events_per_minute")]
    if with_split_flags:
        cols += [F.col("_in_train"), F.col("_in_test")]
    return _fill_numeric(j.select(*cols), skip=("user_session", "_in_train", "_in_test"))


def _single_pass_aggregate(ev, types, order, type_str, time_col, with_split_flags):
    """Base aggregates and (session, id) repeat counts from ONE read of the events.

    Each event is emitted three times with ``_kind`` 0 (session payload), 1 (its
    product) or 2 (its category); one aggregate over (session, kind, product,
    category) - partial, so hot keys combine map-side - is followed by a session-level
    merge. Two exchanges, no join.
    """
    k = F.col("_kind")
    x = (ev.withColumn("_kind", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
         .withColumn("_pk", F.when(k == 1, F.col("product_id")))
         .withColumn("_ck", F.when(k == 2, F.col("category_id"))))
    base = k == 0
    o0 = F.when(base, order)
    lvl1 = [F.count(F.lit(1)).alias("_n"),
            F.min_by(F.col("user_id"), F.when(base & F.col("user_id").isNotNull(), order)).alias("user_id")]
    lvl1 += [F.count_if(base & (F.col("event_type") == t)).alias(c) for t, c in zip(types, _count_cols(types))]
    lvl1 += [F.min_by(type_str, o0).alias("_first_type"), F.max_by(type_str, o0).alias("_last_type")]
    if time_col is not None:
        lvl1 += [F.min(F.when(base, F.col(time_col))).alias("_tmin"),
                 F.max(F.when(base, F.col(time_col))).alias("_tmax")]
    if with_split_flags:
        lvl1 += [F.max(F.when(base, F.col("split") == "train")).alias("_in_train"),
                 F.max(F.when(base, F.col("split") == "test")).alias("_in_test")]
    g = x.groupBy("user_session", "_kind", "_pk", "_ck").agg(*lvl1)
    carried = [c for c in g.columns if c not in ("user_session", "_kind", "_pk", "_ck", "_n")]
    is_p = (k == 1) & F.col("_pk").isNotNull()
    is_c = (k == 2) & F.col("_ck").isNotNull()
    lvl2 = [F.max(F.when(k == 0, F.col("_n"))).alias("session_event_count")]
    lvl2 += [F.max(F.when(k == 0, F.col(f"`{c}`"))).alias(c) for c in carried]
    lvl2 += [F.count_if(is_p).alias("unique_product_count"), F.count_if(is_c).alias("unique_category_count"),
             F.coalesce(F.max(F.when(is_p, F.col("_n"))), F.lit(0)).cast("bigint").alias("product_repeat_max"),
             F.coalesce(F.max(F.when(is_c, F.col("_n"))), F.lit(0)).cast("bigint").alias("category_repeat_max")]
    return g.groupBy("user_session").agg(*lvl2)


def _with_session_attrs(events, attrs, types, codes, time_col, with_split_flags, single_pass=False):
    ev = events.withColumn("user_id", F.lit(None).cast(attrs.schema["user_id"].dataType))
    if with_split_flags:
        ev = ev.withColumn("split", F.lit(None).cast("string"))
    f = session_features_v2(ev, types, codes, time_col, with_split_flags=False, single_pass=single_pass)
    a = attrs.groupBy("user_session").agg(
        F.first("user_id", ignorenulls=True).alias("user_id"),
        *(_split_flags() if with_split_flags else []))
    out = f.drop("user_id").join(a, "user_session", "inner")
    keep = [c for c in f.columns] + (["_in_train", "_in_test"] if with_split_flags else [])
    return out.select(*[F.coalesce(F.col("user_id"), F.lit(0).cast(attrs.schema["user_id"].dataType))
                        .alias("user_id") if c == "user_id" else F.col(f"`{c}`") for c in keep])


def session_users(events: DataFrame, time_col: str | None = "event_time") -> DataFrame:
    """[A1 J6] (user_session, user_id, split flags): the v2 table's user without its other columns."""
    ev = _parsed_time(events.where(F.col("user_session").isNotNull()), time_col)
    out = ev.groupBy("user_session").agg(first_non_null("user_id", order_key(time_col)).alias("user_id"),
                                         *_split_flags())
    return _fill_numeric(out, skip=("user_session", "_in_train", "_in_test"))


def split_features(features_with_flags: DataFrame):
    """[J6 U2] Train / test feature tables; a session present in both splits goes to both."""
    keep = [c for c in features_with_flags.columns if c not in ("_in_train", "_in_test")]
    tr = features_with_flags.where(F.col("_in_train")).select(*keep)
    te = features_with_flags.where(F.col("_in_test")).select(*keep)
    return tr, te


def tag_splits(features_with_flags: DataFrame) -> DataFrame:
    """[J6 P5 S6] One row per (session, split it occurs in), for a single partitioned write."""
    keep = [c for c in features_with_flags.columns if c not in ("_in_train", "_in_test")]
    splits = F.array_compact(F.array(F.when(F.col("_in_train"), F.lit("train")),
                                     F.when(F.col("_in_test"), F.lit("test"))))
    return features_with_flags.select(*keep, F.explode(splits).alias("split"))
