"""Target-mean encodings (user back-off, last product, last category).

Full-train encodings are a grouped mean joined back to the rows. Fold encodings are
computed for all K folds in ONE aggregation per key: per-key totals plus per-fold
sums, from which every fold's complement ("rows not in fold k") mean follows. The
encoded frame is then joined once per key and fanned out to one row per fold.
Join strategy is left to adaptive execution: a small encoding table is broadcast from
its measured size, a large one is sort-merge joined with skew splitting.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickroll.operators.hot_join import spread_join
from clickroll.session import materialize


@dataclass(frozen=True)
class EncodingSpec:
    key: str                  # lookup key column in the frames
    out: str                  # encoded column name
    target: str = "y"         # target column averaged
    null_key: str = "default"  # "default": missing key -> default; "sentinel": key already filled


def _grouped(train: DataFrame, specs, aggs):
    """All keys' aggregates plus the grand total in ONE pass: GROUPING SETS over each
    spec key and the empty set. Returns ({key: frame}, total_frame)."""
    keys = list(dict.fromkeys(s.key for s in specs))
    n = len(keys)
    g = (train.groupingSets([[k] for k in keys] + [[]], *keys)
         .agg(*aggs, F.grouping_id().alias("_gid")))
    # one row per distinct key: written once, then read by every key's join and by the
    # totals (Spark would otherwise recompute the aggregation for each consumer)
    g = materialize(g)
    everything = (1 << n) - 1
    per_key = {k: g.where(F.col("_gid") == everything - (1 << (n - 1 - i))).drop("_gid")
               .select(k, *[c for c in g.columns if c not in keys and c != "_gid"])
               for i, k in enumerate(keys)}
    total = g.where(F.col("_gid") == everything).select(*[c for c in g.columns if c not in keys and c != "_gid"])
    return per_key, total


def mean_by_key(frame: DataFrame, key: str, target: str, null_key: str = "default") -> DataFrame:
    """Mean target per key, written once: adaptive execution splits a hot key's rows only
    if both sides of the join back are shuffles, not an aggregate above its shuffle."""
    rows = frame.where(F.col(target).isNotNull())
    if null_key == "default":
        rows = rows.where(F.col(key).isNotNull())
    return materialize(rows.groupBy(key).agg(F.avg(target).cast("double").alias("_mean")))


def global_mean(frame: DataFrame, target: str, alias: str = "_default") -> DataFrame:
    """[A7 A7b A8 A8b] One-row frame: the mean target, used through ``.scalar()`` as a scalar subquery.
    A DECIMAL target (money) is averaged exactly."""
    return frame.agg(F.avg(target).cast("double").alias(alias))


def apply_encoding(frame: DataFrame, enc: DataFrame, key: str, out: str,
                   default: DataFrame | Column | float | None, spread=None) -> DataFrame:
    """[J7] ``frame[key] -> mean``; unseen or missing keys get ``default``. ``spread``: columns that
    differ between rows of one key; the join then finds hot keys itself and deals their
    rows by these columns (otherwise adaptive execution splits them)."""
    enc = enc.withColumnRenamed("_mean", out)
    j = frame.join(enc, key, "left") if spread is None else spread_join(frame, enc, [key], spread)
    if default is None:
        return j
    if isinstance(default, DataFrame):
        d = default.select(default.columns[0]).scalar()       # one-row frame -> scalar subquery
    else:
        d = default if isinstance(default, Column) else F.lit(float(default))
    return j.withColumn(out, F.coalesce(F.col(out), d))


def full_train_encodings(train: DataFrame, test: DataFrame, specs, default_target: str,
                         fill_train: bool = True):
    """[V7] In-sample encodings for train rows and their application to test rows.
    Returns (train_encoded, test_encoded)."""
    targets = {s.target for s in specs}
    if targets == {default_target}:
        y = F.col(default_target)
        per_key, total = _grouped(train, specs,
                                  [F.avg(y).cast("double").alias("_mean")])
        g = total.select("_mean")
        encs = {}
        for s in specs:
            e = per_key[s.key]
            encs[s.out] = e.where(F.col(s.key).isNotNull()) if s.null_key == "default" else e
    else:
        g = global_mean(train, default_target)
        encs = {s.out: mean_by_key(train, s.key, s.target, s.null_key) for s in specs}
    for s in specs:
        train = apply_encoding(train, encs[s.out], s.key, s.out, g if fill_train else None)
        test = apply_encoding(test, encs[s.out], s.key, s.out, g)
    return train, test


@dataclass(frozen=True)
class FoldLayout:
    """The (seed, fold) pairs of a wide fold-encoding frame, in array order."""
    pairs: tuple           # ((seed or None, fold), ...)
    fold_cols: dict        # seed -> row-fold column

    def index(self, seed, fold) -> int:
        return self.pairs.index((seed, fold)) + 1   # 1-based, for element_at


def fold_encodings_wide(train: DataFrame, test: DataFrame, specs, k: int, target: str = "y",
                        fold_col="fold", keep=("user_session",)):
    """[V6] Encodings of every fold (of every seed) in one pass, one row per input row.

    For fold f, a key's encoding is the mean target over train rows outside fold f;
    keys absent there (and missing keys) get the mean target over all rows outside f.
    ``fold_col`` is one column name, or a mapping ``{seed: column}`` for repeated fold
    assignments; every (seed, fold) pair becomes conditional sums in the same
    aggregation. Each spec's output is an array over the pairs (``FoldLayout`` order),
    so the frame stays as long as the input: ``fan_out`` turns it into one row per pair.
    Returns (frame, layout); the frame has ``keep``, the target, the row-fold
    columns, ``_is_test`` and one array column per spec.
    """
    fcols = dict(fold_col) if isinstance(fold_col, dict) else {None: fold_col}
    pairs = tuple((s, f) for s in fcols for f in range(1, k + 1))
    tag = {p: f"{'' if p[0] is None else p[0]}_{p[1]}" for p in pairs}
    y = F.col(target)

    def complement_means() -> list[Column]:
        return [((F.col("_s") - F.coalesce(F.col(f"_s{tag[p]}"), F.lit(0.0)))
                 / F.nullif(F.col("_c") - F.col(f"_c{tag[p]}"), F.lit(0))) for p in pairs]

    src = train.where(y.isNotNull())
    sum_aggs = [F.sum(y).alias("_s"), F.count(y).alias("_c")]
    for (s_, f) in pairs:
        inf = F.col(fcols[s_]) == f
        sum_aggs += [F.sum(F.when(inf, y)).alias(f"_s{tag[(s_, f)]}"),
                     F.count(F.when(inf, y)).alias(f"_c{tag[(s_, f)]}")]
    per_key, tot = _grouped(src, specs, sum_aggs)
    # per-pair defaults: one row -> one array-valued scalar subquery
    defaults = tot.select(F.array(*complement_means()).alias("_defaults")).scalar()

    cols = list(dict.fromkeys([*keep, *[s.key for s in specs]]))
    fold_names = list(dict.fromkeys(fcols.values()))
    tr = train.select(*cols, target, *fold_names).withColumn("_is_test", F.lit(False))
    te = test.select(*cols).withColumn(target, F.lit(None).cast("double"))
    for c in fold_names:
        te = te.withColumn(c, F.lit(None).cast("bigint"))
    rows = tr.unionByName(te.withColumn("_is_test", F.lit(True)))
    for sp in specs:
        st = per_key[sp.key]
        st = st.where(F.col(sp.key).isNotNull()) if sp.null_key == "default" else st
        rows = rows.join(st.select(sp.key, F.array(*complement_means()).alias(f"_{sp.out}")), sp.key, "left")
    n = len(pairs)
    rows = rows.withColumn("_defaults", defaults)       # the subquery runs once
    filled = [F.array(*[F.coalesce(F.element_at(F.col(f"_{sp.out}"), i), F.element_at(F.col("_defaults"), i))
                        for i in range(1, n + 1)]).alias(sp.out) for sp in specs]
    out = rows.select(*keep, target, *fold_names, "_is_test", *filled)
    return out, FoldLayout(pairs, fcols)


def pair_role(layout: FoldLayout, seed, fold) -> Column:
    """Role of a wide-frame row for one (seed, fold) model: fit / val / test."""
    return (F.when(F.col("_is_test"), F.lit("test"))
            .when(F.col(layout.fold_cols[seed]) == fold, F.lit("val")).otherwise(F.lit("fit")))


def fan_out(wide: DataFrame, layout: FoldLayout, specs, target: str = "y", keep=("user_session",),
            roles=("fit", "val", "test")) -> DataFrame:
    """One row per (row, [seed,] fold) with ``role``, ``row_fold`` and the pair's encodings.
    Only pairs in which the row has one of ``roles`` are made."""
    multi = layout.pairs[0][0] is not None
    wanted = F.array_compact(F.array(*[F.when(pair_role(layout, *p).isin(*roles), F.lit(i))
                                       for i, p in enumerate(layout.pairs, 1)]))
    fan = wide.withColumn("_p", F.explode(wanted))
    seed_of = F.element_at(F.array(*[F.lit(p[0] if p[0] is not None else 0) for p in layout.pairs]), F.col("_p"))
    fold_of = F.element_at(F.array(*[F.lit(p[1]) for p in layout.pairs]), F.col("_p")).cast("bigint")
    row_fold = F.element_at(F.array(*[F.col(layout.fold_cols[p[0]]) for p in layout.pairs]), F.col("_p"))
    role = (F.when(F.col("_is_test"), F.lit("test"))
            .when(row_fold == fold_of, F.lit("val")).otherwise(F.lit("fit")))
    out = [*[F.col(c) for c in keep], F.col(target), row_fold.cast("bigint").alias("row_fold")]
    if multi:
        out.append(seed_of.cast("bigint").alias("seed"))
    out += [fold_of.alias("fold"), role.alias("role")]
    out += [F.element_at(F.col(sp.out), F.col("_p")).alias(sp.out) for sp in specs]
    return fan.select(*out)


def fold_encodings(train: DataFrame, test: DataFrame, specs, k: int, target: str = "y",
                   fold_col="fold", keep=("user_session",), roles=("fit", "val", "test")) -> DataFrame:
    """[V6] Long form of ``fold_encodings_wide``: one row per (row, [seed,] fold) with
    ``role`` = 'fit' (row's fold != f), 'val' (row's fold == f) or 'test', the ``keep``
    columns, the target, ``row_fold`` and one column per spec."""
    wide, layout = fold_encodings_wide(train, test, specs, k, target, fold_col, keep)
    return fan_out(wide, layout, specs, target, keep, roles)
