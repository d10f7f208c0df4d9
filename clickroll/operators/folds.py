"""Group-wise validation splits: seeded K-fold, size-balanced K-fold, group hold-out,
and the global-mean baseline scored per fold.

Fold membership needs a global order of the distinct groups. A single-partition
window would put every group in one task, so ``ordered_index`` ranks in two levels:
groups are bucketed by the top bits of their (uniform) hash, each bucket is ranked
by its own window, and bucket offsets come from a running sum over the bucket count
table (at most ``2**bucket_bits`` rows, broadcast).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickroll.session import materialize

BUCKET_BITS = 10     # 1,024 rank buckets
HASH_BITS = 60       # 15 hex digits of md5


def seeded_hash(col: Column, seed) -> Column:
    """Non-negative 60-bit hash of ``group|seed`` (md5, so SQL engines agree); ``seed``
    may be a number or a column."""
    sd = seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed))
    key = F.concat(F.coalesce(col.cast("string"), F.lit("<null>")), F.lit("|"), sd)
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")


def ordered_index(df: DataFrame, bucket_cols, order_cols, group_cols=()) -> DataFrame:
    """Adds ``_idx`` (0-based position in ``bucket_cols, order_cols`` order) and ``_n``
    (row count), both within each ``group_cols`` group (independent orderings, e.g. one
    per seed). ``bucket_cols`` must be monotone in the order."""
    group_cols, bucket_cols = list(group_cols), list(bucket_cols)
    keys = group_cols + bucket_cols
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_bn"))
    before = Window.partitionBy(*group_cols).orderBy(*bucket_cols).rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(*keys,
                         F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_off"),
                         F.sum("_bn").over(Window.partitionBy(*group_cols)).alias("_n"))
    inner = Window.partitionBy(*keys).orderBy(*order_cols)
    ranked = df.withColumn("_r", F.row_number().over(inner) - 1)
    return (ranked.join(F.broadcast(offs), keys)
            .withColumn("_idx", (F.col("_off") + F.col("_r")).cast("bigint"))
            .drop("_off", "_r"))


def _block_of(idx: Column, n: Column, k: int) -> Column:
    """0-based block of position ``idx`` when ``n`` items are split into ``k`` near-equal
    consecutive blocks, the first ``n mod k`` one larger (``numpy.array_split``)."""
    q = F.floor(n / F.lit(k)).cast("bigint")
    r = (n % F.lit(k)).cast("bigint")
    big = r * (q + 1)
    return F.when(idx < big, F.floor(idx / (q + 1))).otherwise(
        r + F.floor((idx - big) / F.nullif(q, F.lit(0)))).cast("bigint")


def _distinct_groups(labels: DataFrame, group_col: str, seed: int) -> DataFrame:
    g = labels.select(F.col(group_col).alias("_g")).distinct()
    h = seeded_hash(F.col("_g"), seed)
    return g.withColumn("_h", h).withColumn("_b", F.shiftright("_h", HASH_BITS - BUCKET_BITS))


def group_folds(labels: DataFrame, group_col: str = "user_id", k: int = 5, seed: int = 42,
                method: str = "exact") -> DataFrame:
    """[V1 W5] Seeded group K-fold: groups in seeded-hash order split into K consecutive blocks.

    ``method="exact"`` reproduces the block sizes of a shuffled ``array_split``;
    ``method="hash"`` (``pmod`` of the hash) needs no ranking and no join, with sizes
    balanced only in expectation. Adds ``fold`` in 1..k.
    """
    if method == "hash":
        return labels.withColumn("fold", (F.pmod(seeded_hash(F.col(group_col), seed), F.lit(k)) + 1)
                                 .cast("bigint"))
    g = ordered_index(_distinct_groups(labels, group_col, seed), ["_b"], ["_h", "_g"])
    g = g.select(F.col("_g").alias(group_col), (_block_of(F.col("_idx"), F.col("_n"), k) + 1).alias("fold"))
    return labels.join(g, labels[group_col].eqNullSafe(g[group_col]), "left").drop(g[group_col])


def group_folds_by_seed(labels: DataFrame, group_col: str = "user_id", k: int = 5,
                        seeds=(42,), prefix: str = "fold_") -> DataFrame:
    """[V1 M4] ``group_folds`` for several seeds in one ranking pass: the distinct groups are
    fanned out to one row per seed and ranked per seed. Adds ``fold_<seed>`` columns."""
    seeds = [int(s) for s in seeds]
    g = labels.select(F.col(group_col).alias("_g")).distinct()
    gs = g.select("_g", F.explode(F.array(*[F.lit(s) for s in seeds])).alias("_seed"))
    gs = (gs.withColumn("_h", seeded_hash(F.col("_g"), F.col("_seed")))
          .withColumn("_b", F.shiftright("_h", HASH_BITS - BUCKET_BITS)))
    r = ordered_index(gs, ["_b"], ["_h", "_g"], group_cols=["_seed"])
    r = r.withColumn("_fold", _block_of(F.col("_idx"), F.col("_n"), k) + 1)
    wide = r.groupBy("_g").agg(*[F.max(F.when(F.col("_seed") == s, F.col("_fold"))).alias(f"{prefix}{s}")
                                 for s in seeds])
    wide = wide.withColumnRenamed("_g", group_col)
    return labels.join(wide, labels[group_col].eqNullSafe(wide[group_col]), "left").drop(wide[group_col])


#: groups of one size that are ranked in one window
RANK_ROWS = 1 << 16
#: size classes whose dealing table is sent to every task; more of them are joined by a shuffle
BROADCAST_CLASSES = 50_000


def deal_classes(classes, k: int) -> list[tuple[int, list[int], list[list[int]]]]:
    """Plain greedy dealing of groups, largest first and each to the lightest fold so far
    (the lowest number of several), for whole classes of equal-sized groups at once.

    ``classes``: (size, number of groups), by falling size. Adding groups of size s, a fold
    of load L takes them at the loads L, L + s, L + 2s, ...; greedy dealing follows these
    numbers in order over all folds, ties by fold. In terms of q, r = divmod(L, s) the m-th
    group of a fold comes at (q + m, r, fold): round after round of all folds with q up to the
    round's number, in the order of (r, fold). Rounds change members at most k times.

    Returns (size, starts, members): from the group of rank ``starts[i]`` on, ``members[i]`` are
    dealt to in turn (folds from 1).
    """
    loads = [0] * k
    out = []
    for size, count in classes:
        at = [divmod(load, size) for load in loads]
        order = sorted(range(k), key=lambda f: (at[f][1], f))
        rounds = sorted({q for q, _ in at})
        starts, members, rank = [], [], 0
        for q, following in zip(rounds, [*rounds[1:], None], strict=True):
            if rank == count:
                break
            now = [f for f in order if at[f][0] <= q]
            take = count - rank if following is None else min(count - rank, (following - q) * len(now))
            starts.append(rank)
            members.append([f + 1 for f in now])
            for i, f in enumerate(now):
                loads[f] += size * (take // len(now) + (i < take % len(now)))
            rank += take
        out.append((size, starts, members))
    return out


def balanced_group_folds(labels: DataFrame, group_col: str = "user_id", k: int = 10,
                         seed: int = 0) -> DataFrame:
    """[V2] Size-balanced group K-fold: groups by falling size, each to the lightest fold so far.
    Unseeded in the reference; ``seed`` orders equal-sized groups (by hash, then value).

    Groups of one size are interchangeable, so a size class is dealt in closed form
    (``deal_classes``) from the histogram (size, number of groups): n rows have at most
    sqrt(2 n) sizes. A group's fold follows from its rank in its class. Ranks are taken in
    ranges of the hash of about RANK_ROWS groups, offset by the ranges' sums, so no task
    meets all groups of a common size.
    """
    spark = labels.sparkSession
    sizes = materialize(labels.groupBy(F.col(group_col).alias("_g")).agg(F.count(F.lit(1)).alias("_size"))
                        .withColumn("_h", seeded_hash(F.col("_g"), seed)))
    histogram = [(r["_size"], r["count"]) for r in sizes.groupBy("_size").count().orderBy(F.desc("_size")).toLocalIterator()]
    table = [(size, -(-count // RANK_ROWS), starts, members)
             for (size, count), (_, starts, members) in zip(histogram, deal_classes(histogram, k), strict=True)]
    deal = spark.createDataFrame(table, "_size long, _ranges long, _starts array<long>, _members array<array<long>>")
    if len(table) <= BROADCAST_CLASSES:
        deal = F.broadcast(deal)
    step = F.ceil(F.lit(float(1 << HASH_BITS)) / F.col("_ranges")).cast("bigint")
    ranged = sizes.join(deal, "_size").withColumn("_b", F.floor(F.col("_h") / step).cast("bigint"))
    counts = ranged.groupBy("_size", "_b").agg(F.count(F.lit(1)).alias("_bn"))
    before = Window.partitionBy("_size").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)   # one line a range
    offsets = counts.select("_size", "_b", F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_off"))
    inner = Window.partitionBy("_size", "_b").orderBy("_h", "_g")
    ranked = ranged.withColumn("_r", F.row_number().over(inner) - 1).join(offsets, ["_size", "_b"])
    rank = F.col("_off") + F.col("_r")
    piece = F.size(F.filter("_starts", lambda x: x <= F.col("_rank")))
    ranked = ranked.withColumn("_rank", rank).withColumn("_piece", piece)
    turn = F.element_at("_members", F.col("_piece"))
    fold = F.element_at(turn, (F.pmod(F.col("_rank") - F.element_at("_starts", F.col("_piece")), F.size(turn)) + 1).cast("int"))
    g = ranked.select(F.col("_g").alias(group_col), fold.alias("fold"))
    return labels.join(g, labels[group_col].eqNullSafe(g[group_col]), "left").drop(g[group_col])


def group_holdout(labels: DataFrame, group_col: str = "user_id", test_size: float = 0.1,
                  seed: int = 2025) -> DataFrame:
    """[V3] One group hold-out: the first ceil(test_size * groups) groups in seeded-hash
    order. Adds boolean ``is_holdout``."""
    g = ordered_index(_distinct_groups(labels, group_col, seed), ["_b"], ["_h", "_g"])
    hold = F.col("_idx") < F.ceil(F.col("_n") * F.lit(float(test_size)))
    g = g.select(F.col("_g").alias(group_col), hold.alias("is_holdout"))
    return labels.join(g, labels[group_col].eqNullSafe(g[group_col]), "left").drop(g[group_col])


def baseline_cv(folded: DataFrame, target: str = "session_value") -> DataFrame:
    """[V4 A6 A14 A16 P17] Global-mean predictor per fold: train mean over the other folds, validation MSE.

    One pass for all folds: per-fold sums (K rows) give each fold's complement mean,
    which is broadcast (K rows) back to the labels. Output: fold, train_mean, val_mse,
    n_tr, n_va, cv_mean_mse (unweighted mean over folds).
    """
    y = F.col(target)   # a DECIMAL target (money) gives exact fold means
    per = folded.groupBy("fold").agg(F.sum(y).alias("_s"), F.count(y).alias("_c"))
    tot = Window.partitionBy()
    mu = per.select("fold",
                    ((F.sum("_s").over(tot) - F.col("_s")).cast("double")
                     / F.nullif(F.sum("_c").over(tot) - F.col("_c"), F.lit(0))).alias("train_mean"),
                    (F.sum("_c").over(tot) - F.col("_c")).alias("n_tr"))
    scored = folded.join(F.broadcast(mu), "fold")
    res = scored.groupBy("fold").agg(
        F.first("train_mean").alias("train_mean"),
        F.avg((y.cast("double") - F.col("train_mean")) ** 2).alias("val_mse"),
        F.first("n_tr").alias("n_tr"),
        F.count(F.lit(1)).alias("n_va"))
    return res.withColumn("cv_mean_mse", F.avg("val_mse").over(Window.partitionBy()))
