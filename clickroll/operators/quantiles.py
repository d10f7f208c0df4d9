"""Exact quantiles by radix selection, overall and by group.

Doubles map to 64-bit integers in the same order (``ordered_key``). A pass counts the rows
of the cells still of interest by the next DIGIT_BITS bits of the key: at most
2**DIGIT_BITS lines a cell, from map-side partial counts. Running totals over these lines
tell which cells hold the wanted ranks, for all levels at once. A cell whose least and
greatest value are equal is decided; the others are cut again, four passes in all at most.

Quantiles are interpolated linearly between neighbouring ranks, as ``numpy.quantile`` does.
Missing values and NaN do not count; a group without values has no line.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickroll.session import materialize

KEY_BITS, DIGIT_BITS = 64, 16
_LEAST_NORMAL = 2.0 ** -1022


def ordered_key(value: Column) -> Column:
    """A long in the order of a double (not NaN): its bits, those of negative numbers
    turned round. Made of arithmetic, so it stays in generated code.

    A normal number is m * 2**e with 1 <= m < 2; its bits are (e + 1023) * 2**52 + (m - 1) * 2**52.
    The logarithm may miss e by one next to a power of two, which m then shows."""
    x = F.abs(value)
    e0 = F.greatest(F.least(F.floor(F.log2(x)), F.lit(1023)), F.lit(-1022)).cast("int")
    m0 = x / F.pow(F.lit(2.0), e0)
    # m0 is exact: dividing by a power of two only moves the exponent
    e = F.when(m0 >= 2, e0 + 1).when((m0 < 1) & (e0 > -1022), e0 - 1).otherwise(e0)
    m = F.when(m0 >= 2, m0 / 2).when((m0 < 1) & (e0 > -1022), m0 * 2).otherwise(m0)
    normal = (e + 1023).cast("long") * F.lit(1 << 52) + ((m - 1) * float(1 << 52)).cast("long")
    small = (x * 2.0 ** 537 * 2.0 ** 537).cast("long")
    bits = (F.when(x == 0, F.lit(0).cast("long")).when(x == float("inf"), F.lit(0x7FF << 52).cast("long"))
            .when(x < _LEAST_NORMAL, small).otherwise(normal))
    return F.when(value < 0, -bits).otherwise(bits)


def _ranks(n: Column, probs: Column, interpolated: bool) -> Column:
    """Lower (and upper, to interpolate) rank of every level among ``n`` values, as one array."""
    low = F.transform(probs, lambda p: F.floor((n - 1) * p))
    return F.array_distinct(F.concat(low, F.transform(low, lambda k: F.least(k + 1, n - 1))) if interpolated else low)


def rank_values(df: DataFrame, value: str, probs: Sequence[float], groups: Sequence[str] = (), interpolated: bool = True) -> DataFrame:
    """(groups, _n, _rank, _value): the value at every rank that the levels need, by group."""
    groups = list(groups)
    levels = F.array(*[F.lit(float(p)) for p in probs])
    rows = df.select(*groups, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    # -0.0 and 0.0 are one value
    rows = rows.withColumn("_v", F.when(F.col("_v") == 0, F.lit(0.0)).otherwise(F.col("_v"))).withColumn("_k", ordered_key(F.col("_v")))
    done: DataFrame | None = None
    cells: DataFrame | None = None      # groups, _cell, _base (rows before the cell), _n, _want (ranks in it)

    def at_cells(df: DataFrame, cell: Column, columns: Sequence[str]) -> DataFrame:
        """``df`` with ``columns`` of the cells; the others' names are new, as both sides stem from one frame."""
        right = cells.select(*[F.col(g).alias(f"_of_{g}") for g in groups], F.col("_cell").alias("_of_cell"), *columns)
        return df.join(right, [*[F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in groups], cell == F.col("_of_cell")])
    for bits in range(DIGIT_BITS, KEY_BITS + 1, DIGIT_BITS):
        some = rows.withColumn("_up", F.lit(0).cast("long"))
        if cells is not None:
            some = at_cells(rows, F.shiftright("_k", KEY_BITS - bits + DIGIT_BITS), []).withColumn("_up", F.col("_of_cell"))
        lines = some.groupBy(*groups, "_up", F.shiftright("_k", KEY_BITS - bits).alias("_at")).agg(
            F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
        inner = Window.partitionBy(*groups, "_up").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        if cells is None:
            total = F.sum("_c").over(Window.partitionBy(*groups))
            lines = lines.withColumn("_n", total).withColumn("_base", F.lit(0).cast("long")).withColumn("_want", _ranks(F.col("_n"), levels, interpolated))
        else:
            lines = at_cells(lines, F.col("_up"), ["_n", "_base", "_want"])
        end = F.col("_base") + F.sum("_c").over(inner)
        lines = lines.withColumn("_end", end)
        held = F.filter("_want", lambda k: (k >= F.col("_end") - F.col("_c")) & (k < F.col("_end")))
        found = lines.select(*groups, F.col("_at").alias("_cell"), (F.col("_end") - F.col("_c")).alias("_base"),
                             "_n", held.alias("_want"), "_min", "_max").where(F.size("_want") > 0)
        # without groups there are at most two cells a level
        found = materialize(found) if groups else df.sparkSession.createDataFrame(found.collect(), found.schema)
        sure = found.where("_min = _max").select(*groups, "_n", F.explode("_want").alias("_rank"), F.col("_min").alias("_value"))
        done = sure if done is None else done.unionByName(sure)
        cells = found.where("_min < _max").drop("_min", "_max")
        if cells.isEmpty():
            break
    return done


def _between(low: Column, high: Column, share: Column) -> Column:
    return low + share * (high - low)


def quantiles_by(df: DataFrame, value: str, probs: Sequence[float], groups: Sequence[str]) -> DataFrame:
    """[A11] (groups, n, q): for every group the array of its quantiles, in the order of ``probs``."""
    got = rank_values(df, value, probs, groups).groupBy(*groups).agg(
        F.max("_n").alias("n"), F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_at"))

    def level(p: Column) -> Column:
        h = (F.col("n") - 1) * p
        low = F.floor(h)
        return _between(F.element_at("_at", low), F.element_at("_at", F.least(low + 1, F.col("n") - 1)), h - low)
    return got.select(*groups, "n", F.transform(F.array(*[F.lit(float(p)) for p in probs]), level).alias("q"))


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> list[float | None]:
    """[A11] Exact linear-interpolation quantiles of the non-null values of ``col``; None each if there are none."""
    probs = [float(p) for p in probs]
    got = rank_values(df, col, probs).collect()     # at most two lines a level
    if not got:
        return [None for _ in probs]
    n, at = got[0]._n, {r._rank: r._value for r in got}
    out = []
    for p in probs:
        h = (n - 1) * p
        low = math.floor(h)
        x0, x1 = at[low], at[min(low + 1, n - 1)]
        out.append(x0 + (h - low) * (x1 - x0))
    return out
