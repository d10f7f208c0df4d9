"""Secret scans: a battery of randomness tests as a veto, and false-discovery control, in SQL.

Base kinds, leftmost non-overlapping: assign (a name like ``password``, ``=`` or ``:`` and
six or more characters), access (``AKIA`` and 16 or more), hex (24 or more of
``[0-9a-f]``). The method adds kind random: runs of 20 or more base-64 characters
that have a digit or a capital after a small letter and lie in no base span.

The encoding of a candidate is the smallest alphabet that holds it (hex of either case, base
32, base 36 of either case, base 62, base 64). Under the hypothesis that it is random in that alphabet it takes a chi-squared
test of uniformity, a runs test about the alphabet's middle and a lag-one serial
correlation test; one that is rejected (Bonferroni over the three, at the fixed level
REJECT) is no secret. This veto is not under false-discovery control: its probabilities
are spread evenly for secrets and small for ordinary names, so a step-up over them would
discover the names. What the control needs is a probability under the hypothesis that
a candidate is an ordinary identifier: the tail of its changes between small letters,
capitals, digits and signs, of which ordinary ones have few. Base 32 has one case and few
digits, so changes tell little; there the rarity of its letters in prose counts as
much. These probabilities of all candidates of the corpus go, by length class
(doubling lengths), through the Benjamini-Hochberg step-up at rate ``q``: a short
candidate competes with short ones.

Edge cases: missing or empty text: no spans. Equal texts get equal spans. Very long runs
cost linear time. No candidates: nothing is added. Empty input: empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import spans as S
from .common import let, stored, text_of

BASE = ("assign", "access", "hex")
PATTERNS = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}+",
    "hex": r"[0-9a-f]{24,}+",
}
_RUN = "A-Za-z0-9+/_-"
RANDOM = rf"(?<![{_RUN}])(?=[A-Za-z+/_-]*+[0-9]|[A-Z0-9+/_-]*+[a-z+/_-]++[A-Z])[{_RUN}]{{20,}}+"
HEX, B32, B36 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789abcdefghijklmnopqrstuvwxyz"
B62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
B64 = B62 + "+/"
#: patterns of the encodings, smallest alphabet first
ENCODINGS = (("[0-9a-f]", HEX), ("[0-9A-F]", HEX.upper()), ("[A-Z2-7]", B32), ("[0-9a-z]", B36), ("[0-9A-Z]", B36.upper()), ("[0-9A-Za-z]", B62))
#: level at which the battery rejects randomness, false-discovery rate, and the share of
#: neighbouring characters of ordinary identifiers that are of two classes
REJECT, RATE, CHANGES = 0.001, 0.01, 0.12
#: shares of a to z in English, French, German and Spanish prose (rounded mean, at least 10),
#: each letter's surprise less its mean in prose, and the variance of that
SHARES = (85, 16, 32, 45, 140, 14, 19, 30, 68, 10, 10, 45, 28, 76, 61, 19, 10, 66, 74, 68, 40, 12, 11, 10, 10, 10)
_MEAN = sum(-s * math.log(s / sum(SHARES)) for s in SHARES) / sum(SHARES)
SURPRISE = [-math.log(s / sum(SHARES)) - _MEAN for s in SHARES]
VARIANCE = sum(s * x * x for s, x in zip(SHARES, SURPRISE, strict=True)) / sum(SHARES)
CANDIDATE = "struct<start:int,end:int,class:int,random:boolean,bin:int>"


def upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal: a rational approximation times the density, good in
    relative terms far out in the tail."""
    x = F.abs(z)
    t = 1 / (1 + x * 0.2316419)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = poly * F.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _alphabet(token: Column) -> Column:
    return F.coalesce(*[F.when(token.rlike(f"^{one}+$"), F.lit(alphabet)) for one, alphabet in ENCODINGS], F.lit(B64))


def battery(token: Column) -> Column:
    """struct<p_uniform, p_runs, p_serial, p_ordinary> of a run of base-64 characters."""
    plain = F.translate(token, "-_", "+/")

    def tests(x: Column) -> Column:
        n, k = F.size(x["v"]).cast("double"), F.length(x["alphabet"]).cast("double")
        squares = F.aggregate(F.array_distinct(x["v"]), F.lit(0.0), lambda acc, c: acc + F.pow(
            F.length(x["token"]) - F.length(F.replace(x["token"], F.substring(x["alphabet"], c + 1, F.lit(1)))), 2))
        chi, df = squares * k / n - n, k - 1
        cube = (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        ones = F.size(F.filter(x["v"], lambda c: c * 2 >= k)).cast("double")
        zeros = n - ones
        runs = 1 + F.aggregate(F.zip_with(F.slice(x["v"], 1, F.size(x["v"]) - 1), F.slice(x["v"], 2, F.size(x["v"])), lambda a, b: F.when(
            (a * 2 >= k) != (b * 2 >= k), 1.0).otherwise(0.0)), F.lit(0.0), lambda acc, c: acc + F.coalesce(c, F.lit(0.0)))
        mean_runs = 1 + 2 * ones * zeros / n
        var_runs = F.greatest((mean_runs - 1) * (mean_runs - 2) / (n - 1), F.lit(1e-9))
        # sums only: a mean inside a lambda would be computed again for each character
        total = F.aggregate(x["v"], F.lit(0.0), lambda acc, c: acc + c)
        squared = F.aggregate(x["v"], F.lit(0.0), lambda acc, c: acc + c * c)
        next_to = F.aggregate(F.zip_with(F.slice(x["v"], 1, F.size(x["v"]) - 1), F.slice(x["v"], 2, F.size(x["v"])), lambda a, b: a * b),
                              F.lit(0.0), lambda acc, c: acc + F.coalesce(c, F.lit(0)))
        mean = total / n
        ends = F.element_at(x["v"], 1) + F.element_at(x["v"], -1)
        cov = next_to - mean * (2 * total - ends) + (n - 1) * mean * mean
        var = squared - n * mean * mean
        serial = F.when(var > 1e-9, cov / F.greatest(var, F.lit(1e-9))).otherwise(1.0) * F.sqrt(n) + 1 / F.sqrt(n)
        kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
            x["token"], "[a-z]+", "\u0001"), "[A-Z]+", "\u0002"), "[0-9]+", "\u0003"), "[+/]+", "\u0004")
        changes = F.length(kinds) - 1
        usual = (changes - 0.5 - (n - 1) * CHANGES) / F.sqrt((n - 1) * CHANGES * (1 - CHANGES))
        # in base 32 the letters are the values below 26
        letters = F.greatest(F.size(F.filter(x["v"], lambda c: c < 26)), F.lit(1))
        surprise = F.aggregate(x["v"], F.lit(0.0), lambda acc, c: acc + F.coalesce(F.get(F.array(*map(F.lit, SURPRISE)), c), F.lit(0.0)))
        usual = F.when(x["alphabet"] == B32, (usual + surprise / F.sqrt(letters * VARIANCE)) / math.sqrt(2)).otherwise(usual)
        return F.struct(upper_tail(cube).alias("p_uniform"), (2 * upper_tail(F.abs((runs - mean_runs) / F.sqrt(var_runs)))).alias("p_runs"),
                        (2 * upper_tail(F.abs(serial))).alias("p_serial"), upper_tail(usual).alias("p_ordinary"))

    def values(t: Column) -> Column:
        return let(F.struct(t.alias("token"), _alphabet(t).alias("alphabet")), lambda x: F.struct(
            x["token"].alias("token"), x["alphabet"].alias("alphabet"), F.transform(
                F.filter(F.split(x["token"], ""), lambda c: c != ""), lambda c: F.instr(x["alphabet"], c) - 1).alias("v")))

    return let(let(plain, values), tests)


def _base(text: Column) -> Column:
    def kept(kind: str):
        if kind != "assign":
            return lambda m: F.lit(True)
        return lambda m: F.length(F.regexp_extract(m, PATTERNS["assign"], 2)) >= 6

    may = {"assign": text.rlike("(?i)pass|secret|token|api"), "access": F.contains(text, F.lit("AKIA")), "hex": text.rlike("[0-9a-f]{24}")}
    each = [S.spans(text, PATTERNS[k], k, kept(k), lambda m, a, b: F.lit(1.0), may[k]) for k in BASE]
    rank = F.array(*[F.lit(k) for k in BASE])
    ranked = F.transform(F.concat(*each), lambda s: F.struct(
        s["start"].alias("start"), F.array_position(rank, s["kind"]).alias("rank"), s.alias("span")))
    return F.transform(F.array_sort(ranked), lambda x: x["span"])


def _candidates(text: Column, base: Column) -> Column:
    """Candidates outside base spans, with length class, battery's verdict and the tail
    probability in tenths of a decade."""
    # the score slot carries the verdict: bin, negative if the battery rejects randomness
    def score(m: Column, before: Column, after: Column) -> Column:
        def verdict(t: Column) -> Column:
            least = F.least(t["p_uniform"], t["p_runs"], t["p_serial"])
            bin_ = F.floor(-10 * F.log10(F.greatest(t["p_ordinary"], F.lit(1e-300)))).cast("double")
            return F.when(3 * least >= REJECT, bin_).otherwise(F.lit(-1.0))
        return let(battery(m), verdict)

    found = S.spans(text, RANDOM, "random", lambda m: F.lit(True), score, text.rlike(RANDOM))
    free = F.filter(found, lambda s: ~F.exists(base, lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))
    return F.transform(free, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.floor(F.log2((s["end"] - s["start"]) / 20.0)).cast("int").alias("class"),
        (s["score"] >= 0).alias("random"), F.greatest(s["score"], F.lit(0.0)).cast("int").alias("bin")).cast(CANDIDATE))


def step_up(bins: DataFrame, rate: float = RATE) -> DataFrame:
    """(class, bar) from (class, random, bin): Benjamini-Hochberg within a class. A bin holds
    probabilities up to 10 ** (-bin / 10); from the bar on candidates are discoveries.
    One line a class and bin: at most 3,000 bins of a length class."""
    counts = bins.groupBy("class", "random", "bin").agg(F.count("*").alias("n"))
    down = W.partitionBy("class").orderBy(F.col("random").desc(), F.col("bin").desc())
    ranked = counts.select("class", "random", "bin", F.sum("n").over(down).alias("rank"),
                           F.sum("n").over(W.partitionBy("class")).alias("all"))
    good = ranked.where(F.col("random") & (F.pow(F.lit(10.0), -F.col("bin") / 10.0) <= F.col("rank") * rate / F.col("all")))
    return good.groupBy("class").agg(F.min("bin").alias("bar"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """(doc_id, base, found) of every row: base spans by start, and all spans by start."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.select("doc_id", "text", _base(F.col("text")).alias("base"))
    rows = stored(rows.select("doc_id", "base", _candidates(F.col("text"), F.col("base")).alias("candidates")), "secret-candidates")
    bars = step_up(rows.select(F.explode("candidates").alias("c")).select("c.class", "c.random", "c.bin"), rate)
    bars = stored(bars.select(F.col("class").alias("c"), "bar"), "secret-bars")
    known = bars.agg(F.map_from_entries(F.collect_list(F.struct("c", "bar"))).alias("bars")).scalar()  # a line a length class
    rows = rows.withColumn("bars", known)
    added = F.transform(F.filter("candidates", lambda c: c["random"] & F.coalesce(c["bin"] >= F.try_element_at(F.col("bars"), c["class"]), F.lit(False))),
                        lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), F.lit("random").alias("kind"), F.lit(0.9).alias("score")).cast(S.SPAN))
    # base spans keep their order; an added span never starts where a base span does
    both = F.array_sort(F.transform(F.concat(F.col("base"), added), lambda s: F.struct(
        s["start"].alias("start"), F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(k) for k in BASE]), s["kind"]), F.lit(0)), F.lit(9)).alias("rank"), s.alias("span"))))
    return rows.select("doc_id", "base", F.transform(both, lambda x: x["span"]).alias("found"))
