"""Regular-expression spans in SQL functions: all leftmost non-overlapping matches of a
pattern with their positions in code points.

``split`` gives the text between matches and ``regexp_extract_all`` the matches; walking
both together gives each match's start. Only accepted matches are kept on the way, so the
walk is linear in the matches. Patterns start with ``(?:(?<![class])|\\G)`` where a failed
start could be retried inside the same run of characters: a run fails or matches as a
whole, and a text of one long run stays linear.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import let

#: what a span is: start and end in code points (end exclusive), kind, score
SPAN = "struct<start:int,end:int,kind:string,score:double>"
NONE = f"array<{SPAN}>"


def none() -> Column:
    return F.array().cast(NONE)


def spans(text: Column, pattern: str, kind: str, accept: Callable[[Column], Column],
          score: Callable[[Column, Column, Column], Column], may: Column | None = None, around: int = 48) -> Column:
    """Accepted matches as an array of SPAN. ``score`` gets the match and the ``around``
    code points before and after it. ``may`` is a cheap test that no match can fail."""
    rx = F.lit(pattern)

    def walk(parts: Column) -> Column:
        between, found = parts["between"], parts["found"]
        # one more piece than matches: the i-th match has piece i before and i + 1 after it
        sides = F.zip_with(F.slice(between, 1, F.size(found)), F.slice(between, 2, F.size(found)),
                           lambda a, b: F.struct(a.alias("before"), b.alias("after")))
        steps = F.zip_with(sides, found, lambda side, m: F.struct(
            side["before"].alias("before"), m.alias("match"), side["after"].alias("after")))

        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + F.length(x["before"])
            end = start + F.length(x["match"])
            span = F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), score(
                x["match"], F.right(x["before"], F.lit(around)), F.left(x["after"], F.lit(around))).alias("score"))
            return F.struct(end.alias("at"), F.when(accept(x["match"]), F.concat(acc["out"], F.array(span).cast(NONE)))
                            .otherwise(acc["out"]).alias("out"))

        first = F.struct(F.lit(0).alias("at"), none().alias("out"))
        return F.aggregate(steps, first, step, lambda acc: acc["out"])

    def parts() -> Column:
        return F.struct(F.split(text, pattern, -1).alias("between"),
                        F.regexp_extract_all(text, rx, F.lit(0)).alias("found"))

    some = let(parts(), walk)
    return F.when(may, some).otherwise(none()) if may is not None else some


def headed(text: Column, pattern: str, head: int, kind: str, length: Callable[[Column], Column],
           score: Callable[[Column, Column, Column], Column], may: Column, around: int = 48) -> Column:
    """Spans whose end a check chooses. A match of ``pattern`` is the first ``head`` code points
    of a proposal; its group 1, in a lookahead, is the proposal and ``around`` code points more.
    ``length`` gets the group and says how many code points are the span, null if none. So
    what follows a span is proposed anew; of overlapping spans the first one stays."""
    def walk(parts: Column) -> Column:
        steps = F.zip_with(F.slice(parts["between"], 1, F.size(parts["found"])), parts["found"],
                           lambda a, m: F.struct(a.alias("before"), m.alias("match")))

        def step(acc: Column, x: Column) -> Column:
            def taken(y: Column) -> Column:
                end = y["start"] + y["n"]
                span = F.struct(y["start"].alias("start"), end.alias("end"), F.lit(kind).alias("kind"), score(
                    F.left(x["match"], y["n"]), F.right(x["before"], F.lit(around)),
                    F.substring(x["match"], y["n"] + 1, F.lit(around))).alias("score"))
                new = F.coalesce((y["start"] >= acc["until"]) & (y["n"] > 0), F.lit(False))
                return F.struct((y["start"] + head).alias("at"), F.when(new, end).otherwise(acc["until"]).alias("until"),
                                F.when(new, F.concat(acc["out"], F.array(span).cast(NONE))).otherwise(acc["out"]).alias("out"))

            return let(F.struct((acc["at"] + F.length(x["before"])).alias("start"), length(x["match"]).alias("n")), taken)

        first = F.struct(F.lit(0).alias("at"), F.lit(0).alias("until"), none().alias("out"))
        return F.aggregate(steps, first, step, lambda acc: acc["out"])

    parts = F.struct(F.split(text, pattern, -1).alias("between"), F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("found"))
    return F.when(may, let(parts, walk)).otherwise(none())


def joined(spans_: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count(spans_: Column, kind: str) -> Column:
    return F.size(F.filter(spans_, lambda s: s["kind"] == kind)).cast("long")


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def masked(text: Column, spans_: Column) -> Column:
    """The text with every stretch that spans cover replaced by ``[KIND]`` of the stretch's
    first span; overlapping spans make one stretch."""
    def merge(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        # acc is never empty: it starts with a stretch of length 0
        return F.when(s["start"] < last["end"], F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))))
        ).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))))

    zero = F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("").alias("kind")))
    stretches = F.aggregate(F.array_sort(spans_), zero, merge)

    def build(st: Column) -> Column:
        n = F.size(st)
        return F.concat(
            F.array_join(F.zip_with(F.slice(st, 1, n - 1), F.slice(st, 2, n), lambda a, b: F.concat(
                F.substring(text, a["end"] + 1, b["start"] - a["end"]), F.lit("["), F.upper(b["kind"]), F.lit("]"))), ""),
            F.substring(text, F.element_at(st, -1)["end"] + 1, F.length(text)))

    return F.when(F.size(spans_) == 0, text).otherwise(let(stretches, build))
