"""Quality rules as a short-circuit cascade, in SQL functions.

Base counts of a text, words being ``[^\\x20\\x09-\\x0D]+``: n_words, word_chars, n_symbols
(characters of ``[#*$%&|<>]``), n_dup_lines (lines with a word that equal an earlier line),
n_repeat_words (words in 3-word windows that occur twice or more, the first included).

Rules say when a text is rejected. On a sample each rule's selectivity is counted and its
cost timed; rules are then tried in the order of rejections per cost, and ``CASE`` stops
at the first that rejects, so an expensive count is made only for texts that are still in.
The order changes the work, never the verdict: a text is kept if no rule rejects it.

Edge cases: a missing or empty text has no words and fails. Very long texts sort their
windows in one row's array. Equal texts get equal verdicts; ties in the order go by name.
Empty input: empty result, rules in the given order.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, let, split_words, stored, text_of

SYMBOLS = "[^#*$%&|<>]+"
#: expected rows of the sample that orders the rules
SAMPLE_ROWS = 1000


def count_words(text: Column) -> Column:
    return F.size(split_words(text)).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, SPACES, "")).cast("long")


def symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def dup_lines(text: Column) -> Column:
    return let(_lines(text), lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))


def repeat_words(text: Column) -> Column:
    """Windows are sorted with their positions, so equal ones are neighbours; the positions
    of those with an equal neighbour are sorted, and each adds the words not yet covered."""
    def windows(words: Column) -> Column:
        n = F.greatest(F.size(words) - 2, F.lit(0))
        two = F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.zip_with(two, F.slice(words, 3, n), lambda a, b: F.concat(a, F.lit(" "), b))

    def hits(sorted_: Column) -> Column:
        """Positions of windows that equal the next or the one before, nulls for others."""
        same = F.zip_with(sorted_, F.slice(sorted_, 2, F.size(sorted_)),
                          lambda a, b: F.coalesce(a["w"] == b["w"], F.lit(False)))
        pairs = let(same, lambda e: F.zip_with(e, F.concat(F.array(F.lit(False)), F.slice(e, 1, F.size(e) - 1)),
                                               lambda after, before: after | before))
        return F.zip_with(sorted_, pairs, lambda x, hit: F.when(hit, x["at"]))

    def covered(places: Column) -> Column:
        before = F.concat(F.array(F.lit(-3)), F.slice(places, 1, F.greatest(F.size(places) - 1, F.lit(0))))
        return F.aggregate(F.zip_with(places, before, lambda at, last: F.least(F.lit(3), at - last)),
                           F.lit(0).cast("long"), lambda acc, x: acc + x)

    def some(w: Column) -> Column:
        # only a text with equal windows needs the sort
        numbered = F.transform(w, lambda x, i: F.struct(x.alias("w"), i.alias("at")))
        places = let(F.sort_array(numbered), lambda z: F.array_sort(F.filter(hits(z), lambda p: p.isNotNull())))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(let(places, covered))

    return let(split_words(text), lambda words: let(windows(words), some))


#: counts that rules speak of, cheapest form of each
COUNTS: dict[str, Callable[[Column], Column]] = {
    "n_words": count_words, "word_chars": word_chars, "n_symbols": symbols, "n_dup_lines": dup_lines,
    "n_repeat_words": repeat_words,
    "n_lines": lambda t: F.size(_lines(t)).cast("long"),
    "n_shouted": lambda t: F.length(F.regexp_replace(t, "[^A-Z!]+", "")).cast("long"),
}


@dataclass(frozen=True)
class Rule:
    name: str
    counts: tuple[str, ...]
    #: from columns or expressions of those counts to "rejected"
    rejects: Callable[..., Column]


RULES = (
    Rule("too_few_words", ("n_words",), lambda n: n < 50),
    Rule("repeated_words", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 50 * n),
    Rule("word_length", ("word_chars", "n_words"), lambda c, n: (c < 2 * n) | (c > 15 * n)),
    Rule("symbols", ("n_symbols", "n_words"), lambda s, n: 10 * s > n),
    Rule("duplicate_lines", ("n_dup_lines", "n_lines"), lambda d, n: 10 * d > 3 * n),
    Rule("shouting", ("n_shouted", "word_chars"), lambda u, c: 2 * u > c),
)


def rule_order(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text",
               sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names by rejections per cost on a sample of about ``sample_rows`` texts."""
    n = docs.count()
    if not n:
        return [r.name for r in rules]
    sample = stored(docs.select(text_of(text_col).alias("text")).sample(min(1.0, sample_rows / n), seed=7), "rule-sample")
    ranked = []
    for r in rules:
        start = time.perf_counter()
        rejected = sample.agg(F.count_if(r.rejects(*[COUNTS[c](F.col("text")) for c in r.counts]))).first()[0]
        ranked.append((-rejected / max(1e-6, time.perf_counter() - start), r.name))
    return [name for _, name in sorted(ranked)]


def verdict(order: Sequence[str], counts: dict[str, Column], rules: Sequence[Rule] = RULES) -> Column:
    """Name of the first rule in ``order`` that rejects, null if none does."""
    by_name = {r.name: r for r in rules}
    out = None
    for name in order:
        hit = by_name[name].rejects(*[counts[c] for c in by_name[name].counts])
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text",
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows with ``rejected_by`` added; counts are made as the cascade gets to them."""
    counts = {c: f(text_of(text_col)) for c, f in COUNTS.items()}
    return docs.withColumn("rejected_by", verdict(rule_order(docs, rules, text_col, sample_rows), counts, rules))
