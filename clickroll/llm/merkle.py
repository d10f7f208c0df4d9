"""Document fingerprints: a Merkle tree over sections and paragraphs, in SQL functions.

Sections are cut at ``\\n\\n``, their paragraphs at ``\\n``. A paragraph's node is the SHA-256 of its
text, a section's that of its paragraphs' nodes, the root that of the sections' nodes.
Both cuts can be undone, so equal roots mean equal texts, and the first branch whose
nodes differ says where an edit is. To compare paragraphs that differ, each also keeps a
32-bit hash of its parts: runs of up to PART_WORDS words that end with a sentence; a
long run without white space is cut by its content.
Likeness is 1 for equal roots, else twice the parts in both over the parts of either,
each part as often as it occurs.

Neighbours: the next document by id, the first after the last. Ids go through a range
shuffle of narrow rows; texts move once by id, and the next text's prefix and parts once.

Edge cases: a missing or empty text is one section with one empty paragraph. Rows of one
id are ordered by a hash of the text, missing ids come last; equal rows follow each other.
A single document is its own neighbour. Empty input: empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import let, stored, text_of

PART_WORDS = 8
#: a run without white space of more than LONG code points is cut by content: after LEAST code
#: points behind the first one of _CUT (about one in 16 of most scripts), else after LONG
LONG, LEAST = 64, 16
_GAP, _INK = r"[\s\p{Z}]", r"[^\s\p{Z}]"
_CUT = ("[.,;:!?05AGMSYekqw\u3001\u3002\uFF01\uFF0C\uFF1A\uFF1B\uFF1F\u306B\u306E\u306F\u3092\u30CE\u30F3\u30FC"
        + "".join(rf"\x{{{c:X}}}-\x{{{c + 31:X}}}" for c in range(0x220, 0xD800, 0x200)) + "]")
_WORD = rf"{_INK}{{1,{LONG}}}+(?!{_INK})"
_PIECE = rf"{_INK}{{{LEAST},{LONG - 1}}}?{_CUT}|{_INK}{{{LONG}}}|{_INK}++"
#: words up to a sentence's end or PART_WORDS of them; white space belongs to the part
_PART = rf"{_GAP}*+(?:{_WORD}(?<![.!?]){_GAP}++){{0,{PART_WORDS - 1}}}(?:{_WORD}|{_PIECE})|{_GAP}++"


def tree(text: Column) -> Column:
    """array<section struct<node, paragraphs array<struct<node, parts array<int>>>>>"""
    def paragraph(p: Column) -> Column:
        parts = F.transform(F.regexp_extract_all(p, F.lit(_PART), F.lit(0)), lambda x: F.hash(x))
        return F.struct(F.sha2(p, 256).alias("node"), parts.alias("parts"))

    def section(s: Column) -> Column:
        return let(F.transform(F.split(s, "\n"), paragraph), lambda ps: F.struct(
            F.sha2(F.array_join(F.transform(ps, lambda p: p["node"]), ""), 256).alias("node"), ps.alias("paragraphs")))

    return F.transform(F.split(text, "\n\n"), section)


def root(tree_: Column) -> Column:
    return F.sha2(F.array_join(F.transform(tree_, lambda s: s["node"]), ""), 256)


def parts(tree_: Column) -> Column:
    """Hashes of all parts, sorted; one that repeats is there as often."""
    return F.sort_array(F.flatten(F.transform(tree_, lambda s: F.flatten(F.transform(
        s["paragraphs"], lambda p: p["parts"])))))


def occurrences(parts_: Column) -> Column:
    """Each hash of a sorted array with its occurrence number, as one distinct long."""
    def numbered(p: Column) -> Column:
        starts = F.filter(F.transform(p, lambda x, i: F.when((i == 0) | (F.get(p, i - 1) != x), i)), lambda i: i.isNotNull())
        return F.flatten(let(starts, lambda at: F.zip_with(
            at, F.concat(F.slice(at, 2, F.size(at)), F.array(F.size(p))), lambda a, b: F.transform(
                F.sequence(F.lit(0), b - a - 1), lambda k: F.shiftleft(F.get(p, a).cast("long"), 32) + k))))

    return F.when(F.size(parts_) == 0, F.array().cast("array<long>")).otherwise(let(parts_, numbered))


def likeness(root_a: Column, parts_a: Column, root_b: Column, parts_b: Column) -> Column:
    both = F.size(F.array_intersect(occurrences(parts_a), occurrences(parts_b)))
    return F.when(root_a == root_b, F.lit(1.0)).otherwise(
        F.coalesce(2.0 * both / F.nullif(F.size(parts_a) + F.size(parts_b), F.lit(0)), F.lit(0.0)))


def first_difference(a: Column, b: Column) -> Column:
    """``section.paragraph`` (from 0) of the first branch that differs, null if none does."""
    def different(x: Column, y: Column) -> Column:
        return ~x["node"].eqNullSafe(y["node"])

    def below(i: Column) -> Column:
        p = F.zip_with(F.coalesce(F.get(a, i)["paragraphs"], F.array()), F.coalesce(F.get(b, i)["paragraphs"], F.array()), different)
        return F.concat_ws(".", i.cast("string"), (F.array_position(p, F.lit(True)) - 1).cast("string"))

    return let(F.array_position(F.zip_with(a, b, different), F.lit(True)).cast("int") - 1,
               lambda i: F.when(i >= 0, below(i)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, tree) of every row."""
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), tree(text_of(text_col)).alias("tree"))
            .select("doc_id", root(F.col("tree")).alias("fingerprint"), "tree"))


def _followed(keys: DataFrame) -> DataFrame:
    """Each row of (doc_id, row_key, n_chars) with next_id and next_key: the row after it by
    (doc_id, row_key), the first after the last."""
    spark = keys.sparkSession
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_key")]
    dealt = stored(keys.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
                   .withColumn("part", F.spark_partition_id()), "ordered-ids")
    counts = dealt.groupBy("part").agg(F.count("*").alias("rows"))
    ahead = F.coalesce(F.sum("rows").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    numbered = (dealt.withColumn("row", F.row_number().over(W.partitionBy("part").orderBy(*order)))
                .join(F.broadcast(counts.select("part", ahead.alias("ahead"))), "part")  # a line a partition
                .select("doc_id", "row_key", "n_chars", (F.col("ahead") + F.col("row") - 1).alias("pos")))
    numbered = stored(numbered, "numbered-ids")
    n = numbered.count()
    after = numbered.select(F.pmod(F.col("pos") - 1, F.lit(max(1, n))).alias("pos"),
                            F.col("doc_id").alias("next_id"), F.col("row_key").alias("next_key"))
    return numbered.join(after, "pos")


def edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row against its next document and against its edited text, whose last quarter
    is replaced by as much of the next document's start."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    texts = texts.select("doc_id", F.xxhash64("text").alias("row_key"), "text")
    keys = stored(texts.select("doc_id", "row_key", F.length("text").alias("n_chars")), "text-keys")
    followed = stored(_followed(keys), "followed-ids")
    if not keys.groupBy("doc_id", "row_key").count().where("count > 1").isEmpty():
        texts = texts.dropDuplicates(["doc_id", "row_key"])  # equal rows are told apart by their place in the order
    other = followed.select("pos", F.col("doc_id").alias("own_id"), F.col("row_key").alias("own_key"), "n_chars",
                            "next_id", "next_key")
    sent = texts.join(other, F.col("doc_id").eqNullSafe(F.col("next_id")) & (F.col("row_key") == F.col("next_key")))
    sent = (sent.select("own_id", "own_key", "n_chars", "next_id", tree(F.col("text")).alias("next_tree"),
                        F.left("text", F.floor(F.col("n_chars") / 4).cast("int")).alias("prefix"))
            .select("own_id", "own_key", "n_chars", "next_id", "prefix", root(F.col("next_tree")).alias("next_root"),
                    parts(F.col("next_tree")).alias("next_parts")))
    rows = texts.join(sent, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("row_key") == F.col("own_key")))
    kept = F.left("text", (F.col("n_chars") - F.floor(F.col("n_chars") / 4)).cast("int"))
    rows = rows.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), "next_id", "next_root", "next_parts",
                       tree(F.col("text")).alias("a"), F.concat(kept, F.col("prefix")).alias("edited"))
    rows = rows.select("doc_id", "n_chars", "next_id", "next_root", "next_parts", "a", F.sha2("edited", 256).alias("edited_sha256"),
                       tree(F.col("edited")).alias("b"))
    rows = rows.select("*", root(F.col("a")).alias("fingerprint"), root(F.col("b")).alias("edited_fingerprint"),
                       parts(F.col("a")).alias("pa"), parts(F.col("b")).alias("pb"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("pa"), F.col("edited_fingerprint"), F.col("pb")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("pa"), F.col("next_root"), F.col("next_parts")).alias("near_next"),
        "next_id", first_difference(F.col("a"), F.col("b")).alias("edited_from"))
