"""CSV with line breaks inside quotes, read by splits.

Whether a line starts inside a quoted cell depends on everything before it. So each split
of a file is first summarised under both start states, outside and inside quotes: the
state after its last line and the number of records that start in it. A running
composition over the summaries, one line a split, gives every split its true start state
and the position of its first record. A second pass parses: a split owns the records that
start in it and hands over, as pieces, the lines at its front that belong to an earlier
record and those of a last record that goes on. The few pieces are put together by record.

Dialect of the reference's reader: comma, cells quoted by ``"`` at their first character,
``""`` for a quote inside; a quote elsewhere is text, as is what follows a closing quote up to
the comma. Records end at LF, CRLF or a lone CR outside quotes (after a lone CR the
reference's reader loses an empty first cell; this one keeps it). Blank lines (spaces and
tabs count as blank) are no records. Short records end in missing cells. A record with
more cells than the header, headers that differ between files, and a file that ends inside
quotes raise an error. A byte order mark is dropped. Each file starts with a header; a
file without any record gives no rows.

Positions are dense: files in order of their path, records in order of the file.
"""

from __future__ import annotations

import csv
import re
import sys
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickroll.session import scratch_path

_LINE = re.compile(r"[^\r\n]*(?:\r\n|\r|\n)")
_BREAKS = " \t\r\n"


def after(line: str, inside: bool) -> bool:
    """Whether the next line starts inside quotes, if this one starts so or not."""
    at = 0
    if not inside:
        if line[:1] != '"':
            at = line.find(',"')
            if at < 0:
                return False
            at += 1
        at += 1
    while True:
        q = line.find('"', at)
        if q < 0:
            return True
        if line[q + 1:q + 2] == '"':    # a doubled quote
            at = q + 2
            continue
        at = line.find(',"', q + 1)     # closed; the next cell that opens with a quote
        if at < 0:
            return False
        at += 2


def _whole_lines(lines: list[str]) -> list[list[str]]:
    """Records of lines that start and end outside quotes, one a line."""
    return list(csv.reader(x for x in lines if x.strip(_BREAKS)))


def _one_record(lines: list[str]) -> list[str]:
    got = list(csv.reader(lines))
    if len(got) != 1:
        raise ValueError(f"lines do not make one record: {lines[0][:80]!r}")
    return got[0]


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[str], bool]]:
    """(file, block, lines, first): stretches of splits; lines keep their ends, and a lone
    CR ends one too. ``first``: the split was not met before."""
    met = None
    for b in batches:
        if not b.num_rows:
            continue
        codes = b.column(0).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        blocks = b.column(1).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        bounds = [0, *cuts.tolist(), b.num_rows]
        for a, z in zip(bounds, bounds[1:], strict=False):
            key = (b.column(0)[a].as_py(), int(blocks[a]))
            lines = [x + "\n" for x in b.column(2).slice(a, z - a).to_pylist()]
            if key != met and key[1] == 0:
                lines[0] = lines[0].removeprefix("﻿")
            if any("\r" in x[:-2] for x in lines):
                lines = [part for x in lines for part in _LINE.findall(x)]
            yield *key, lines, key != met
            met = key


_SUMMARY = pa.schema([("file", pa.string()), ("block", pa.int64()), ("end_out", pa.bool_()), ("end_in", pa.bool_()),
                      ("n_out", pa.int64()), ("n_in", pa.int64()), ("header", pa.list_(pa.string()))])
SUMMARY = "file string, block long, end_out boolean, end_in boolean, n_out long, n_in long, header array<string>"


def _summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One line a split: its end state and record starts from either start state, and the
    header of the file where the split holds it whole."""
    done: list[dict] = []
    opening: list[str] = []     # lines of the first record, until it ends
    for file, block, lines, first in _splits(batches):
        if first:
            done.append({"file": file, "block": block, "end_out": False, "end_in": True, "n_out": 0, "n_in": 0, "header": None})
            opening = []
        s = done[-1]
        out, inn = s["end_out"], s["end_in"]
        for x in lines:
            if not (out and inn) and x.strip(_BREAKS):
                s["n_out"] += not out
                s["n_in"] += not inn
            if '"' in x:
                before, out, inn = out, after(x, out), after(x, inn)
            else:
                before = out
            if block == 0 and s["header"] is None and (before or x.strip(_BREAKS)):
                opening.append(x)
                if not out:
                    s["header"], opening = _one_record(opening), []
        s["end_out"], s["end_in"] = out, inn
    if done:
        yield pa.RecordBatch.from_pylist(done, _SUMMARY)


def split_states(summaries: DataFrame) -> DataFrame:
    """(file, block, inside, first, ends, records, header): the start state of every split, the
    number in its file of the first record that starts in it, the state after it, and how
    many records start in it.

    A split maps a start state to an end state: a constant, the identity or a swap. The
    state before a split is what the last constant before it gives, swapped as often as
    there are swaps in between; a file starts outside."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)   # one line a split
    through = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    swap = (F.col("end_out") & ~F.col("end_in")).cast("long")
    constant = F.when(F.col("end_out") == F.col("end_in"), F.struct(F.col("end_out").cast("long").alias("to"), F.col("_through").alias("at")))
    s = summaries.withColumn("_before", F.coalesce(F.sum(swap).over(before), F.lit(0))).withColumn("_through", F.sum(swap).over(through))
    s = s.withColumn("_last", F.last(constant, ignorenulls=True).over(before))
    turned = F.col("_before") - F.coalesce(F.col("_last.at"), F.lit(0)) + F.coalesce(F.col("_last.to"), F.lit(0))
    s = s.withColumn("inside", turned % 2 == 1)
    s = (s.withColumn("records", F.when(F.col("inside"), F.col("n_in")).otherwise(F.col("n_out")))
         .withColumn("ends", F.when(F.col("inside"), F.col("end_in")).otherwise(F.col("end_out"))))
    return s.select("file", "block", "inside", F.coalesce(F.sum("records").over(before), F.lit(0)).alias("first"), "ends", "records", "header")


def _batch(records: list[tuple[str, int, list[str]]], pieces: list[tuple[str, int, int, str]], width: int) -> pa.RecordBatch:
    for file, n, cells in records:
        if len(cells) > width:
            raise ValueError(f"{file}: record {n} has {len(cells)} cells, the header has {width}")
    none = [None] * len(pieces)
    text, long = pa.string(), pa.int64()
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in [*records, *pieces]], text), pa.array([r[1] for r in [*records, *pieces]], long),
         pa.array([None] * len(records) + [p[2] for p in pieces], long), pa.array([None] * len(records) + [p[3] for p in pieces], text),
         *[pa.array([r[2][i] if i < len(r[2]) else None for r in records] + none, text) for i in range(width)]],
        names=["file", "n", "block", "piece", *[f"c{i}" for i in range(width)]])


def _kind(width: int) -> str:
    return ", ".join(["file string, n long, block long, piece string", *[f"c{i} string" for i in range(width)]])


def _parsed(batches: Iterator[pa.RecordBatch], states, width: int, header_only: bool = False) -> Iterator[pa.RecordBatch]:
    """Records, numbered in their file, and pieces of records that cross splits. Only the
    lines of one unfinished record are carried from batch to batch. ``header_only``
    gives just the pieces of the first record."""
    csv.field_size_limit(sys.maxsize)
    held: list[str] = []      # lines of the unfinished record
    split, inside, foreign, n = None, False, False, 0
    records: list = []
    pieces: list = []

    def piece(lines: list[str], of: int) -> None:
        if lines and (not header_only or of == 0):
            pieces.append((split[0], of, split[1], "".join(lines)))

    def add(rows: list[list[str]]) -> None:
        nonlocal n
        if not header_only:
            records.extend((split[0], n + i, cells) for i, cells in enumerate(rows))
        n += len(rows)
    for file, block, lines, fresh in _splits(batches):
        if fresh:
            if inside:
                piece(held, n if not foreign else n - 1)
            split, held = (file, block), []
            inside, n = states.value[split]
            foreign = inside      # the front belongs to a record of an earlier split
        at = 0
        for i, x in enumerate(lines):
            if '"' not in x:
                continue
            was, inside = inside, after(x, inside)
            if inside and not was:        # a record goes on after this line
                add(_whole_lines(lines[at:i]))
                at = i
            elif was and not inside:      # and here it ends
                whole, held = held + lines[at:i + 1], []
                if foreign:
                    piece(whole, n - 1)
                    foreign = False
                else:
                    add([_one_record(whole)])
                at = i + 1
        if inside:
            held += lines[at:]
        else:
            add(_whole_lines(lines[at:]))
        if records or pieces:
            yield _batch(records, pieces, width)
            records, pieces = [], []
    if inside:
        piece(held, n if not foreign else n - 1)
    if pieces:
        yield _batch([], pieces, width)


def _stitched(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    csv.field_size_limit(sys.maxsize)
    for b in batches:
        got = zip(*[b.column(i).to_pylist() for i in range(3)], strict=True)
        yield _batch([(file, n, _one_record(_LINE.findall(text))) for file, n, text in got], [], width)


def _joined(pieces: DataFrame) -> DataFrame:
    """The pieces of each record in order of their splits."""
    return (pieces.groupBy("file", "n").agg(F.array_sort(F.collect_list(F.struct("block", "piece"))).alias("p"))
            .select("file", "n", F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("text")))


def read_csv_text(spark: SparkSession, path) -> tuple[list[str], DataFrame]:
    """(header, rows): rows have ``row_no``, the dense input position, and the header's columns
    as text, missing where a record is short.

    The rows are written once to the shared scratch folder, where consumers prune columns.
    Each task gets the start states of all splits (one line a split: 400,000 for 100 TB
    in splits of 256 MB).
    """
    # the separator is named, so that CR stays in the line
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"))
    table = scratch_path(spark, "csv-splits")
    split_states(lines.mapInArrow(_summarised, SUMMARY)).write.parquet(table)
    states = spark.read.parquet(table)
    unclosed = states.groupBy("file").agg(F.max_by("ends", "block").alias("open")).where("open").first()
    if unclosed:
        raise ValueError(f"{unclosed.file} ends inside quotes")
    held = spark.sparkContext.broadcast({(r.file, r.block): (r.inside, r.first)
                                         for r in states.select("file", "block", "inside", "first").toLocalIterator()})
    heads = [r.header for r in states.where("header IS NOT NULL").select("header").distinct().limit(2).collect()]
    crossing = states.groupBy("file").agg(F.sum("records").alias("n"), F.count("header").alias("h")).where("n > 0 AND h = 0")
    if not crossing.isEmpty():    # headers that cross splits
        cut = lines.mapInArrow(partial(_parsed, states=held, width=0, header_only=True), _kind(0))
        heads += [next(csv.reader(_LINE.findall(r.text))) for r in _joined(cut).select("text").distinct().limit(2).collect()]
    if len({tuple(h) for h in heads}) != 1:
        raise ValueError(f"headers differ: {heads[:2]}" if heads else f"no header in {path}")
    header, width = heads[0], len(heads[0])
    out = scratch_path(spark, "csv-rows")
    lines.mapInArrow(partial(_parsed, states=held, width=width), _kind(width)).write.parquet(out)
    rows = spark.read.schema(_kind(width)).parquet(out)
    whole = _joined(rows.where("piece IS NOT NULL")).mapInArrow(partial(_stitched, width=width), _kind(width))
    rows = rows.where("piece IS NULL").unionByName(whole).where("n > 0")      # record 0 is the header
    sizes = states.groupBy("file").agg(F.greatest(F.sum("records") - 1, F.lit(0)).alias("size"))
    earlier = F.sum("size").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))   # one line a file
    offsets = sizes.select("file", F.coalesce(earlier, F.lit(0)).alias("before"))
    row_no = (F.col("before") + F.col("n") - 1).alias("row_no")
    return header, rows.join(offsets, "file").select(row_no, *[F.col(f"c{i}").alias(name) for i, name in enumerate(header)])


cloudpickle.register_pickle_by_value(sys.modules[__name__])
