"""CSV and parquet readers / writers (sources and sinks of the reference's scripts)."""

from __future__ import annotations

import csv
import io
import os
import shutil
import sys
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickroll.session import scratch_path
from clickroll.sources.quoted_csv import read_csv_text

# Text tokens that the reference's CSV reader turns into missing values.
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _normalise_tokens(col):
    """Whole cells only: a token with blanks around it is text."""
    return F.when(col.isin(*NULL_TOKENS), F.lit(None)).otherwise(col)


def read_events_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """[S1 S2 S3 P8] Headered CSV with the given types, line breaks in quoted cells included.

    Cells are read as text, missing-value tokens become NULL, then values are cast with
    ``try_cast`` so a malformed cell is NULL instead of a failed job. ``row_no`` is the dense
    input position, over several files in order of their paths.
    """
    header, rows = read_csv_text(spark, path)
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise ValueError(f"missing columns in {path}: {missing}")
    return typed(rows, {f.name: f.dataType for f in schema.fields})


def typed(rows: DataFrame, types: dict) -> DataFrame:
    """``row_no`` and the named text columns with tokens as NULL, in the given types."""
    cols = []
    for name, kind in types.items():
        v = _normalise_tokens(F.col(f"`{name}`"))
        if isinstance(kind, str):
            kind = T._parse_datatype_string(kind)
        if not isinstance(kind, T.StringType):
            v = F.trim(v).try_cast(kind)
        cols.append(v.alias(name))
    return rows.select("row_no", *cols)


# How the reference's reader recognises numbers and truth values.
_INTEGER = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*([eE][+-]?[0-9]+)?|\.[0-9]+([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"
_TRUTH = ("True", "TRUE", "true", "False", "FALSE", "false")
#: the least type that holds all cells, by what a column's cells look like
INTEGER, WIDE_INTEGER, DOUBLE, BOOLEAN, TEXT = "bigint", "decimal(20,0)", "double", "boolean", "string"


def column_looks(rows: DataFrame, columns) -> dict[str, dict[str, int]]:
    """Per column how many cells are missing, integers (of 64 bits; unsigned ones), numbers and truth
    values: one aggregate of counts, which add up over splits and files."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        v = _normalise_tokens(F.col(f"`{c}`"))
        integer = v.rlike(_INTEGER)
        wide = F.trim(v).try_cast("decimal(38,0)")
        for kind, hit in (("filled", v.isNotNull()), ("long", integer & F.trim(v).try_cast("bigint").isNotNull()),
                          ("unsigned", integer & (wide >= 0) & (wide < F.lit(str(2 ** 64)).cast("decimal(38,0)"))),
                          ("integer", integer), ("number", v.rlike(_NUMBER)), ("truth", v.isin(*_TRUTH))):
            aggs.append(F.count_if(hit).alias(f"{i}_{kind}"))
    got = rows.agg(*aggs).first().asDict()
    return {c: {"rows": got["_rows"]} | {k: got[f"{i}_{k}"] for k in ("filled", "long", "unsigned", "integer", "number", "truth")}
            for i, c in enumerate(columns)}


def least_type(looks: dict[str, int], keep_integers: bool = False) -> str:
    """The type the reference's reader gives a column: integers with a missing cell become
    doubles (``keep_integers``: stay integers), truth values with one text, and a column
    without any cell doubles."""
    filled, whole = looks["filled"], looks["filled"] == looks["rows"]
    if not filled:
        return DOUBLE
    if looks["truth"] == filled:
        return BOOLEAN if whole else TEXT
    if looks["integer"] == filled:
        if looks["long"] == filled:
            return INTEGER if whole or keep_integers else DOUBLE
        if looks["unsigned"] == filled:
            return WIDE_INTEGER if whole or keep_integers else DOUBLE
        return TEXT if whole else DOUBLE
    return DOUBLE if looks["number"] == filled else TEXT


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """[S1 S4] Headered CSV with the types that the reference's reader infers."""
    header, rows = read_csv_text(spark, path)
    looks = column_looks(rows, header)
    return typed(rows, {c: least_type(looks[c]) for c in header})


def read_feature_table(spark: SparkSession, base: str) -> DataFrame:
    """[S4] Parquet first, CSV (with header) second; raises when neither exists."""
    readers = ((spark.read.parquet, ".parquet"), (lambda path: read_csv_inferred(spark, path).drop("row_no"), ".csv"))
    for read, suffix in readers:
        try:
            return read(base + suffix)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"not found: {base}.parquet or {base}.csv")


def read_features_versioned(spark: SparkSession, folder: str, versions=("v2", "v1")):
    """[S5] The first feature version whose train and test tables both exist."""
    last_err = None
    for v in versions:
        try:
            tr = read_feature_table(spark, f"{folder}/session_features_{v}_train")
            te = read_feature_table(spark, f"{folder}/session_features_{v}_test")
            return v, tr, te
        except FileNotFoundError as e:  # try the next version
            last_err = e
    raise FileNotFoundError(f"no feature version found in {folder}: {last_err}")


def write_feature_table(df: DataFrame, path: str, partition_by=None) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return path


# Timestamp text layout with microseconds (Spark's CSV default keeps milliseconds).
TIMESTAMP_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_events_csv(df: DataFrame, path: str) -> str:
    """[S6] Headered CSV without index; timestamps keep their microseconds."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .option("timestampNTZFormat", TIMESTAMP_TEXT).option("timestampFormat", TIMESTAMP_TEXT)
       .csv(path))
    return path


def write_predictions_csv(pred: DataFrame, path: str, order_col: str = "row_no",
                          columns=("user_session", "session_value")) -> str:
    """[S7] Predictions in template order as a folder of headered files: a range-partitioned
    global sort, so part files are written in order and no single task holds all rows."""
    (pred.orderBy(order_col).select(*columns)
         .write.mode("overwrite").option("header", True).csv(path))
    return path


def _csv_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows as CSV lines in the layout of a single-process writer: shortest form of doubles, a
    missing value is an empty cell, quotes where needed."""
    for b in batches:
        if not b.num_rows:
            continue
        out, lines = io.StringIO(), []
        writer = csv.writer(out, lineterminator="")
        for row in zip(*[["" if x is None or x != x else x for x in c.to_pylist()] for c in b.columns], strict=True):
            writer.writerow(row)
            lines.append(out.getvalue())
            out.seek(0)
            out.truncate()
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])


def _placed(batches: Iterator[pa.RecordBatch], target: str) -> Iterator[pa.RecordBatch]:
    """Copies each part to its offset in the target. A repeated attempt writes the same bytes."""
    for b in batches:
        for source, offset in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            with open(source, "rb") as src, open(target, "r+b") as out:
                out.seek(offset)
                shutil.copyfileobj(src, out, 1 << 20)
                out.flush()
                os.fsync(out.fileno())
        yield pa.RecordBatch.from_arrays([b.column(1)], names=["offset"])


def write_prediction_file(pred: DataFrame, path: str, order_col: str = "row_no",
                          columns=("user_session", "session_value")) -> str:
    """[S7] One prediction file in template order, as a single process would write it.

    Sorted parts are written without a header to the shared scratch folder; their sizes,
    added up, are their offsets. On a shared file system each task copies its parts to
    their offsets in an unseen file beside the target; on HDFS the parts are joined by
    the store's own concatenation. The file gets its name last, so a killed attempt
    leaves nothing under it. Stores that know neither raise NotImplementedError:
    ``write_predictions_csv`` writes ordered parts there.
    """
    spark = pred.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    scheme = fs.getUri().getScheme()
    if scheme not in ("file", "hdfs"):
        raise NotImplementedError(f"no single file on {scheme}: use write_predictions_csv")
    unseen = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part")
    parts_dir = scratch_path(spark, "prediction-parts") if scheme == "file" else f"{unseen.toString()}s"
    rows = pred.orderBy(order_col).select(*columns).mapInArrow(_csv_lines, "value string")
    rows.write.option("lineSep", "\n").text(parts_dir)
    where = jvm.org.apache.hadoop.fs.Path(parts_dir)
    found = where.getFileSystem(conf).globStatus(jvm.org.apache.hadoop.fs.Path(where, "part-*"))
    parts = sorted((f.getPath().toUri().getPath(), f.getLen()) for f in found if f.getLen())
    header = io.StringIO()
    csv.writer(header, lineterminator="\n").writerow(columns)
    head = header.getvalue().encode()
    fs.mkdirs(fs.makeQualified(target).getParent())
    if scheme == "file":
        local = fs.makeQualified(unseen).toUri().getPath()
        offsets, at = [], len(head)
        for source, size in parts:
            offsets.append((source, at))
            at += size
        with open(local, "wb") as out:
            out.write(head)
            out.truncate(at)
        if offsets:
            frame = spark.createDataFrame(offsets, "source string, offset long").repartition(min(len(offsets), 1000))
            done = frame.mapInArrow(partial(_placed, target=local), "offset long").count()
            if done != len(offsets):
                raise OSError(f"{done} of {len(offsets)} parts placed in {path}")
        os.replace(local, fs.makeQualified(target).toUri().getPath())
    else:
        out = fs.create(unseen)
        out.write(bytearray(head))
        out.close()
        if parts:
            kind = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts))
            for i, (source, _) in enumerate(parts):
                kind[i] = jvm.org.apache.hadoop.fs.Path(source)
            fs.concat(unseen, kind)
        fs.delete(target, False)
        fs.rename(unseen, target)
        fs.delete(where, True)
    return path


def read_predictions_csv(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([T.StructField("user_session", T.StringType()),
                           T.StructField("session_value", T.DoubleType())])
    return read_events_csv(spark, path, schema)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
