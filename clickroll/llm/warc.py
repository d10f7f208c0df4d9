"""WARC archives: a writer with revisit records and a splittable reader.

Writer: one gzip member a record, one file a task. A payload that occurs again (at least
``least_bytes`` long) is stored once, with the largest page id; the others are revisit
records that name it. A task's file carries its attempt, and only files in the manifest
that the job committed are read, so a lost executor or a second attempt does no harm.

Reader: tasks get byte ranges, scan them for the gzip magic, and take a candidate for a
member if it decodes to a WARC header whose length fits. A task owns the members that
start in its range and reads the last one beyond the range's end.

Files go through Arrow's file systems under the shared folder. Edge cases: missing html is an
empty payload; a missing url is left out; missing ids come back missing, and count as
smallest. Rows with equal id and payload are all responses if the id is the largest.
Records larger than a range are read whole by the owner. Empty input: no file, no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import salted_lookup, ship, stored

LEAST_BYTES, SPLIT_BYTES, CHUNK = 1000, 4 << 20, 1 << 18
MAGIC = b"\x1f\x8b\x08"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record, gzipped as a member of its own; equal input gives equal bytes."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.0", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id, digest)}",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        clean = url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in url or "\n" in url else url
        head.append(f"WARC-Target-URI: {clean}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    head += [f"X-Payload-Length: {len(payload)}", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n", mtime=0)


def _written(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    fs, path = pafs.FileSystem.from_uri(folder)
    task = TaskContext.get()
    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
    out, size, records = None, 0, 0
    for b in batches:
        for page_id, url, payload, digest, refers_to, revisit in zip(*b.columns, strict=True):
            if out is None:
                fs.create_dir(path, recursive=True)
                out = fs.open_output_stream(f"{path}/{name}", compression=None)  # members are gzipped already
            data = record(page_id.as_py(), url.as_py(), payload.as_py(), digest.as_py(), refers_to.as_py(), revisit.as_py())
            out.write(data)
            size += len(data)
            records += 1
    if out is not None:
        out.close()
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([size], pa.int64()), pa.array([records], pa.int64())],
                                         names=["path", "length", "records"])


def write(pages: DataFrame, folder: str | None = None, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write the archives; returns the manifest (path, length, records)."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.sha1("payload").alias("digest"))
    copies = rows.groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("first")).where("n > 1")
    found = salted_lookup(rows, stored(copies, "payload-copies"), "digest", "n", rows.count(), F.xxhash64("page_id", "url"))
    revisit = (F.col("first").isNotNull() & (F.octet_length("payload") >= least_bytes)
               & ~F.col("page_id").eqNullSafe(F.col("first")))
    found = found.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))
    return stored(found.mapInArrow(partial(_written, folder=folder), "path string, length long, records long"), "warc-manifest")


def _member(f, at: int) -> tuple[bytes, int] | None:
    """The decoded WARC member at ``at`` and its end, or None if there is none."""
    f.seek(at)
    unzip, parts, start, used = zlib.decompressobj(31), [], b"", at
    while not unzip.eof:
        chunk = f.read(CHUNK)
        if not chunk:
            if start[:5] == b"WARC/":
                raise ValueError(f"archive ends inside the record at byte {at}")
            return None
        used += len(chunk)
        try:
            parts.append(unzip.decompress(chunk))
        except zlib.error:
            return None
        start += parts[-1][:7 - len(start)]
        if not b"WARC/1.".startswith(start):
            return None
    data = b"".join(parts)
    head, sep, rest = data.partition(b"\r\n\r\n")
    length = next((int(x.split(b":", 1)[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")), -1)
    return (data, used - len(unzip.unused_data)) if sep and len(rest) == length + 4 else None


def members(f, start: int, end: int) -> Iterator[bytes]:
    """Decoded members that start in [start, end)."""
    at = start
    while at < end:
        f.seek(at)
        window = f.read(min(CHUNK, end - at) + len(MAGIC) - 1)
        hit = window.find(MAGIC)
        if hit < 0:
            at += max(1, len(window) - len(MAGIC) + 1)
            if len(window) < len(MAGIC):
                return
            continue
        at += hit
        if at >= end:
            return
        found = _member(f, at)
        if found:
            yield found[0]
            at = found[1]
        else:
            at += 1


def parse(data: bytes) -> tuple:
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    number = lambda k: int(fields[k]) if k in fields else None
    kind = fields["WARC-Type"]
    payload = block[:-4].partition(b"\r\n\r\n")[2] if kind == "response" else None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != number("X-Payload-Length")):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not fit its digest")
    return (number("X-Page-ID"), number("X-Payload-Length"), digest, kind, number("X-Refers-To-Page-ID"),
            fields.get("WARC-Target-URI"), payload)


def _read(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path, start, end in zip(*(c.to_pylist() for c in b.columns), strict=True):
            fs, name = pafs.FileSystem.from_uri(path)
            rows, size = [], 0
            with fs.open_input_file(name) as f:
                for data in members(f, start, end):
                    rows.append(parse(data))
                    size += len(data)
                    if size > 1 << 25:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def read(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of the files (path, length) of ``manifest``, read by byte ranges."""
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))
    ranges = manifest.where("length > 0").select("path", "length", F.explode(starts).alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + split_bytes, F.col("length")).alias("end"))
    n = manifest.agg(F.coalesce(F.sum(F.ceil(F.col("length") / split_bytes)), F.lit(0))).first()[0]
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])
    return ranges.repartitionByRange(max(1, int(n)), "path", "start").mapInArrow(partial(_read, schema=schema), RECORD)


ship(__name__)
