"""WARC archives written and read through an index.

Writing: each task streams its pages as gzip members (one per record) into
archives of bounded size and returns an index row per record: archive,
offset, length, URL, digest. The index is committed by Spark, so archives of
failed attempts are never referred to and never read.

Reading: the selected index rows are dealt by archive and region, sorted by
offset, and neighbouring ranges are fetched with one read each. A record
repeated elsewhere is written once, as a response; the others are revisit
records that name it."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectio.llm.common import written
from lectio.session import scratch_path

MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 256 << 20
#: Neighbouring records are fetched together up to this many bytes, over
#: gaps (records that were not selected) of at most GAP_BYTES.
SPAN_BYTES, GAP_BYTES = 8 << 20, 256 << 10
#: Bytes of archives that a reading task gets.
TASK_BYTES = 16 << 20
# Spark's URI schemes of a store under the name Arrow has for it.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfs": "abfs", "abfss": "abfss", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs", "file": "file", "s3": "s3"}
WARC_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system for a folder or file as Spark names it, and the
    path there. A ``dbfs:`` folder is reached by its mount."""
    scheme, colon, rest = uri.partition(":")
    if not colon or len(scheme) < 2:
        return fs.FileSystem.from_uri(uri)
    if scheme == "dbfs":
        return fs.LocalFileSystem(), "/dbfs/" + rest.lstrip("/")
    if scheme not in SCHEMES:
        raise ValueError(f"archives can't be kept under {scheme}: (of {uri}); use a folder under one of {', '.join(sorted(SCHEMES))} or dbfs")
    return fs.FileSystem.from_uri(f"{SCHEMES[scheme]}:{rest}")


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(page_id, url, payload, digest, refers_to): ``refers_to`` is the
    smallest id with the same payload where that is another record, else
    null. Payloads under 100 bytes never refer. The smallest id per digest
    is found with map-side aggregation; short payloads get keys of their own
    so that they don't meet anywhere."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    long_enough = F.length("payload") >= MIN_REVISIT_BYTES
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    first = (rows.where(long_enough).groupBy(F.col("digest").alias("same"))
             .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").drop("n"))
    own_key = F.when(long_enough, F.col("digest")).otherwise(F.concat(F.lit("-"), F.coalesce(F.col("page_id").cast("string"), F.lit(""))))
    joined = rows.withColumn("own_key", own_key).join(first, F.col("own_key") == F.col("same"), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return joined.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def _target_uri(url: str | None) -> str:
    """Header values are one line: control characters are escaped."""
    return "" if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record_bytes(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One gzip member. A revisit keeps the HTTP head, whose Content-Length
    is the payload's, and leaves the payload out."""
    revisit = refers_to is not None
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block += b"" if revisit else payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>",
            f"WARC-Date: {WARC_DATE}", f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_target_uri(url)}")
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode()) + packer.compress(block + b"\r\n\r\n") + packer.flush()


def parse_record(member: bytes) -> dict:
    """The record of one gzip member; a payload that does not match its
    digest is an error."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    n_bytes = int(re.search(rb"(?i)content-length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != n_bytes or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    refers = fields.get("WARC-Refers-To")
    return {"record": fields["WARC-Record-ID"], "record_type": kind, "url": fields.get("WARC-Target-URI"),
            "payload": payload if kind == "response" else None, "payload_bytes": n_bytes, "payload_digest": digest,
            "refers_to": refers and refers[len("<urn:page:"):-1]}


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   folder: str | None = None) -> DataFrame:
    """Writes a WARC record per row of ``pages`` and returns the written
    index: page_id, url, digest, record_type, archive, offset, length.

    A null payload counts as empty, a null URL leaves out its header, a null
    id is written as record ``None``. Of records with equal payloads of at
    least 100 bytes, those with the smallest id are responses (rows that
    repeat that id are all responses), the others revisits; null ids are the
    largest. An empty table gives an empty index and no archive."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    open_store(folder)  # a store that can't be written to is an error here, not in the tasks
    rows = with_revisits(pages, id_col, url_col, payload_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        attempt = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:8]}"
        out, name, at, n = None, "", 0, 0
        for batch in batches:
            index = {"archive": [], "offset": [], "length": []}
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None or at >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    store.create_dir(root, recursive=True)
                    name, at, n = f"pages-{attempt}-{n:04d}.warc.gz", 0, n + 1
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                member = record_bytes(page_id, url, payload, digest, refers_to)
                out.write(member)
                for key, value in (("archive", name), ("offset", at), ("length", len(member))):
                    index[key].append(value)
                at += len(member)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), batch.column("digest"),
                 pa.array(["response" if r is None else "revisit" for r in batch.column("refers_to").to_pylist()], pa.string()),
                 pa.array(index["archive"], pa.string()), pa.array(index["offset"], pa.int64()),
                 pa.array(index["length"], pa.int64())],
                ["page_id", "url", "digest", "record_type", "archive", "offset", "length"])
        if out is not None:
            out.close()

    id_type = rows.schema["page_id"].dataType.simpleString()
    index = written(rows.mapInArrow(run, f"page_id {id_type}, url string, digest string, record_type string, archive string, "
                                         "offset long, length long"), "warc-index")
    return index.withColumn("archive", F.concat(F.lit(folder + "/"), "archive"))


def _dealt(chosen: DataFrame, task_bytes: int) -> DataFrame:
    """The chosen records in tasks of about ``task_bytes`` of archives each,
    however few bytes their index rows have, sorted by place.

    An archive is cut into regions of that size. A region's place among all
    chosen bytes is the sum over the archives before it (one row per archive
    in that window) and over its own archive's regions before it."""
    region = F.floor(F.col("offset") / task_bytes)
    records = chosen.withColumn("region", region)
    sizes = written(records.groupBy("archive", "region").agg(F.sum("length").alias("bytes")), "warc-regions")
    before = Window.partitionBy("archive").orderBy("region").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("archive").rowsBetween(Window.unboundedPreceding, -1)
    archives = sizes.groupBy("archive").agg(F.sum("bytes").alias("all")).select(
        F.col("archive").alias("of"), F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("earlier"))
    begins = sizes.select("archive", "region", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("inside"))
    tasks = begins.join(archives, F.col("archive") == F.col("of")).select(
        F.col("archive").alias("of"), F.col("region").alias("at"),
        F.floor((F.col("earlier") + F.col("inside")) / task_bytes).cast("int").alias("task"))
    n = -(-(sizes.agg(F.sum("bytes")).first()[0] or 1) // task_bytes)
    placed = records.join(tasks, (F.col("archive") == F.col("of")) & (F.col("region") == F.col("at"))).drop("of", "at", "region")
    return placed.repartitionById(n, F.col("task")).drop("task").sortWithinPartitions("archive", "offset")


def read_archives(index: DataFrame, selected: Column | None = None, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Reads the records of the selected index rows (all by default):
    page_id, url as the record has it, record_type, payload (null for
    revisits), payload_bytes, payload_digest, refers_to (as text).

    Only the selected byte ranges are read, neighbours together, in tasks of
    about ``task_bytes``; memory is one span and its records. Each response's
    digest is checked."""
    chosen = index if selected is None else index.where(selected)
    ordered = _dealt(chosen.select("page_id", "archive", "offset", "length"), task_bytes)
    id_type = index.schema["page_id"].dataType.simpleString()

    def fetch(archive: str, span: list[tuple]) -> pa.RecordBatch:
        store, path = open_store(archive)
        begin, end = span[0][1], max(offset + length for _, offset, length in span)
        with store.open_input_file(path) as f:
            data = f.read_at(end - begin, begin)
        found = [parse_record(data[offset - begin:offset - begin + length]) for _, offset, length in span]
        for (page_id, _, _), record in zip(span, found, strict=True):
            if record["record"] != f"<urn:page:{page_id.as_py()}>":
                raise ValueError(f"index row of page {page_id} leads to {record['record']}")
        columns = [pa.array([s[0].as_py() for s in span], span[0][0].type)]
        kinds = {"url": pa.string(), "record_type": pa.string(), "payload": pa.binary(), "payload_bytes": pa.int64(),
                 "payload_digest": pa.string(), "refers_to": pa.string()}
        columns += [pa.array([r[k] for r in found], t) for k, t in kinds.items()]
        return pa.RecordBatch.from_arrays(columns, ["page_id", *kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, span = None, []
        for batch in batches:
            ids = batch.column("page_id")
            for i, (name, offset, length) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length")),
                                                           strict=True)):
                if span and (name != archive or offset - (span[-1][1] + span[-1][2]) > GAP_BYTES
                             or offset + length - span[0][1] > SPAN_BYTES):
                    yield fetch(archive, span)
                    span = []
                archive = name
                span.append((ids[i], offset, length))
        if span:
            yield fetch(archive, span)

    return ordered.mapInArrow(run, f"page_id {id_type}, url string, record_type string, payload binary, payload_bytes long, "
                                   "payload_digest string, refers_to string")
