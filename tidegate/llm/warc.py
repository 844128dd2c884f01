"""WARC archives: records written by tasks, and a reader whose tasks split files at any byte.

Every record is a gzip member of its own. A reading task gets a byte range, scans it for the
gzip magic, and takes a place for a member only if it decompresses to a record header; it owns
the records that *start* inside its range and reads the last one past the range's end. Ranges
need no index and no agreement between tasks, and a damaged stretch costs only its own records.

Of records with equal payloads the one with the largest page id is a response, the others are
revisits that refer to it and carry no payload; their HTTP header still tells its size.

Nulls: a null payload is an empty one; a page without id sorts below all others (if all copies
lack one, all are responses). Repeated rows are each written; with the largest id each is a
response. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.files import attempt_name, join_path, open_input, open_output

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPLIT_BYTES = 8 << 20
FILE_BYTES = 256 << 20
CHUNK = 1 << 16  # read at a time; a member is mostly shorter
BATCH_BYTES = 4 << 20
ID_PREFIX = "urn:page:"
NO_ID = "none"

MANIFEST = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("bytes", T.LongType()),
    T.StructField("records", T.LongType()),
])

RECORDS = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.LongType()),
    T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()),
    T.StructField("payload", T.BinaryType()),
    T.StructField("file", T.StringType()),
    T.StructField("offset", T.LongType()),
])


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def plan_records(pages: DataFrame, store: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Rows of (page_id, url, payload, refers_to); ``refers_to`` is null for a response.

    The winner of a digest is a ``max`` that shrinks where pages are read; only digests and ids
    are shuffled for it. Digests that occur once need no decision and drop out. The winners are
    stored (``store`` writes a frame to the shared folder and reads it back), so that the join can
    split a payload that makes up a large part of the pages.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.unhex(F.sha1("payload")))
    winners = rows.groupBy("digest").agg(F.max("page_id").alias("winner"), F.count("*").alias("copies"))
    winners = store(winners.where("copies > 1 AND winner IS NOT NULL").drop("copies"), "winners")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("winner")), F.col("winner"))
    return rows.join(winners, "digest", "left").select("page_id", "url", "payload", refers.alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{ID_PREFIX}{NO_ID if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", " ".join((url or "").split())),
        ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{ID_PREFIX}{refers_to}>"), ("WARC-Profile", IDENTICAL)]
    fields.append(("Content-Length", str(len(block))))
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gz.compress(head + block + b"\r\n\r\n") + gz.flush()


def write_warc(planned: DataFrame, folder: str, date: datetime | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write planned records; gives the manifest (file, bytes, records). Files of failed attempts are not in it."""
    stamp = (date or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, out, path, size, count = TaskContext.get().partitionId(), 0, None, "", 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path = join_path(folder, attempt_name(f"pages-{part:06d}-{number:04d}", ".warc.gz"))
                    out, size, count, number = open_output(path), 0, 0, number + 1
                data = record(row["page_id"], row["url"], row["payload"], row["refers_to"], stamp)
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= file_bytes:
                    out.close()
                    yield _listed(path, size, count)
                    out = None
        if out is not None:
            out.close()
            yield _listed(path, size, count)

    return planned.select("page_id", "url", "payload", "refers_to").mapInArrow(run, MANIFEST)


def _listed(path: str, size: int, count: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([path]), pa.array([size], pa.int64()), pa.array([count], pa.int64())], names=["file", "bytes", "records"]
    )


def read_warc(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of the listed archives (columns ``file`` and ``bytes``), a task for each byte range."""
    ranges = files.select(
        "file", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))).alias("begin")
    )
    # A range is a row here but split_bytes of work: the number is set, or Spark would merge the few rows into one task.
    dealt = ranges.repartition(max(1, ranges.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
            ("file", pa.string()), ("offset", pa.int64()),
        ])
        for batch in batches:
            for row in batch.to_pylist():
                held, size = [], 0
                for offset, data in members(row["file"], row["begin"], row["begin"] + split_bytes):
                    found = parse_record(data)
                    if found is None:
                        continue
                    held.append(found | {"file": row["file"], "offset": offset})
                    size += len(data)
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    return dealt.mapInArrow(run, RECORDS)


def members(path: str, begin: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Records that start in [begin, end): their place and their decompressed bytes.

    A candidate whose first bytes do not decompress to the version line is chance; a member that
    breaks off is skipped, and the scan goes on behind its magic.
    """
    with open_input(path) as source:
        total = source.size()
        window, at = b"", begin  # bytes of the file from ``at`` on
        while at < min(end, total):
            hit = window.find(MAGIC)
            if hit < 0:
                keep = window[-2:]
                source.seek(at + len(window))
                more = source.read(CHUNK)
                if not more:
                    return
                at, window = at + len(window) - len(keep), keep + more
                continue
            at, window = at + hit, window[hit:]
            if at >= end:
                return
            data, window, used = _inflate(source, at, window)
            if data is None:
                at, window = at + 1, window[1:]
            else:
                yield at, data
                at += used


def _inflate(source, at: int, window: bytes) -> tuple[bytes | None, bytes, int]:
    """The member at ``at`` (None if it is none), the bytes known behind it, and its length."""
    gz, out, used, known, checked = zlib.decompressobj(31), [], 0, window, False
    feed = window
    while True:
        try:
            out.append(gz.decompress(feed))
        except zlib.error:
            return None, window, 0
        if not checked and (sum(map(len, out)) >= len(VERSION) or gz.eof):
            start = b"".join(out)
            if not start.startswith(b"WARC/"):
                return None, window, 0
            checked = True
        used += len(feed) - len(gz.unused_data)
        if gz.eof:
            return b"".join(out), gz.unused_data, used
        source.seek(at + used)
        feed = known = source.read(CHUNK)
        if not known:
            return None, window, 0


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, colon, v in (line.partition(":") for line in lines) if colon}


def _page(value: str | None) -> int | None:
    number = (value or "").strip("<>").removeprefix(ID_PREFIX)
    return int(number) if number.lstrip("-").isdigit() else None


def parse_record(data: bytes) -> dict | None:
    """A response or revisit; None for another type or a record whose length is wrong."""
    head, found, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    kind, length = fields.get("warc-type"), fields.get("content-length", "")
    if not found or kind not in ("response", "revisit") or not length.isdigit() or len(rest) < int(length):
        return None
    http, _, payload = rest[:int(length)].partition(b"\r\n\r\n")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    size = _fields(http).get("content-length", "")
    if kind == "response":
        if sha1_base32(payload) != digest:
            return None
        size = len(payload)
    return {
        "page_id": _page(fields.get("warc-record-id")),
        "url": fields.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": _page(fields.get("warc-refers-to")),
        "payload_bytes": int(size) if str(size).isdigit() else None,
        "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


def store_manifest(manifest: DataFrame, folder: str) -> DataFrame:
    """Write the manifest and read it back: from here on the file names are fixed."""
    path = join_path(folder, "manifest")
    manifest.write.parquet(path)
    return SparkSession.active().read.schema(MANIFEST).parquet(path)
