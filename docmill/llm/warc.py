"""Web archives: pages to WARC files and back, with the records of each capture put together.

Every page becomes a response (or, for a payload that an earlier page has, a revisit), a request
and a metadata record; the latter two name the first in WARC-Concurrent-To. Spark's text sink
writes them: its line end is the blank lines that close a record, and files are gzipped whole.
The reader takes archives of any writer, gzipped whole or by record, and finds records by their
Content-Length, one after the other, inflating as they go. Records meet again by an aggregation on the record they are concurrent to.

Defined cases: a null html is an empty payload; payloads under 100 bytes are never revisited;
rows that repeat both the smallest page id and its payload are responses each; a null page id
counts as largest and comes back null; line ends in urls become blanks; an empty table gives no
rows. Records without a capture they belong to give a row without one. Records that break off, lack
a length or lie between other bytes get a status and end nothing; they are part of no capture.
Other columns of pages are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.llm.shared import kept
from docmill.plans.storage import shared_folder

LEAST_BYTES = 100
#: Aim for the text of one file; readers hold one file as it is stored, and one record.
FILE_BYTES = 16 << 20
DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def identifier(*parts: Column) -> Column:
    """A record id made from values that tell the record from all others of one writing."""
    h = F.md5(F.concat_ws("|", *parts).cast("binary"))
    pieces = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def record(kind: str | Column, record_id: Column, block: Column, headers: dict[str, Column | str | None]) -> Column:
    """One record without the blank lines after it; null headers are left out."""
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.lit(kind) if isinstance(kind, str) else kind)]
    lines += [F.concat(F.lit("WARC-Record-ID: "), record_id), F.lit(f"WARC-Date: {DATE}")]
    for name, value in headers.items():
        lines.append(F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value))
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF), block)


def write_archives(pages: DataFrame) -> str:
    """Write ``pages(page_id, url, html)``; returns the folder."""
    spark = pages.sparkSession
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", F.regexp_replace(F.coalesce("url", F.lit("urn:none")), "[\\r\\n]+", " ").alias("url"), html.alias("payload"), F.octet_length(html).cast("long").alias("bytes"), F.sha2(html.cast("binary"), 256).alias("digest"))
    firsts = rows.where(F.col("bytes") >= LEAST_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    firsts = kept(firsts.where("n > 1").drop("n"), "warc-first")
    mean = rows.agg(F.avg("bytes")).first()[0] or 0.0

    joined = rows.join(firsts, "digest", "left").withColumn("row", F.monotonically_increasing_id())
    again = F.coalesce(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False))
    capture = identifier(F.lit("capture"), F.col("row"), F.col("digest"))
    common = {"WARC-Target-URI": F.col("url")}
    digest = F.concat(F.lit("sha256:"), F.col("digest"))
    response = record("response", capture, F.concat(F.lit(HTTP), F.col("payload")), common | {"Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": digest})
    revisit = record("revisit", capture, F.lit(HTTP), common | {"Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": digest, "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"})
    target = F.regexp_extract("url", "^[A-Za-z]+://([^/]*)(.*)$", 2)
    ask = F.concat(F.lit("GET "), F.when(target == "", "/").otherwise(target), F.lit(" HTTP/1.1\r\nHost: "), F.regexp_extract("url", "^[A-Za-z]+://([^/]*)", 1), F.lit(CRLF + CRLF))
    request = record("request", identifier(F.lit("request"), F.col("row"), F.col("digest")), ask, common | {"Content-Type": "application/http; msgtype=request", "WARC-Concurrent-To": capture})
    facts = F.concat(
        F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(CRLF + "payload-length: "), F.col("bytes").cast("string"),
        F.when(again, F.concat(F.lit(CRLF + "refers-to-page: "), F.col("first").cast("string"))).otherwise(""), F.lit(CRLF),
    )
    metadata = record("metadata", identifier(F.lit("metadata"), F.col("row"), F.col("digest")), facts, common | {"Content-Type": "application/warc-fields", "WARC-Concurrent-To": capture})
    path = shared_folder(spark, "warc")
    lines = joined.select(F.explode(F.array(F.when(again, revisit).otherwise(response), request, metadata)).alias("value"))
    per_file = 3 * max(1, int(FILE_BYTES / (mean + 1500)))
    lines.write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)
    return path


RECORDS = "record_id string, type string, target_uri string, date string, content_type string, concurrent_to array<string>, declared_digest string, headers map<string,string>, block binary, payload_bytes long, payload_digest string, status string, file string"
MAGIC = b"\x1f\x8b\x08"
#: Bytes of an archive that are inflated at a time; headers beyond HEADER_BYTES are no headers.
STEP, HEADER_BYTES = 1 << 16, 1 << 20


def inflated(data: bytes) -> Iterator[bytes | None]:
    """Plain bytes, or those of gzip members one after the other, in short pieces; None where a member breaks off."""
    if not data.startswith(MAGIC):
        yield from (data[at : at + STEP] for at in range(0, len(data), STEP))
        return
    at = 0
    while 0 <= at < len(data):
        one, read, good = zlib.decompressobj(31), at, True
        try:
            while not one.eof and read < len(data):
                yield one.decompress(data[read : read + STEP])
                read += STEP
        except zlib.error:
            good = False
        if good and one.eof:
            at = min(read, len(data)) - len(one.unused_data)
            if data.startswith(MAGIC, at) or not data[at:].strip(b"\0"):
                continue
            at -= 1
        yield None
        at = data.find(MAGIC, at + 1)


def parsed(pieces: Iterator[bytes]) -> Iterator[tuple[list[tuple[str, str]], bytes, str]]:
    """Headers, block and status of each record, and the bytes between records as ``skipped``.

    No more than a record is held. A record without a length has none of the bytes up to the next
    line that starts one; one that ends early has the block as far as it goes.
    """
    held, lost, source = bytearray(), 0, iter(pieces)

    def fill() -> bool:
        """Hold one more piece; false at the end."""
        piece = next((p for p in source if p), None)
        held.extend(piece or b"")
        return piece is not None

    def skip(n: int) -> None:
        nonlocal lost
        lost += n
        del held[:n]

    def to_next(start: int) -> None:
        """Skip up to the next line that starts a record."""
        while (at := held.find(b"\nWARC/", start)) < 0:
            done = max(0, len(held) - 5)
            skip(done)
            start = 0
            if not fill():
                skip(len(held))
                return
        skip(at + 1)

    while True:
        while held.startswith(b"\r\n") or (len(held) < 5 and fill()):
            if held.startswith(b"\r\n"):
                del held[:2]
        if not held:
            if lost:
                yield [], b"", f"skipped {lost}"
            return
        if not held.startswith(b"WARC/"):
            to_next(0)
            continue
        if lost:
            yield [], b"", f"skipped {lost}"
            lost = 0
        seen = 0
        while (end := held.find(b"\r\n\r\n", seen)) < 0 and len(held) <= HEADER_BYTES:
            seen = max(0, len(held) - 3)
            if not fill():
                break
        again = held.find(b"\nWARC/", 0, end if end >= 0 else len(held))
        if again >= 0:
            skip(again + 1)
            continue
        if end < 0:
            to_next(1)
            continue
        headers = []
        for line in held[:end].decode("utf-8", "replace").split(CRLF)[1:]:
            name, _, value = line.partition(":")
            headers.append((name.strip().lower(), value.strip()))
        length = next((v for k, v in headers if k == "content-length"), "")
        if not (length.isascii() and length.isdigit() and len(length) < 19):
            yield headers, b"", "no_length"
            del held[: end + 4]
            continue
        stop = end + 4 + int(length)
        while len(held) < stop and fill():
            pass
        yield headers, bytes(held[end + 4 : stop]), "ok" if len(held) >= stop else "cut"
        del held[:stop]


def runs_of(pieces: Iterator[bytes | None]) -> Iterator[Iterator[bytes]]:
    """The pieces between two breaks, as iterators that are used up in turn."""
    over = False

    def run() -> Iterator[bytes]:
        nonlocal over
        for piece in pieces:
            if piece is None:
                return
            yield piece
        over = True

    while not over:
        yield run()


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives in a folder; payload digests and lengths are taken from the payloads.

    ``status`` is ``ok``; ``cut`` for a record that its file or gzip member ends early; ``no_length``
    for one without a usable Content-Length, whose block is empty. Bytes that are no record, and
    headers that break off, are one row ``skipped`` without a type, whose ``payload_bytes`` counts
    them; reading goes on at the next line that starts a record, or the next gzip member.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("target_uri", pa.string()), ("date", pa.string()), ("content_type", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("declared_digest", pa.string()), ("headers", pa.map_(pa.string(), pa.string())), ("block", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("status", pa.string()), ("file", pa.string())])
        rows, size = [], 0

        def batch():
            return pa.RecordBatch.from_pylist(rows, schema)

        for given in batches:
            for content, file in zip(given.column("content"), given.column("path").to_pylist(), strict=True):
                for headers, block, status in (r for run in runs_of(inflated(content.as_py())) for r in parsed(run)):
                    first = dict(reversed(headers))
                    status, _, lost = status.partition(" ")
                    payload = block
                    if first.get("content-type", "").startswith("application/http"):
                        payload = block.partition(b"\r\n\r\n")[2]
                    rows.append(
                        {
                            "record_id": first.get("warc-record-id"),
                            "type": first.get("warc-type"),
                            "target_uri": first.get("warc-target-uri"),
                            "date": first.get("warc-date"),
                            "content_type": first.get("content-type"),
                            "concurrent_to": [v for k, v in headers if k == "warc-concurrent-to"],
                            "declared_digest": first.get("warc-payload-digest"),
                            "headers": list(first.items()),
                            "block": None if lost else block,
                            "payload_bytes": int(lost) if lost else len(payload),
                            "payload_digest": None if lost else hashlib.sha256(payload).hexdigest(),
                            "status": status,
                            "file": file,
                        }
                    )
                    size += len(block)
                    if size > 4 << 20 or len(rows) >= 4096:
                        yield batch()
                        rows, size = [], 0
        if rows:
            yield batch()

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(records, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``(capture_id, capture, request, metadata, n_requests, n_metadata)``.

    A request or metadata record belongs to every record it is concurrent to; of several the one
    with the smallest id is shown. Groups hold no more than one record of each kind in memory.
    Only records with status ``ok`` take part.
    """
    records = records.where("status = 'ok'")
    head = F.col("type").isin("response", "revisit", "resource", "conversion")
    keys = F.when(head, F.array("record_id")).otherwise(F.when(F.size("concurrent_to") > 0, F.col("concurrent_to")).otherwise(F.array("record_id")))
    whole = F.struct("record_id", *(c for c in records.columns if c != "record_id" and c not in ("headers", "status", "file")))
    each = records.select(F.explode(keys).alias("capture_id"), "type", head.alias("head"), whole.alias("record"))
    kind = lambda t: F.col("type") == t
    return each.groupBy("capture_id").agg(
        F.min(F.when(F.col("head"), F.col("record"))).alias("capture"),
        F.min(F.when(kind("request"), F.col("record"))).alias("request"),
        F.min(F.when(kind("metadata"), F.col("record"))).alias("metadata"),
        F.count(F.when(kind("request"), 1)).alias("n_requests"),
        F.count(F.when(kind("metadata"), 1)).alias("n_metadata"),
    )


def captures(records: DataFrame) -> DataFrame:
    """Per capture of a page: ``(page_id, payload_bytes, payload_digest, record_type, refers_to)``."""
    slim = records.withColumn("block", F.when(F.col("type") == "metadata", F.col("block")))
    rows = assemble(slim).where("capture IS NOT NULL")
    field = lambda name: F.nullif(F.regexp_extract(F.col("metadata.block").cast("string"), f"(?m)^{name}: *([0-9-]+)", 1), F.lit("")).cast("long")
    again = F.col("capture.type") == "revisit"
    return rows.select(
        field("page-id").alias("page_id"),
        F.when(again, field("payload-length")).otherwise(F.col("capture.payload_bytes")).alias("payload_bytes"),
        F.when(again, F.regexp_replace("capture.declared_digest", "^sha256:", "")).otherwise(F.col("capture.payload_digest")).alias("payload_digest"),
        F.col("capture.type").alias("record_type"),
        F.when(again, field("refers-to-page")).alias("refers_to"),
    )
