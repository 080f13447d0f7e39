"""WARC archives: writing pages as records, and reading them back.

A response record holds an HTTP response whose body is chunked.  A block longer
than ``SEGMENT`` is written in segments: the first under the record's own type,
the others as ``continuation`` records that name the first as their origin, with
running numbers; the last tells the total length.  A page whose payload another
page has as well is a ``revisit`` of that page and has no body.

Reading parses the files one by one.  Whole records are decoded where they are
read; segments are grouped by origin, ordered by number, checked (numbers without
a gap, total length as told) and only then decoded.  What fails a check is
returned with ``error`` and no payload columns, never dropped.  A group of
segments is one payload, so no more comes together than one payload.

Null html is an empty payload; null url is written empty.  Rows with a null
page_id are written too; a payload that no row with an id has is not revisited.
Repeated rows are records of their own, and rows that share the smallest page_id
are all responses.  Other columns are ignored.
"""

from __future__ import annotations

import gzip
import io
import re
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurwork.llm.common import map_rows, sha256_hex, written
from recurwork.session import checkpoint_dir

# Smallest payload that is revisited, sizes of chunks and segments, and the date of every record.
REVISIT_LEAST, CHUNK, SEGMENT, DATE = 100, 8 << 10, 32 << 10, "2026-01-01T00:00:00Z"
END = "\r\n"
RECORDS_PER_FILE = 2000

HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def chunked(payload: bytes) -> bytes:
    parts = []
    for at in range(0, len(payload), CHUNK):
        part = payload[at:at + CHUNK]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        n = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if n == 0:
            break
        if body[at + n:at + n + 2] != b"\r\n":
            raise ValueError("chunk without its end")
        out.append(body[at:at + n])
        at += n + 2
    return b"".join(out)


def payload_of(block: bytes) -> bytes:
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("block without an HTTP head")
    if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head):
        return unchunked(body)
    return body


def record(kind: str, record_id: str, fields: dict[str, object], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}"]
    lines += [f"{k}: {v}" for k, v in fields.items() if v is not None]
    lines += [f"Content-Length: {len(block)}", "", ""]
    return END.join(lines).encode() + block


def records_of(page_id: int | None, url: str | None, html: str | None, digest: str, refers_to: int | None) -> list[bytes]:
    own = f"urn:uuid:{uuid.uuid4()}"
    fields: dict[str, object] = {
        "WARC-Target-URI": "".join(c if c.isprintable() else "%{:02X}".format(ord(c)) for c in url or ""),
        "WARC-Payload-Digest": f"sha256:{digest}", "Page-Id": page_id}
    if refers_to is not None:
        about = {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "Refers-To-Page-Id": refers_to}
        return [record("revisit", own, fields | about, b"")]
    fields["Content-Type"] = "application/http;msgtype=response"
    block = HTTP + chunked((html or "").encode("utf-8", "surrogatepass"))
    if len(block) <= SEGMENT:
        return [record("response", own, fields, block)]
    cuts = list(range(0, len(block), SEGMENT))
    out = [record("response", own, fields | {"WARC-Segment-Number": 1}, block[:SEGMENT])]
    for i, at in enumerate(cuts[1:], 2):
        told = {"WARC-Segment-Number": i, "WARC-Segment-Origin-ID": f"<{own}>",
                "WARC-Segment-Total-Length": len(block) if i == len(cuts) else None}
        out.append(record("continuation", f"urn:uuid:{uuid.uuid4()}", told, block[at:at + SEGMENT]))
    return out


def write_archives(pages: DataFrame, path: str) -> None:
    """A folder of gzipped WARC files, each of a bounded number of records.

    The payloads that occur more than once are found from digests alone; pages
    meet that table in a join that Spark broadcasts when the table, written
    first, is small enough, and splits where one payload is very common.
    """
    payload = F.coalesce("html", F.lit(""))
    pages = pages.select("page_id", "url", "html", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("size"))
    again = (pages.where(F.col("size") >= REVISIT_LEAST).groupBy(F.col("digest").alias("again"))
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    joined = pages.join(written(again, "warc-again"), F.col("digest") == F.col("again"), "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))

    def run(columns: list[list]) -> list[list]:
        return [[r for row in zip(*columns, strict=True) for r in records_of(*row)]]

    rows = map_rows(joined.select("page_id", "url", "html", "digest", refers.alias("refers_to")), run,
                    "record binary", pa.schema([("record", pa.binary())]))
    # A record ends with two line ends; so the text writer makes a WARC file of the records.
    (rows.select(F.col("record").cast("string")).write.option("lineSep", END * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def parsed(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of an archive."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        n = int(fields["content-length"])
        block = stream.read(n)
        if len(block) < n:
            raise ValueError("the archive ends inside a record")
        yield fields, block


PARSED = "page_id long, kind string, origin string, number int, total long, refers_to long, digest string, size long, block binary, error string"
PARSED_ARROW = pa.schema([("page_id", pa.int64()), ("kind", pa.string()), ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()),
                          ("refers_to", pa.int64()), ("digest", pa.string()), ("size", pa.int64()), ("block", pa.binary()), ("error", pa.string())])


def decoded(block: bytes, told: str | None) -> tuple[str | None, int | None, str | None]:
    """Digest and size of the payload, or what is wrong with it."""
    try:
        payload = payload_of(block)
    except ValueError as e:
        return None, None, str(e)
    digest = sha256_hex(payload)
    if told and told != digest:
        return None, None, "the payload has another digest than told"
    return digest, len(payload), None


def row_of(fields: dict[str, str], block: bytes) -> tuple:
    number = lambda k: int(fields[k]) if k in fields else None
    told = fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
    page_id, kind = number("page-id"), fields["warc-type"]
    if kind == "revisit":
        return page_id, kind, None, None, None, number("refers-to-page-id"), told, None, None, None
    if "warc-segment-number" in fields:
        origin = fields.get("warc-segment-origin-id", fields["warc-record-id"])
        return page_id, "segment", origin, number("warc-segment-number"), number("warc-segment-total-length"), None, told, None, block, None
    digest, size, error = decoded(block, told)
    return page_id, kind, None, None, None, None, digest, size, None, error


BATCH_BYTES = 4 << 20


def parse_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), PARSED_ARROW, strict=True)], schema=PARSED_ARROW)

    for files in batches:
        for i in range(files.num_rows):
            content = files.column(0)[i].as_buffer()
            raw = io.BytesIO(content)
            rows, held = [], 0
            for fields, block in parsed(gzip.GzipFile(fileobj=raw) if bytes(content[:2]) == b"\x1f\x8b" else raw):
                rows.append(row_of(fields, block))
                held += 500 + len(rows[-1][8] or b"")
                if held > BATCH_BYTES:
                    yield batch(rows)
                    rows, held = [], 0
            if rows:
                yield batch(rows)


def assembled(segments: list[dict]) -> tuple:
    """One response from its segments: page_id, digest, size, error."""
    by_number = {s["number"]: s for s in segments}  # a segment that was read twice counts once
    ordered = [by_number[n] for n in sorted(by_number)]
    page_id, told = next(((s["page_id"], s["digest"]) for s in ordered if s["number"] == 1), (None, None))
    totals = {s["total"] for s in ordered if s["total"] is not None}
    block = b"".join(s["block"] for s in ordered)
    if sorted(by_number) != list(range(1, len(by_number) + 1)):
        return page_id, None, None, "a segment is missing"
    if totals != {len(block)}:
        return page_id, None, None, "the segments have another total length than told"
    return page_id, *decoded(block, told)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, error`` per record (a segmented one counts once).

    A revisit has the payload of the response it refers to.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    rows = written(files.mapInArrow(parse_files, PARSED), "warc-parsed")

    def join_segments(columns: list[list]) -> list[list]:
        return [list(c) for c in zip(*map(assembled, columns[0]), strict=True)] or [[], [], [], []]

    segments = (rows.where("kind = 'segment'").groupBy("origin")
                .agg(F.collect_list(F.struct("page_id", "number", "total", "digest", "block")).alias("segments")).select("segments"))
    whole = map_rows(segments, join_segments, "page_id long, digest string, size long, error string",
                     pa.schema([("page_id", pa.int64()), ("digest", pa.string()), ("size", pa.int64()), ("error", pa.string())]))
    responses = rows.where("kind = 'response'").select("page_id", "digest", "size", "error").unionByName(whole)
    # Revisits: sizes by digest, as repeated rows may share a page_id.
    sizes = responses.where("digest is not null").groupBy(F.col("digest").alias("of")).agg(F.max("size").alias("full"), F.min("page_id").alias("first"))
    revisits = (rows.where("kind = 'revisit'").select("page_id", "refers_to", "digest")
                .join(sizes, (F.col("digest") == F.col("of")) & (F.col("refers_to") == F.col("first")), "left")
                .select("page_id", F.col("full").alias("payload_bytes"), F.when(F.col("full").isNotNull(), F.col("digest")).alias("payload_digest"),
                        F.lit("revisit").alias("record_type"), "refers_to",
                        F.when(F.col("full").isNull(), "the response is missing").alias("error")))
    own = responses.select("page_id", F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                           F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), "error")
    return own.unionByName(revisits)


def through_archives(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path)
    return read_archives(spark, path)
