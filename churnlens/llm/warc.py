"""WARC archives: writing captures, and assembling them again from their records.

Every page is a capture of three records: the request, the response (or a revisit, where an equal
payload is already held) and a metadata record; request and metadata name the response's record id
in WARC-Concurrent-To. Records are gzip members of their own, as usual. ``read_records`` reads
archives record by record, ``assemble`` joins the records of a capture through the concurrent-to
identifiers into one nested row; a request or metadata record may lie in any file.

Of records with equal payloads of at least ``revisit_from`` bytes the one with the largest page_id is
the response, the others are revisits of it; smaller payloads are all responses. A revisit holds no
payload: its HTTP header tells the full length, WARC-Payload-Digest the digest, WARC-Refers-To the
response. Digests of responses are computed anew from what was read.

A null html is an empty payload and a null url an empty target. Repeated rows are captures of their
own; of equal payloads under one page_id the response is one of them and the others refer to that
page_id. Rows without a page_id are captures too, but never the response that others refer to. An
empty table gives no archive and an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import batched, files_by_task, map_rows, open_fs, run_folder, written

DATE = "2024-01-01T00:00:00Z"  # the table has no capture time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SALTS = 16

MANIFEST = pa.schema([("path", pa.string()), ("captures", pa.int64()), ("bytes", pa.int64())])
RECORDS = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("concurrent_to", pa.string()),
                     ("target", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("fields", pa.string()), ("payload", pa.binary())])
RECORDS_DDL = ("record_id string, record_type string, concurrent_to string, target string, refers_to string, "
               "payload_bytes long, payload_digest string, fields string, payload binary")


def captures(pages: DataFrame, revisit_from: int = 1000) -> DataFrame:
    """page_id, url, html, capture (a number of its own), refers_to (page_id, null for responses).
    Payloads that occur once never meet a join; the rows of the others are salted, since one payload
    may be a third of the table."""
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    keyed = written(pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html", F.monotonically_increasing_id().alias("capture"),
        F.octet_length(payload).alias("bytes"), F.sha2(payload, 256).alias("same")), "captures")
    large = keyed.filter(F.col("bytes") >= revisit_from)
    held = (large.groupBy("same", "bytes")
            .agg(F.max(F.struct("page_id", "capture")).alias("first"), F.count("*").alias("n"))
            .filter((F.col("n") > 1) & F.col("first.page_id").isNotNull())
            .select("same", F.col("first.page_id").alias("response_page"), F.col("first.capture").alias("response"),
                    F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salt = F.pmod(F.xxhash64("capture"), F.lit(SALTS)).cast("int")
    found = (large.select("same", "capture", salt.alias("salt")).join(held, ["same", "salt"])
             .filter(F.col("capture") != F.col("response"))
             .select("capture", F.col("response_page").alias("refers_to"), F.col("response").alias("refers_capture")))
    revisits = written(found, "revisits")
    return (keyed.join(revisits, "capture", "left")
            .select("page_id", "url", "html", "capture", "refers_to", "refers_capture"))


def record_id(kind: str, run: str, capture: int) -> str:
    """A record's urn; the same for every attempt of a task."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{run}/{kind}/{capture}')}>"


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def capture_records(run: str, page_id: int | None, url: str | None, html: str | None, capture: int,
                    refers_to: int | None, refers_capture: int | None) -> Iterator[bytes]:
    payload = (html or "").encode("utf-8", "surrogatepass")
    sha1 = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    target = " ".join((url or "").split())
    own = record_id("response", run, capture)
    common = [("WARC-Date", DATE), ("WARC-Target-URI", target)]
    host = target.partition("://")[2].partition("/")[0]
    yield warc_record([("WARC-Type", "request"), ("WARC-Record-ID", record_id("request", run, capture)),
                       ("WARC-Concurrent-To", own), *common, ("Content-Type", "application/http; msgtype=request")],
                      f"GET / HTTP/1.1\r\nHost: {host}\r\n\r\n".encode())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind = [("WARC-Type", "response" if refers_capture is None else "revisit"), ("WARC-Record-ID", own), *common,
            ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{sha1}")]
    if refers_capture is None:
        yield warc_record(kind, http + payload)
    else:
        kind += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id("response", run, refers_capture))]
        yield warc_record(kind, http)
    fields = f"page_id: {'' if page_id is None else page_id}\r\nrefers_to_page: {'' if refers_to is None else refers_to}\r\n"
    yield warc_record([("WARC-Type", "metadata"), ("WARC-Record-ID", record_id("metadata", run, capture)),
                       ("WARC-Concurrent-To", own), *common, ("Content-Type", "application/warc-fields")], fields.encode())


def write_archives(pages: DataFrame, folder: str | None = None, revisit_from: int = 1000, file_mb: int = 64,
                   level: int = 1) -> DataFrame:
    """Write the captures of all pages; returns the manifest of the committed files, itself written."""
    spark = pages.sparkSession
    folder = folder or run_folder(spark, "warc")
    run_name, limit = folder.rpartition("/")[2], file_mb << 20

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(folder)
        fs.create_dir(base, recursive=True)

        def rows() -> Iterator[tuple]:
            out, name, n, size = None, "", 0, 0
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None:
                        name, n, size = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    for record in capture_records(run_name, *row):
                        member = zlib.compressobj(level, zlib.DEFLATED, 31)
                        size += out.write(member.compress(record) + member.flush())
                    n += 1
                    if size >= limit:
                        out.close()
                        yield f"{folder}/{name}", n, size
                        out = None
            if out is not None:
                out.close()
                yield f"{folder}/{name}", n, size
        yield from batched(MANIFEST, rows())

    return written(captures(pages, revisit_from).mapInArrow(write, "path string, captures long, bytes long"), "warc-manifest")


def members(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The records of an archive: its gzip members, one at a time."""
    data, member, parts = b"", zlib.decompressobj(31), []
    while True:
        if not data:
            data = stream.read(size)
            if not data:
                break
        parts.append(member.decompress(data))
        data = member.unused_data
        if member.eof:
            yield b"".join(parts)
            member, parts = zlib.decompressobj(31), []
        else:
            data = b""
    if any(parts):
        raise ValueError("the archive is cut short")


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names lower-cased) and block of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    length = int(headers["content-length"])
    if len(rest) < length:
        raise ValueError("the record is cut short")
    return headers, rest[:length]


def record_row(record: bytes, with_payload: bool) -> tuple:
    headers, block = parse_record(record)
    kind = headers.get("warc-type", "")
    size = digest = payload = fields = None
    if kind in ("response", "revisit"):
        http, _, payload = block.partition(b"\r\n\r\n")
        digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
        if kind == "response":
            size, found = len(payload), hashlib.sha1(payload)
            if digest and base64.b32encode(found.digest()).decode() != digest:
                raise ValueError("a payload fails its digest")
            digest = found.hexdigest()
        else:
            told = [v for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")) if k.lower() == b"content-length"]
            size = int(told[0]) if told else None
            digest = base64.b32decode(digest).hex() if digest else None
            payload = None
    elif kind == "metadata":
        fields = block.decode("utf-8", "replace")
    return (headers.get("warc-record-id"), kind, headers.get("warc-concurrent-to"), headers.get("warc-target-uri"),
            headers.get("warc-refers-to"), size, digest, fields, payload if with_payload else None)


def read_records(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the archives that the manifest names (column ``path``)."""
    def read(rows: Iterator[tuple]) -> Iterator[tuple]:
        for (path,) in rows:
            fs, at = open_fs(path)
            with fs.open_input_stream(at, compression=None) as stream:
                for record in members(stream):
                    yield record_row(record, with_payload)
    return map_rows(files_by_task(manifest.select("path", "bytes")).select("path"), read, RECORDS, RECORDS_DDL, batch=256)


def field(name: str):
    value = F.regexp_extract(F.col("metadata.fields"), rf"(?m)^{name}: ([^\r\n]*)", 1)
    return F.when(value != "", value).cast("long")


def assemble(records: DataFrame) -> DataFrame:
    """capture_id, response, request, metadata: one nested row per response or revisit record.
    Requests and metadata that name no capture found are left out; of several the smallest id counts."""
    kind = F.col("record_type")
    own = records.filter(kind.isin("response", "revisit"))
    beside = records.filter(kind.isin("request", "metadata") & F.col("concurrent_to").isNotNull())
    part = F.struct("record_id", "target", "fields")
    # one exchange on the capture's id brings the records together
    joined = (own.select(F.col("record_id").alias("capture_id"),
                         F.struct("record_id", "record_type", "target", "refers_to", "payload_bytes",
                                  "payload_digest", "payload").alias("response"), F.lit(None).cast(
                             "struct<record_id:string,target:string,fields:string>").alias("request"),
                         F.lit(None).cast("struct<record_id:string,target:string,fields:string>").alias("metadata"))
              .unionByName(beside.select(
                  F.col("concurrent_to").alias("capture_id"),
                  F.lit(None).cast("struct<record_id:string,record_type:string,target:string,refers_to:string,"
                                   "payload_bytes:bigint,payload_digest:string,payload:binary>").alias("response"),
                  F.when(kind == "request", part).alias("request"), F.when(kind == "metadata", part).alias("metadata"))))
    return (joined.groupBy("capture_id")
            .agg(F.max("response").alias("response"), F.min("request").alias("request"), F.min("metadata").alias("metadata"))
            .filter(F.col("response").isNotNull()))


def archived_pages(pages: DataFrame, **options) -> DataFrame:
    """Write the pages' archives, read them back and assemble the captures: page_id, payload_bytes,
    payload_digest, record_type, refers_to, target."""
    whole = assemble(read_records(write_archives(pages, **options), with_payload=False))
    return whole.select(field("page_id").alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"),
                        F.col("response.payload_digest").alias("payload_digest"),
                        F.col("response.record_type").alias("record_type"),
                        field("refers_to_page").alias("refers_to"), F.col("response.target").alias("target"))
