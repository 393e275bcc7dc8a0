"""WARC archives: writing captures with duplicates as revisits, reading records back, joining transactions.

Each capture becomes three records: a response (or a revisit of an equal payload), its
request and its metadata, the latter two naming the first by WARC-Concurrent-To. Records
are gzip members of archives in a shared folder. Reading streams an archive record by
record; a transaction is put together by joining the three kinds on that identifier.

Defined cases: a null payload is empty; a missing url is stored as ``urn:page:<id>`` and
read back as null; repeated rows are captures of their own (of equal page ids the first
in file order is the response); an empty table gives no archive and no capture. Null
page ids are kept and sort below all others.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floe.llm.common import stored, shared_path

#: fixed values of the format
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
ARCHIVE_BYTES = 32 << 20
RECORDS = "archive string, position bigint, record_id string, record_type string, concurrent_to string, refers_to string, url string, date string, payload_digest string, content_type string, http_head string, payload binary, payload_bytes bigint, payload_sha1 string, fields map<string,string>"


def plan_revisits(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Captures with ``digest``, ``size``, ``uid`` (their own record) and ``origin`` (the response a revisit refers to).

    Of equal payloads of at least ``least`` bytes the one with the largest page id is the
    response. The choice is a maximum per digest (pre-aggregated, so a payload that a third
    of all rows share costs one row per task) joined back.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": F.sha1("html"), "size": F.octet_length("html").cast("bigint"), "spot": F.monotonically_increasing_id()})
    key = F.struct(F.coalesce("page_id", F.lit(-(1 << 63))).alias("a"), (-F.col("spot")).alias("b"))
    firsts = rows.filter(F.col("size") >= least).groupBy("digest").agg(F.max(key).alias("first"), F.count("*").alias("n")).filter("n > 1")
    joined = rows.join(firsts.select("digest", "first"), "digest", "left")
    name = lambda page, spot: F.concat_ws("-", F.coalesce(page.cast("string"), F.lit("null")), spot.cast("string"))
    own = name(F.col("page_id"), F.col("spot"))
    first = name(F.when(F.col("first.a") != -(1 << 63), F.col("first.a")), -F.col("first.b"))
    return joined.select("page_id", "url", "html", "digest", "size", own.alias("uid"), F.when(F.col("first").isNotNull() & (first != own), first).alias("origin"))


def _urn(kind: str, uid: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind}:{uid}')}>"


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers), b"Content-Length: %d" % len(block)]
    raw = b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"
    press = zlib.compressobj(1, zlib.DEFLATED, 31)
    return press.compress(raw) + press.flush()


def capture_records(page_id, url, html: str, digest: str, uid: str, origin: str | None) -> list[bytes]:
    """The gzip members of one capture."""
    target = url if url else f"urn:page:{page_id}"
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in target)
    own = _urn("response", uid)
    common = [("WARC-Target-URI", target), ("WARC-Date", DATE)]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n".encode()
    main = [("WARC-Type", "revisit" if origin else "response"), ("WARC-Record-ID", own), *common, ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if origin:
        main += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _urn("response", origin))]
    host = target.split("//", 1)[-1].split("/", 1)[0]
    request = f"GET {target} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    fields = f"page-id: {'' if page_id is None else page_id}\r\nhas-url: {int(bool(url))}\r\n".encode()
    return [
        _record(main, head if origin else head + html.encode()),
        _record([("WARC-Type", "request"), ("WARC-Record-ID", _urn("request", uid)), *common, ("WARC-Concurrent-To", own), ("Content-Type", "application/http; msgtype=request")], request),
        _record([("WARC-Type", "metadata"), ("WARC-Record-ID", _urn("metadata", uid)), *common, ("WARC-Concurrent-To", own), ("Content-Type", "application/warc-fields")], fields),
    ]


def write_archives(captures: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write archives below ``folder``; returns one row per archive of the tasks that succeeded: path, captures.

    Names hold the task's attempt, and only listed archives are ever read, so a lost or
    repeated task leaves nothing behind that counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pafs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        task = TaskContext.get()
        out, size, name, n, number = None, 0, "", 0, 0
        done: list[tuple[str, int]] = []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"{base}/{task.partitionId():06d}-{task.taskAttemptId()}-{number:05d}.warc.gz"
                    out, size, n, number = files.open_output_stream(name, compression=None), 0, 0, number + 1
                    info = f"software: floe\r\nformat: {VERSION.decode()}\r\n".encode()
                    out.write(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _urn("info", name)), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], info))
                for member in capture_records(row["page_id"], row["url"], row["html"], row["digest"], row["uid"], row["origin"]):
                    out.write(member)
                n, size = n + 1, size + row["size"]
                if size >= archive_bytes:
                    out.close()
                    done.append((name, n))
                    out = None
        if out is not None:
            out.close()
            done.append((name, n))
        yield pa.record_batch({"path": pa.array([d[0] for d in done], pa.string()), "captures": pa.array([d[1] for d in done], pa.int64())})

    return captures.select("page_id", "url", "html", "digest", "size", "uid", "origin").mapInArrow(run, "path string, captures bigint")


def _members(stream, chunk: int = 1 << 18) -> Iterator[bytes]:
    """Decompressed gzip members of a stream, one at a time."""
    left = b""
    while True:
        if not left:
            left = stream.read(chunk)
            if not left:
                return
        press, parts = zlib.decompressobj(31), []
        while not press.eof:
            if not left:
                left = stream.read(chunk)
                if not left:
                    raise EOFError("an archive ends inside a record")
            parts.append(press.decompress(left))
            left = press.unused_data
        yield b"".join(parts)


def parse_record(raw: bytes, payloads: bool = True) -> dict:
    """Headers and block of one record; an HTTP block is split into head and payload, warc-fields become a map."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    h = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[: int(h["content-length"])]
    kind = h.get("content-type", "")
    http, payload = (block.partition(b"\r\n\r\n")[::2]) if kind.startswith("application/http") else (b"", block)
    fields = {}
    if kind == "application/warc-fields":
        fields = {k.strip(): v.strip() for k, _, v in (line.partition(":") for line in block.decode().split("\r\n") if line)}
    return {
        "record_id": h.get("warc-record-id"), "record_type": h.get("warc-type"), "concurrent_to": h.get("warc-concurrent-to"), "refers_to": h.get("warc-refers-to"),
        "url": h.get("warc-target-uri"), "date": h.get("warc-date"), "payload_digest": h.get("warc-payload-digest"), "content_type": kind, "http_head": http.decode("utf-8", "replace"),
        "payload": payload if payloads else None, "payload_bytes": len(payload), "payload_sha1": hashlib.sha1(payload).hexdigest() if h.get("warc-type") == "response" else None, "fields": list(fields.items()),
    }


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the listed archives (column ``path``); ``payloads`` False leaves the bytes out, not their size and digest."""
    schema = pa.schema([(f, t) for f, t in zip(
        "archive position record_id record_type concurrent_to refers_to url date payload_digest content_type http_head payload payload_bytes payload_sha1 fields".split(),
        [pa.string(), pa.int64(), *[pa.string()] * 9, pa.binary(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string())], strict=True)])
    home = shared_path(archives.sparkSession, "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = pafs.FileSystem.from_uri(home)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, size = [], 0
                with files.open_input_stream(path, compression=None) as stream:
                    for k, raw in enumerate(_members(stream)):
                        rows.append({"archive": path, "position": k, **parse_record(raw, payloads)})
                        size += len(raw)
                        if len(rows) >= 3000 or size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return archives.select("path").mapInArrow(run, RECORDS)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit with request and metadata as structs.

    Records are joined on the identifier they are concurrent to; a capture without request
    or metadata keeps null there. A revisit's size and digest are those of the response it refers to.
    """
    main = records.filter(F.col("record_type").isin("response", "revisit"))
    part = lambda kind, cols: records.filter(F.col("record_type") == kind).select(F.col("concurrent_to").alias("record_id"), F.struct(*cols).alias(kind))
    joined = main.join(part("request", ["http_head", "url", "date"]), "record_id", "left").join(part("metadata", ["fields", "date"]), "record_id", "left")
    joined = joined.select("record_id", "record_type", "refers_to", "url", "payload_digest", "payload_bytes", "payload_sha1", "http_head", "payload", "request", "metadata")
    fields = F.col("metadata.fields")
    joined = joined.withColumns({"page_id": F.when(fields["page-id"] != "", fields["page-id"].cast("bigint")), "url": F.when(fields["has-url"] != "0", F.col("url"))})
    wanted = joined.filter("refers_to is not null").select(F.col("refers_to").alias("record_id")).distinct()
    origins = joined.select("record_id", "page_id", "payload_bytes").join(wanted, "record_id", "left_semi")
    origins = origins.select(F.col("record_id").alias("refers_to"), F.struct("page_id", "payload_bytes").alias("origin"))
    return joined.join(origins, "refers_to", "left")


def archive(pages: DataFrame, least: int = 1000, payloads: bool = False) -> DataFrame:
    """Write all pages to archives in the shared folder, read them back, return the transactions."""
    spark = pages.sparkSession
    folder = shared_path(spark, "warc")
    listed = stored(write_archives(plan_revisits(pages, least), folder), "archives")
    count = max(1, min(10_000, listed.count()))
    return transactions(read_archives(listed.repartition(count, "path"), payloads))
