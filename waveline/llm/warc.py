"""Legacy web archives: ARC files in, equivalent WARC records out, written and read back by Spark.

An ARC file is a version block and records, each a header line, as many bytes as the line
declares, and a newline. Version 1 lines have 5 fields, version 2 lines 10. The converter reads
them by the declared lengths and makes for each a WARC record with an identifier (the same on
every run), an ISO time stamp, a type and digests.

Archives are written by Spark's text writer, bytes as they are (no payload need be UTF-8), and
any file system and commit protocol of Spark's will do. Every record is a gzip member of its own,
as is usual for WARC, so it can be sought and read alone. Between two stands one empty member,
always the same 20 bytes: any reader of gzip passes over it, and Spark's line reader cuts there,
so a file of any size is read by several tasks, a record at a time. WARC files of other writers,
packed or plain, are read whole, a file a row (``read_warc``), and so are ARC files (``convert_arc``).
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waveline.llm.common import BATCH_BYTES, bounded_broadcast, checkpoint, checkpoint_dir, small_batches

#: Fixed values of the formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Equal payloads of at least this many bytes are stored once.
REVISIT_BYTES = 1000
#: A gzip member without content: header, empty block, check sum and length.
EMPTY_MEMBER = b"\x1f\x8b\x08\0\0\0\0\0\0\xff\x03\0\0\0\0\0\0\0\0\0"
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:waveline:warc")


@dataclass(frozen=True)
class ArcRecord:
    url: str
    ip: str
    date: str  # 14 digits
    content_type: str
    block: bytes  # HTTP header and payload, or bare content
    offset: int = 0

    @property
    def payload(self) -> bytes:
        return self.block.partition(b"\r\n\r\n")[2] if self.block.startswith(b"HTTP/") else self.block


def pack_arc(records: list[ArcRecord], version: int = 1, name: str = "waveline.arc") -> bytes:
    """An ARC file of either version."""
    block = f"{version} 0 waveline\n{ARC_FIELDS[version]}\n".encode()
    line = lambda url, ip, date, kind, n, status, at: " ".join([url, ip, date, kind, *([status, "-", "-", str(at), name] if version == 2 else []), str(n)]).encode() + b"\n"
    out = bytearray(line(f"filedesc://{name}", "0.0.0.0", "19960101000000", "text/plain", len(block), "200", 0) + block + b"\n")
    for r in records:
        url = (r.url or "-").replace(" ", "%20").replace("\r", "%0D").replace("\n", "%0A")
        out += line(url, r.ip, r.date, r.content_type, len(r.block), "200", len(out)) + r.block + b"\n"
    return bytes(out)


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """The records after the version block, by their declared lengths; a torn one is an error."""
    at, fields = 0, 0
    while at < len(data):
        start, end = at, data.find(b"\n", at)
        if end == at:  # newlines between records
            at += 1
            continue
        if end < 0:
            raise ValueError(f"no header line at {at}")
        parts = data[at:end].decode("utf-8", "replace").strip().split(" ")
        if not parts[-1].isdigit() or (n := int(parts[-1])) > len(data) - end - 1:
            raise ValueError(f"bad length at {at}")
        block, at = data[end + 1 : end + 1 + n], end + 1 + n
        if not fields:
            said = block.split(b"\n", 1)[0].split(b" ")[0]
            if not parts[0].startswith("filedesc://") or not said.isdigit() or int(said) not in ARC_FIELDS:
                raise ValueError("no version block")
            fields = len(ARC_FIELDS[int(said)].split(" "))
            continue
        if len(parts) < fields:
            raise ValueError(f"{len(parts)} of {fields} fields at {start}")
        extra = len(parts) - fields  # blanks inside the URL
        url, rest = " ".join(parts[: extra + 1]), parts[extra + 1 :]
        yield ArcRecord(url, rest[0], rest[1], rest[2], block, start)


def iso_date(digits: str) -> str:
    """8, 12 or 14 digits as an ISO time; missing ones are zero."""
    d = digits.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(digest: str, key: object) -> str:
    """The same identifier for the same payload and document on every run."""
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{digest}/{key}')}>"


def to_warc(record: ArcRecord, key: object, refers_to: object = None) -> tuple[bytes, str]:
    """A WARC record without the blank lines that end it, and its payload digest.

    With ``refers_to`` it is a revisit of that document: the HTTP header stays, the payload goes.
    """
    payload, http = record.payload, record.block.startswith(b"HTTP/")
    digest = hashlib.sha1(payload).hexdigest()
    kind = "revisit" if refers_to is not None else "response" if http else "resource"
    block = record.block
    if kind == "revisit":
        block = record.block[: len(record.block) - len(payload)] if http else b""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(digest, key)}", f"WARC-Date: {iso_date(record.date)}"]
    lines += [f"WARC-Target-URI: {record.url}", f"WARC-IP-Address: {record.ip}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}"]
    lines += [f"X-Document-ID: {'' if key is None else key}", f"X-Payload-Length: {len(payload)}"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(digest, refers_to)}", f"X-Refers-To-Document: {refers_to}"]
    kind_of = "application/http; msgtype=response" if http else record.content_type
    lines += [f"Content-Type: {kind_of}", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogateescape") + block, digest


def parse_warc(data: bytes, head_only: bool = False) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of one record, by its declared length."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if colon:
            fields[name.strip().lower()] = value.strip()
    n = int(fields["content-length"])
    if not mark or len(rest) < n and not head_only:
        raise ValueError("torn record")
    return fields, rest[:n]


def member(data: bytes) -> bytes:
    """A record as a gzip member, the same on every run."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def unpacked(data: bytes) -> bytes:
    """A file's content, whether it is packed in gzip members or not."""
    return gzip.decompress(data) if data.startswith(b"\x1f\x8b") else data


def records_of(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of all records of a WARC file's content, by their declared lengths."""
    at = 0
    while at < len(data):
        if data[at : at + 2] == b"\r\n":
            at += 2
            continue
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at {at}")
        fields, _ = parse_warc(data[at:end] + b"\r\n\r\n", head_only=True)
        n = int(fields["content-length"])
        if end + 4 + n > len(data):
            raise ValueError(f"torn record at {at}")
        yield fields, data[end + 4 : end + 4 + n]
        at = end + 4 + n


def _write(records: DataFrame, path: str) -> None:
    """A column ``value`` of gzip members as files, an empty member after each."""
    text = records.select(F.col("value").cast("string").alias("value"))  # the bytes as they are
    text.write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("compression", "none").text(path)


def page_arc(key: object, url: str | None, html: bytes) -> bytes:
    """A page as an ARC file of one record: version 1 or 2 by turns, since both must convert."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(html)
    record = ArcRecord(url or "-", "192.0.2.1", "20200101000000", "text/html", http + html)
    return pack_arc([record], version=1 + zlib.crc32(str(key).encode()) % 2)


def write_archives(pages: DataFrame, path: str, id_col: str, url_col: str, html_col: str, min_bytes: int = REVISIT_BYTES) -> None:
    """Every page as an ARC record, converted, into WARC files under ``path``. Payloads are text or bytes.

    Of equal payloads of at least ``min_bytes``, that with the largest id is a response and the
    others revisit it. The table of such payloads is broadcast if it is small; else the pages'
    ids are joined to it first, and only what repeats moves.
    """
    html = F.col(html_col).cast("binary")
    size, digest = F.coalesce(F.octet_length(html), F.lit(0)), F.sha1(html)
    rows = pages.select(F.col(id_col).alias("k"), F.col(url_col).alias("url"), html.alias("html"), F.when(size >= min_bytes, digest).alias("d"))
    twice = rows.where("d is not null").groupBy("d").agg(F.max("k").alias("to"), F.count("*").alias("n")).where("n > 1").select("d", "to")
    none = F.lit(None).cast(rows.schema["k"].dataType)
    long = rows.where("d is not null").join(bounded_broadcast(checkpoint(twice)), "d", "left").select("k", "url", "html", F.when(F.col("k") < F.col("to"), F.col("to")).alias("to"))
    rows = long.unionByName(rows.where("d is null").select("k", "url", "html", none.alias("to")))

    def run(batches):
        for batch in batches:
            out = []
            keys, urls, htmls, tos = (batch.column(i) for i in range(4))
            for key, url, data, to in zip(keys.to_pylist(), urls.to_pylist(), htmls.to_pylist(), tos.to_pylist(), strict=True):
                for record in parse_arc(page_arc(key, url, data or b"")):
                    out.append(member(to_warc(record, key, to)[0] + b"\r\n\r\n"))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    _write(small_batches(rows).mapInArrow(run, "value binary"), path)


def read_archives(pages: DataFrame, path: str, id_type: str) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of every record under ``path``."""
    reader = pages.sparkSession.read.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1"))
    lines = reader.text(path).where("value <> ''").select(F.col("value").cast("binary").alias("value"))

    def run(batches):
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for data in batch.column(0).to_pylist():
                fields, block = parse_warc(unpacked(data))
                kind, digest, size = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:"), int(fields["x-payload-length"])
                if kind != "revisit":
                    payload = block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block
                    if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"a payload differs from its digest: {fields['warc-record-id']}")
                for col, x in zip(cols, (fields["x-document-id"] or None, size, digest, kind, fields.get("x-refers-to-document")), strict=True):
                    col.append(x)
            types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    found = lines.mapInArrow(run, "page_id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string")
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def _files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(path, content)``, a file a batch: a file must fit a task's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_warc(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(path, type, record_id, date, uri, fields, block, payload)`` of every record of any writer's WARC files.

    Files may be plain, or packed as a whole or a member a record. A payload is a record's block
    without its HTTP header; a torn file is an error. No files, or empty ones, give no rows.
    """

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for fields, block in records_of(unpacked(data)):
                    payload = block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block
                    row = [name, fields.get("warc-type"), fields.get("warc-record-id"), fields.get("warc-date"), fields.get("warc-target-uri"), list(fields.items()), block, payload]
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], names)

    types = [pa.string()] * 5 + [pa.map_(pa.string(), pa.string()), pa.binary(), pa.binary()]
    names = ["path", "type", "record_id", "date", "uri", "fields", "block", "payload"]
    return _files(spark, path).mapInArrow(run, "path string, type string, record_id string, date string, uri string, fields map<string,string>, block binary, payload binary")


def convert_arc(spark: SparkSession, path: str | list[str], out: str) -> None:
    """Every record of the ARC files at ``path``, plain or packed, as a WARC record under ``out``.

    A record's key is its file's name and its place there, so that identifiers are the same on
    every run. Payloads are bytes of any kind. A torn file is an error.
    """

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                stem = name.rsplit("/", 1)[-1]
                for record in parse_arc(unpacked(data)):
                    yield pa.RecordBatch.from_arrays([pa.array([member(to_warc(record, f"{stem}@{record.offset}")[0] + b"\r\n\r\n")], pa.binary())], ["value"])

    _write(_files(spark, path).mapInArrow(run, "value binary"), out)


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write every page's WARC record, then read the archives back: a row of each record.

    A null html is an empty payload, a null URL a dash. Rows with the largest id of equal
    payloads are all responses, if that row is repeated; a null id never is revisited and is a
    response. An empty table gives no rows; other columns are ignored. The archives stay in the
    shared checkpoint folder, for the returned frame is lazy.
    """
    path = f"{checkpoint_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, id_col, url_col, html_col)
    return read_archives(pages, path, pages.select(id_col).schema[0].dataType.simpleString())
